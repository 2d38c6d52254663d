"""Row-level expectations.  A rule holds only when it is TRUE; NULL counts as a violation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sourcetrail import contract as K

Rules = dict[str, "str | Column"]


def _holds(rule: str | Column) -> Column:
    condition = F.expr(rule) if isinstance(rule, str) else rule
    return F.coalesce(condition, F.lit(False))


def _all_hold(rules: Rules) -> Column:
    out = F.lit(True)
    for rule in rules.values():
        out = out & _holds(rule)
    return out


def broken_rules(rules: Rules) -> Column:
    """Names of the rules a row violates, in the order they were given."""
    marks = [F.when(~_holds(rule), F.lit(name)) for name, rule in rules.items()]
    return F.filter(F.array(*marks), lambda name: name.isNotNull())


def expect(df: DataFrame, rules: Rules, action: str = "warn", observation: Observation | str | None = None) -> DataFrame:
    """Apply rules to every row.

    ``warn`` keeps all rows, ``drop`` keeps rows for which every rule holds, ``fail`` aborts the
    query on the first violation.  With an observation, violations are counted per rule while the
    data flows by: on a batch read ``observation.get``, on a stream the query progress."""
    if observation is not None:
        counters = [F.count_if(~_holds(rule)).alias(name) for name, rule in rules.items()]
        df = df.observe(observation, F.count(F.lit(1)).alias("n_rows"), *counters)
    if action == "warn":
        return df
    if action == "drop":
        return df.where(_all_hold(rules))
    if action == "fail":
        message = F.concat(F.lit("expectation failed: "), F.array_join(broken_rules(rules), ", "))
        # as a filter the check survives column pruning
        return df.where(F.when(_all_hold(rules), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    raise ValueError(f"unknown action {action!r}")


def expectation_report(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule with its counts, from a single aggregate over the data."""
    counted = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(_holds(rule)).alias(f"passed_{i}") for i, rule in enumerate(rules.values())],
    )
    rows = [
        F.struct(F.lit(name).alias("rule"), F.col("n_rows"), F.col(f"passed_{i}").alias("n_passed"))
        for i, name in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*rows))).withColumn("n_failed", F.col("n_rows") - F.col("n_passed"))


# --- rule libraries ------------------------------------------------------------------------------


def matches(column: str, pattern: str) -> Column:
    return F.col(column).rlike(pattern)


def optional(column: str, rule: Column) -> Column:
    return F.col(column).isNull() | rule


def all_sha256(*columns: str) -> Column:
    out = F.lit(True)
    for column in columns:
        out = out & matches(column, K.SHA256)
    return out


def within_bytes(column: str, limit: int = K.LEDGER_TEXT_BYTES) -> Column:
    return F.octet_length(column) <= limit


def file_magic(column: str = "content", magic: str = K.PDF_MAGIC) -> Column:
    return F.hex(F.substring(F.col(column), 1, len(magic) // 2)) == magic


def filled(*columns: str) -> Column:
    out = F.lit(True)
    for column in columns:
        out = out & F.col(column).isNotNull()
    return out


def document_rules() -> Rules:
    return {"is_pdf": file_magic(), "has_case_id": F.col("case_id") != ""}


def page_rules() -> Rules:
    return {"valid_document": (F.col("case_id") != "") & (F.col("document_id") != "")}


def measurement_rules() -> Rules:
    return {
        "has_source": filled("source_text", "page_num"),
        "valid_status": F.col("value_status").isin(K.VALUE_STATUSES),
    }


def measurement_warnings() -> Rules:
    return {"value_present_when_ok": (F.col("value_status") != "OK") | F.col("value").isNotNull()}


def case_rules() -> Rules:
    return {"has_keys": filled("case_id", "review_id"), "has_ts": filled("created_at")}


def case_warnings() -> Rules:
    return {"declared_synthetic": F.col("data_classification") == "SYNTHETIC"}


def classifier_rules() -> Rules:
    return {"has_keys": filled("finding_id", "decided_at")}


def classifier_warnings() -> Rules:
    return {"schema_ok": F.col("priority").isin(K.PRIORITIES) & filled("needs_review", "is_clear")}


def review_decision_rules() -> Rules:
    on_finding = (
        (F.col("scope") == "FINDING") & filled("finding_id") & F.col("action").isin("CONFIRM", "CORRECT", "REJECT")
    )
    on_review = (F.col("scope") == "REVIEW") & (F.col("action") == "SIGNOFF")
    return {
        "has_keys": filled("review_id", "decided_at", "reviewer_tech_id"),
        "valid_scope_action": on_finding | on_review,
        "correction_has_value": (F.col("action") != "CORRECT")
        | F.col("corrected_value").isNotNull()
        | F.col("corrected_unit").isNotNull(),
    }


def attestation_rules() -> Rules:
    return {
        "has_keys": filled("review_id", "submitted_at"),
        "has_tx": filled("tx_signature", "pda_address"),
        "devnet_only": F.col("cluster") == "devnet",
        "hashes_are_sha256": all_sha256("input_hash", "analysis_hash", "reviewed_hash"),
    }


def verification_rules() -> Rules:
    return {"has_keys": filled("review_id", "verified_at")}


def finding_rules() -> Rules:
    return {
        "every_finding_has_source": F.col("n_evidence") > 0,
        "known_finding_type": F.col("finding_type").isin(K.FINDING_TYPES),
    }


def source_rules() -> Rules:
    return {"every_finding_has_source": filled("finding_id", "document_id")}


def finding_warnings() -> Rules:
    return {"registered_case": filled("review_id")}


def payload_rules() -> Rules:
    return {"sha256_hashes": all_sha256("input_hash", "analysis_hash", "reviewed_hash")}


def payload_warnings() -> Rules:
    return {"versions_fit_ledger": within_bytes("workflow_version") & within_bytes("model_version")}


# --- contracts of incoming records ----------------------------------------------------------------


def case_contract() -> Rules:
    return {
        "case_id": matches("case_id", K.TECH_ID),
        "review_id": matches("review_id", K.TECH_ID),
        "data_classification": F.col("data_classification") == "SYNTHETIC",
        "scenario": optional("scenario", matches("scenario", K.TECH_ID)),
        "baseline": optional("manual_review_seconds_baseline", F.col("manual_review_seconds_baseline") >= 0),
    }


def review_decision_contract() -> Rules:
    on_finding = F.col("scope") == "FINDING"
    on_review = F.col("scope") == "REVIEW"
    named = F.coalesce(F.length("finding_id") > 0, F.lit(False))
    corrected = F.col("corrected_value").isNotNull() | F.coalesce(F.length("corrected_unit") > 0, F.lit(False))
    return {
        "review_id": matches("review_id", K.TECH_ID),
        "scope": on_finding | on_review,
        "finding_id": optional("finding_id", matches("finding_id", K.TECH_ID)),
        "action": F.col("action").isin("CONFIRM", "CORRECT", "REJECT", "SIGNOFF"),
        "corrected_unit": optional("corrected_unit", matches("corrected_unit", K.UNIT)),
        "reviewer_tech_id": matches("reviewer_tech_id", K.TECH_ID),
        "finding_scope_names_finding": ~on_finding | named,
        "finding_scope_no_signoff": ~on_finding | (F.col("action") != "SIGNOFF"),
        "correction_has_value": ~on_finding | (F.col("action") != "CORRECT") | corrected,
        "review_scope_signoff_only": ~on_review | ((F.col("action") == "SIGNOFF") & ~named),
    }


def attestation_contract() -> Rules:
    keys = {name: matches(name, K.BASE58_KEY) for name in ("program_id", "pda_address")}
    hashes = {name: matches(name, K.SHA256) for name in ("input_hash", "analysis_hash", "reviewed_hash")}
    versions = {name: matches(name, K.LEDGER_VERSION) for name in ("workflow_version", "model_version")}
    return {
        "review_id": matches("review_id", K.TECH_ID),
        "cluster": F.col("cluster") == "devnet",
        **keys,
        "tx_signature": matches("tx_signature", K.BASE58_SIGNATURE),
        **hashes,
        **versions,
        "status": F.col("status") == "SUBMITTED",
        "reviewer_tech_id": matches("reviewer_tech_id", K.TECH_ID),
    }


def validate(df: DataFrame, contract: Rules) -> DataFrame:
    """Every row with the names of the contract rules it breaks; an empty list means accepted."""
    return df.withColumn("violations", broken_rules(contract))


def upload_gate(
    uploads: DataFrame,
    known: DataFrame,
    keys: list[str],
    size: str = "size_bytes",
    magic_ok: Column | None = None,
    declared: str = "declared",
    max_bytes: int = K.MAX_UPLOAD_BYTES,
) -> DataFrame:
    """Outcome code per upload: 413 too large, 415 not the right kind of file, 422 not declared,
    409 id already known, 201 accepted; the first reason wins."""
    seen = known.select(*keys).distinct().withColumn("already_known", F.lit(True))
    right_kind = file_magic() if magic_ok is None else magic_ok
    return (
        uploads.join(seen, keys, "left")
        .withColumn(
            "outcome",
            F.when(F.col(size) > max_bytes, 413)
            .when(~F.coalesce(right_kind, F.lit(False)), 415)
            .when(~F.coalesce(F.col(declared), F.lit(False)), 422)
            .when(F.col("already_known"), 409)
            .otherwise(201),
        )
        .drop("already_known")
    )
