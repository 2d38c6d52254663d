"""Findings against an expected list, and the figures of a review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sourcetrail import contract as K

KEY = ["case_id", "finding_type", "finding_subtype", "test_code", "exam_date"]


def expected_vs_found(expected: DataFrame, sources: DataFrame, heads: DataFrame) -> DataFrame:
    """MATCHED, MISSED or EXTRA per key, and whether the expected page is among the sources.

    Findings are counted per key before any join, and pages are reduced to distinct pairs, so a
    key with very many findings is as small as any other.  ``sources`` have a row per entry of
    evidence, ``heads`` one per finding; both have the key."""
    listed = expected.select("case_id").distinct()
    counted = heads.join(listed, "case_id", "left_semi").groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_findings"))
    pages = (
        sources.join(listed, "case_id", "left_semi").select(*KEY, "page_num").distinct()
    )
    unknown_page = pages.where(F.col("page_num").isNull()).select(*KEY, F.lit(True).alias("__unknown"))

    def aliased(df: DataFrame, mark: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{mark}{c}") for c in KEY], *[c for c in df.columns if c not in KEY])

    def same_key(left: str, right: str) -> Column:
        on = F.col(f"{left}case_id") == F.col(f"{right}case_id")
        for c in ("finding_type", "finding_subtype"):
            on = on & (F.col(f"{left}{c}") == F.col(f"{right}{c}"))
        for c in ("test_code", "exam_date"):
            on = on & F.col(f"{left}{c}").eqNullSafe(F.col(f"{right}{c}"))
        return on

    wanted = aliased(expected.select(*KEY, "expected_page"), "e_")
    found = aliased(counted, "f_")
    hit = aliased(pages.select(*KEY, "page_num", F.lit(True).alias("__hit")), "h_")
    blank = aliased(unknown_page, "u_")
    joined = (
        wanted.join(found, same_key("e_", "f_"), "full")
        .join(hit, same_key("e_", "h_") & (F.col("expected_page") == F.col("page_num")), "left")
        .join(blank, same_key("e_", "u_"), "left")
    )
    outcome = (
        F.when(F.col("e_case_id").isNotNull() & F.col("f_case_id").isNotNull(), "MATCHED")
        .when(F.col("e_case_id").isNotNull(), "MISSED")
        .otherwise("EXTRA")
    )
    checked = F.col("expected_page").isNotNull() & F.col("f_case_id").isNotNull()
    page_found = F.when(F.col("__hit"), True).when(F.col("__unknown").isNull(), False)
    return joined.select(
        *[F.coalesce(f"e_{c}", f"f_{c}").alias(c) for c in KEY],
        "n_findings",
        "expected_page",
        outcome.alias("outcome"),
        F.when(checked, page_found).alias("source_page_matches"),
    )


def found_ids(heads: DataFrame) -> DataFrame:
    """The findings behind every key, one row per id, with how many the key has.

    The count comes from an aggregate of its own: no task holds the ids of a key."""
    sizes = heads.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_findings"))
    return _with_key(heads.select(*KEY, "finding_id"), sizes)


def outcome_ids(outcomes: DataFrame, heads: DataFrame) -> DataFrame:
    """The findings behind every outcome, one row per id; a missed key has none."""
    return _with_key(heads.select(*KEY, "finding_id"), outcomes.select(*KEY, "outcome"))


def _with_key(rows: DataFrame, keyed: DataFrame) -> DataFrame:
    """Rows joined with what their key has; a key's test and date may be missing."""
    renamed = keyed.select(*[F.col(c).alias(f"__{c}") for c in KEY], *[c for c in keyed.columns if c not in KEY])
    on = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in KEY]
    return rows.join(renamed, on).drop(*[f"__{c}" for c in KEY])


def share(part: str, whole: str) -> Column:
    return F.round(F.col(part) / F.nullif(F.col(whole), F.lit(0)), 3)


def seconds(start: str, end: str) -> Column:
    return F.timestamp_diff("SECOND", F.col(start), F.col(end))


def review_metrics(
    status: DataFrame,
    cases: DataFrame,
    pages: DataFrame,
    measurements: DataFrame,
    queue: DataFrame,
    outcomes: DataFrame,
    terms: K.Terms = K.DEFAULT_TERMS,
) -> DataFrame:
    """Counts, rates, coverage and latencies per case; every input is aggregated before the joins."""
    extraction = measurements.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("n_measurements"),
        F.min("ingested_at").alias("first_ingested_at"),
        F.min("processed_at").alias("first_extracted_at"),
    )
    page_counts = pages.groupBy("case_id").agg(F.count(F.lit(1)).alias("n_pages"))

    def of_type(name: str) -> Column:
        return F.count_if(F.col("finding_type") == name)

    def of_action(name: str) -> Column:
        return F.count_if(F.col("reviewer_action") == name)

    queued = queue.groupBy("case_id").agg(
        of_type("OUT_OF_DOCUMENT_RANGE").alias("n_out_of_range"),
        of_type("TEMPORAL_VARIATION").alias("n_temporal_variation"),
        of_type("CONFLICT").alias("n_conflicts"),
        of_type("GAP").alias("n_gaps"),
        of_action("CONFIRM").alias("n_confirmed"),
        of_action("CORRECT").alias("n_corrected"),
        of_action("REJECT").alias("n_rejected"),
        F.count("reviewer_action").alias("n_decided"),
        F.max(terms.field("decided_at")).alias("last_classified_at"),
    )
    compared = outcomes.groupBy("case_id").agg(
        F.count_if(F.col("outcome").isin("MATCHED", "MISSED")).alias("n_expected"),
        F.count_if(F.col("outcome") == "MATCHED").alias("n_matched"),
        F.count_if(F.col("outcome") == "EXTRA").alias("n_extra"),
        F.count_if(F.col("source_page_matches")).alias("n_source_ok"),
        F.count("source_page_matches").alias("n_source_checked"),
    )
    joined = (
        status.join(cases.select("case_id", "manual_review_seconds_baseline"), "case_id", "left")
        .join(page_counts, "case_id", "left")
        .join(extraction, "case_id", "left")
        .join(queued, "case_id", "left")
        .join(compared, "case_id", "left")
    )
    return joined.select(
        "case_id",
        "review_id",
        "scenario",
        "review_state",
        "onchain_status",
        "manual_review_seconds_baseline",
        "n_pages",
        "n_measurements",
        "n_out_of_range",
        "n_temporal_variation",
        "n_conflicts",
        "n_gaps",
        "n_confirmed",
        "n_corrected",
        "n_rejected",
        share("n_confirmed", "n_decided").alias("confirm_rate"),
        share("n_corrected", "n_decided").alias("correct_rate"),
        share("n_rejected", "n_decided").alias("reject_rate"),
        share("n_matched", "n_expected").alias("finding_coverage"),
        F.col("n_extra").alias("findings_not_expected"),
        share("n_source_ok", "n_source_checked").alias("source_precision"),
        seconds("first_ingested_at", "first_extracted_at").alias("first_response_latency_s"),
        seconds("first_ingested_at", "signoff_at").alias("review_seconds"),
        seconds("signoff_at", "submitted_at").alias("review_to_attestation_s"),
        seconds("first_ingested_at", "verified_at").alias("total_flow_s"),
        (F.col("onchain_status") == "VERIFIED").alias("attestation_verified"),
    )


def outcome_histogram(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
