"""Hash chain of a review and the state machine that closes it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sourcetrail import contract as K
from sourcetrail.operators.digest import GATHER_LIMIT, ordered_digest, tree_digest
from sourcetrail.operators.quality import expect, payload_rules
from sourcetrail.session import materialize

WORKFLOW_VERSION = "review-wf-1.0.0"


def _frame(counted: DataFrame, n_items: str) -> DataFrame:
    return counted.select("case_id", F.col(n_items).alias("n_items"), F.lit("").alias("prefix"), F.lit("").alias("suffix"))


def document_set(documents: DataFrame, limit: int = GATHER_LIMIT) -> DataFrame:
    """Per case: number of documents and the hash of the set of their content hashes.

    Reads two columns; the content itself stays on disk."""
    contents = materialize(
        documents.groupBy("case_id", "input_hash").agg(F.count(F.lit(1)).alias("n_copies")), "document-hashes"
    )
    counted = contents.groupBy("case_id").agg(
        F.sum("n_copies").alias("n_documents"), F.count(F.lit(1)).alias("n_contents")
    )
    digest = ordered_digest(contents, ["case_id"], F.col("input_hash"), ",", _frame(counted, "n_contents"), limit)
    return counted.join(digest.withColumnRenamed("digest", "input_hash"), "case_id").drop("n_contents")


def analysis_json(terms: K.Terms = K.DEFAULT_TERMS) -> Column:
    """Canonical text of one finding in the analysis hash; NULL fields are left out."""
    t = terms.field
    kept = ["model", "prompt_version", "needs_review", "priority", "is_clear"]
    return F.to_json(
        F.struct(
            "finding_id",
            F.col("finding_type").alias("type"),
            F.col("finding_subtype").alias("subtype"),
            *[F.col(t(name)) for name in kept],
            "needs_review_final",
            "priority_final",
        )
    )


def decision_json() -> Column:
    return F.to_json(
        F.struct(
            "finding_id",
            F.col("reviewer_action").alias("action"),
            "corrected_value",
            "corrected_unit",
            F.col("reviewer_tech_id").alias("reviewer"),
        )
    )


def analysis_summary(queue: DataFrame, terms: K.Terms = K.DEFAULT_TERMS, limit: int = GATHER_LIMIT) -> DataFrame:
    """Per case: counts over its queue, the models that answered, and the analysis hash.

    ``queue`` has one row per finding and should be a written table: it is read more than once."""
    counted = queue.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("n_findings"),
        F.count_if(F.col(terms.field("status")) == "PENDING").alias("n_pending_classifier"),
        F.count_if(F.col("needs_review_final") & F.col("reviewer_action").isNull()).alias("n_pending_human"),
        F.count_if(F.col("reviewer_action") == "CORRECT").alias("n_corrected"),
        F.count("reviewer_action").alias("n_decided"),
        F.array_join(F.sort_array(F.collect_set(terms.field("model"))), ",").alias("models"),
    )
    digest = ordered_digest(queue, ["case_id"], analysis_json(terms), "\n", _frame(counted, "n_findings"), limit)
    return counted.join(digest.withColumnRenamed("digest", "analysis_hash"), "case_id")


def case_trees(documents: DataFrame, queue: DataFrame, terms: K.Terms = K.DEFAULT_TERMS) -> DataFrame:
    """Tree digests of what a review rests on, beside its compatible hashes: case_id, part, digest, n_items.

    The parts are the distinct contents of its documents, the analysis texts of its findings and the decisions on them.  A
    case with a third of all rows is spread over the leaves of its trees."""
    contents = documents.select("case_id", "input_hash").distinct()
    decided = queue.where(F.col("reviewer_action").isNotNull())
    parts = {
        "input": tree_digest(contents, ["case_id"], F.col("input_hash")),
        "analysis": tree_digest(queue, ["case_id"], analysis_json(terms)),
        "decisions": tree_digest(decided, ["case_id"], decision_json()),
    }
    trees = [rows.select("case_id", F.lit(part).alias("part"), "digest", "n_items") for part, rows in parts.items()]
    return trees[0].union(trees[1]).union(trees[2])


def attestation_payload(
    cases: DataFrame,
    documents: DataFrame,
    queue: DataFrame,
    measurements: DataFrame,
    reviewed: DataFrame,
    terms: K.Terms = K.DEFAULT_TERMS,
    workflow_version: str = WORKFLOW_VERSION,
    limit: int = GATHER_LIMIT,
) -> DataFrame:
    """The technical record of a review: hashes, versions, target status.  No document content."""
    extractors = measurements.groupBy("case_id").agg(
        F.array_join(F.sort_array(F.collect_set("extractor_version")), ",").alias("extractors")
    )
    signoff = reviewed.where((F.col("scope") == "REVIEW") & (F.col("action") == "SIGNOFF")).select(
        "review_id", "reviewer_tech_id", F.col("decided_at").alias("signoff_at")
    )
    assembled = (
        cases.select("case_id", "review_id")
        .join(document_set(documents, limit), "case_id")
        .join(analysis_summary(queue, terms, limit), "case_id", "left")
        .join(extractors, "case_id", "left")
        .join(signoff, "review_id", "left")
    )

    def stated(column: str, default: str) -> Column:
        return F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(default))

    counts = ["n_findings", "n_pending_classifier", "n_pending_human", "n_corrected", "n_decided"]
    no_findings = F.sha2(F.lit(""), 256)
    base = assembled.select(
        "review_id",
        "case_id",
        "input_hash",
        F.coalesce("analysis_hash", no_findings).alias("analysis_hash"),
        F.concat(stated("extractors", "no-extraction"), F.lit("+"), stated("models", f"no-{terms.prefix}")).alias(
            "model_version"
        ),
        "reviewer_tech_id",
        "signoff_at",
        "n_documents",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
    )
    signed = F.concat_ws(
        "|",
        F.lit(""),
        F.coalesce("reviewer_tech_id", F.lit("")),
        F.coalesce(F.unix_micros("signoff_at").cast("string"), F.lit("")),
    )
    base = materialize(base, "payload-base")
    frame = base.select(
        "case_id",
        F.col("n_decided").alias("n_items"),
        F.concat("analysis_hash", F.lit("|")).alias("prefix"),
        signed.alias("suffix"),
    )
    decided = queue.where(F.col("reviewer_action").isNotNull())
    reviewed_hash = ordered_digest(decided, ["case_id"], decision_json(), "\n", frame, limit)
    payload = base.join(reviewed_hash.withColumnRenamed("digest", "reviewed_hash"), "case_id").select(
        "review_id",
        "case_id",
        "input_hash",
        "analysis_hash",
        "reviewed_hash",
        F.lit(workflow_version).alias("workflow_version"),
        "model_version",
        F.when(F.col("n_corrected") > 0, "CORRECTED").otherwise("CONFIRMED").alias("target_status"),
        "reviewer_tech_id",
        "signoff_at",
        "n_documents",
        "n_findings",
        F.col("n_pending_classifier").alias(f"n_{terms.prefix}_pending"),
        "n_pending_human",
        (
            (F.col("n_pending_classifier") == 0) & (F.col("n_pending_human") == 0) & F.col("signoff_at").isNotNull()
        ).alias("ready_for_attestation"),
    )
    return expect(payload, payload_rules(), "fail")


def review_status(
    cases: DataFrame,
    payload: DataFrame,
    attestations: DataFrame,
    verifications: DataFrame,
    terms: K.Terms = K.DEFAULT_TERMS,
) -> DataFrame:
    """Where every review stands.  It is final only while verified hashes equal today's hashes."""
    pending = f"n_{terms.prefix}_pending"
    counts = ["n_documents", "n_findings", pending, "n_pending_human"]
    hashes = ["input_hash", "analysis_hash", "reviewed_hash"]
    proof = payload.select("case_id", *hashes, "target_status", "signoff_at", "ready_for_attestation", *counts)
    receipt = attestations.select(
        "review_id", F.lit(True).alias("__sent"), "tx_signature", "pda_address", "cluster", "submitted_at"
    )
    reading = verifications.select(
        "review_id",
        F.lit(True).alias("__read"),
        F.col("tx_signature").alias("__read_tx"),
        "account_found",
        "tx_confirmed",
        *[f"onchain_{h}" for h in hashes],
        F.col("onchain_status").alias("__read_status"),
        "verified_at",
        "slot",
        F.col("error").alias("verification_error"),
    )
    joined = (
        cases.select("case_id", "review_id", "scenario", "created_at")
        .join(proof, "case_id", "left")
        .join(receipt, "review_id", "left")
        .join(reading, "review_id", "left")
    )
    equal = F.col("__read_status") == "ATTESTED"
    for h in hashes:
        equal = equal & (F.col(f"onchain_{h}") == F.col(h))
    failed = (
        F.col("verification_error").isNotNull()
        | ~F.coalesce("account_found", F.lit(False))
        | ~F.coalesce("tx_confirmed", F.lit(False))
    )
    onchain = (
        F.when(F.col("__sent").isNull(), "NOT_SUBMITTED")
        .when(F.col("__read").isNull() | (F.col("__read_tx") != F.col("tx_signature")), "SUBMITTED")
        .when(failed, "VERIFICATION_FAILED")
        .when(equal, "VERIFIED")
        .otherwise("HASH_MISMATCH")
    )
    shown = joined.select(
        "case_id",
        "review_id",
        "scenario",
        "created_at",
        *hashes,
        "target_status",
        "signoff_at",
        "ready_for_attestation",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        "tx_signature",
        "pda_address",
        "cluster",
        "submitted_at",
        "verified_at",
        "slot",
        "verification_error",
        onchain.alias("onchain_status"),
    )
    verified = F.col("onchain_status") == "VERIFIED"
    state = (
        F.when(verified, "ATTESTED")
        .when(F.col("n_documents") == 0, "CREATED")
        .when(F.col(pending) > 0, "PROCESSING")
        .when(F.col("n_pending_human") > 0, "HUMAN_REVIEW_REQUIRED")
        .when(F.col("signoff_at").isNull(), "AI_REVIEW_READY")
        .otherwise(F.col("target_status"))
    )
    return shown.withColumns({"review_state": state, "is_finalized": verified})
