"""Queries a portal asks, with named parameters.  Without a parameter they cover all cases.

Every order ends in an id: rows that tie in the wanted order can then still be sorted apart, so no
range of the sort has to take all rows of one value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sourcetrail import contract as K


def bound(df: DataFrame, **params) -> DataFrame:
    """Rows whose columns equal the given parameters, bound by name and never spliced into text."""
    given = {name: value for name, value in params.items() if value is not None}
    if not given:
        return df
    condition = " AND ".join(f"{name} = :{name}" for name in given)
    return df.sparkSession.sql(f"SELECT * FROM {{source}} WHERE {condition}", args=given, source=df)


def case_list(status: DataFrame) -> DataFrame:
    shown = ["case_id", "review_id", "scenario", "review_state", "onchain_status", "is_finalized", "n_documents",
             "n_findings", "n_pending_human", "tx_signature", "submitted_at", "verified_at"]
    return status.orderBy(F.desc("created_at"), "case_id").select(*shown)


def case_queue(queue: DataFrame, case_id: str | None = None, terms: K.Terms = K.DEFAULT_TERMS) -> DataFrame:
    t = terms.field
    shown = ["finding_id", "finding_type", "finding_subtype", "test_code", "exam_date", "summary", t("status"),
             t("needs_review"), t("priority"), t("is_clear"), t("model"), t("prompt_version"), "needs_review_final",
             "review_reasons", "priority_final", "priority_reason", "safety_flags", "finding_state",
             "reviewer_action", "corrected_value", "corrected_unit"]
    return bound(queue, case_id=case_id).orderBy("priority_rank", "finding_type", "exam_date", "finding_id").select(*shown)


def finding_sources(sources: DataFrame, finding_id: str | None = None) -> DataFrame:
    return bound(sources, finding_id=finding_id).select(*K.EVIDENCE_FIELDS)


def page_text(pages: DataFrame, document_id: str | None = None, page_num: int | None = None) -> DataFrame:
    return bound(pages, document_id=document_id, page_num=page_num).select("page_text")


def case_timeline(timeline: DataFrame, case_id: str | None = None) -> DataFrame:
    shown = ["exam_date", "timeline_position", "test_code", "test_name_raw", "value_raw", "unit", "value_status",
             "document_id", "page_num", "source_text"]
    ordered: list[Column] = [F.col("exam_date").asc_nulls_last(), F.col("test_code"), F.col("measurement_id")]
    return bound(timeline, case_id=case_id).orderBy(*ordered).select(*shown)


def case_comparison(comparison: DataFrame, case_id: str | None = None) -> DataFrame:
    shown = ["test_code", "test_name_raw", "previous_date", "exam_date", "previous_value", "value", "unit",
             "delta_abs", "delta_pct", "direction"]
    return bound(comparison, case_id=case_id).orderBy("test_code", "exam_date", "case_id").select(*shown)


def review_payload(payload: DataFrame, review_id: str | None = None) -> DataFrame:
    shown = ["review_id", "input_hash", "analysis_hash", "reviewed_hash", "workflow_version", "model_version",
             "target_status", "reviewer_tech_id", "signoff_at", "ready_for_attestation"]
    return bound(payload, review_id=review_id).select(*shown)


def metrics_list(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy("case_id")
