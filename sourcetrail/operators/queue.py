"""Review queue: findings, the classifier's answer, the reviewer's action and the safety rules.

Safety rules override the classifier and never the other way round."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sourcetrail import contract as K


def _listed(marks: dict[str, Column]) -> Column:
    return F.filter(F.array(*[F.when(c, F.lit(name)) for name, c in marks.items()]), lambda x: x.isNotNull())


def enrich(
    findings: DataFrame, classified: DataFrame, reviewed: DataFrame, terms: K.Terms = K.DEFAULT_TERMS
) -> DataFrame:
    """Findings with the newest classifier answer and the newest reviewer action."""
    t = terms.field
    answers = classified.select(
        "finding_id",
        F.lit(True).alias("__answered"),
        F.col(t("response_valid")).alias("__valid"),
        F.col("needs_review").alias(t("needs_review")),
        F.col("priority").alias(t("priority")),
        F.col("is_clear").alias(t("is_clear")),
        t("model"),
        t("prompt_version"),
        F.col("decided_at").alias(t("decided_at")),
    )
    actions = reviewed.where(F.col("scope") == "FINDING").select(
        F.col("review_id").alias("__reviewed"),
        F.col("finding_id").alias("__decided"),
        F.col("action").alias("reviewer_action"),
        "corrected_value",
        "corrected_unit",
        "reviewer_tech_id",
        F.col("decided_at").alias("reviewer_decided_at"),
    )
    # the review is compared as a range, so that rows dealt by their finding serve both joins: as a second key it would
    # send every row with its texts over the network once more
    same_review = F.col("__reviewed").between(F.col("review_id"), F.col("review_id"))
    decided = (F.col("finding_id") == F.col("__decided")) & same_review
    joined = findings.join(answers, "finding_id", "left").join(actions, decided, "left")
    return joined.select(
        *[F.col(c) for c in findings.columns],
        F.col("__answered").isNotNull().alias(f"has_{terms.prefix}"),
        F.coalesce("__valid", F.lit(False)).alias(t("valid")),
        *[t(c) for c in ("needs_review", "priority", "is_clear", "model", "prompt_version", "decided_at")],
        *[c for c in actions.columns if c not in ("__reviewed", "__decided")],
    )


def apply_safety(joined: DataFrame, terms: K.Terms = K.DEFAULT_TERMS) -> DataFrame:
    """Status, priority, reasons, flags and state of every finding.  Column expressions only."""
    t, code = terms.field, terms.code
    answered, valid = F.col(f"has_{terms.prefix}"), F.col(t("valid"))
    wants_review, clear, priority = F.col(t("needs_review")), F.col(t("is_clear")), F.col(t("priority"))
    conflict, gap = F.col("finding_type") == "CONFLICT", F.col("finding_type") == "GAP"
    forced = conflict | gap
    low_conflict = conflict & (priority == "baixa")

    judged = joined.withColumns(
        {
            t("status"): F.when(~answered, "PENDING").when(~valid, "INVALID").otherwise("OK"),
            "needs_review_final": F.coalesce(forced | ~answered | ~valid | wants_review | ~clear, F.lit(True)),
            "priority_final": F.when(~answered | ~valid, "alta").when(low_conflict, "media").otherwise(priority),
            "priority_reason": F.when(~answered, f"DEFAULT_HIGH_{code}_PENDING")
            .when(~valid, f"DEFAULT_HIGH_{code}_INVALID")
            .when(low_conflict, "CONFLICT_MIN_MEDIUM")
            .otherwise(f"{code}_PRIORITY"),
            "review_reasons": _listed(
                {
                    "CONFLICT_ALWAYS_REVIEWED": conflict,
                    "GAP_ALWAYS_REVIEWED": gap,
                    f"{code}_PENDING": ~answered,
                    f"{code}_INVALID_RESPONSE": answered & ~valid,
                    f"{code}_REQUESTED_REVIEW": valid & wants_review,
                    f"{code}_LOW_CLARITY": valid & ~clear,
                }
            ),
            "safety_flags": _listed(
                {
                    "FORCED_REVIEW_CONFLICT": conflict,
                    "FORCED_REVIEW_GAP": gap,
                    f"{code}_PENDING": ~answered,
                    f"{code}_INVALID_SCHEMA": answered & ~valid,
                    "LOW_CLARITY": valid & ~clear,
                    f"{code}_OVERRIDDEN": valid & ~wants_review & forced,
                }
            ),
        }
    )
    action = F.col("reviewer_action")
    return judged.withColumns(
        {
            "finding_state": F.when(action == "CONFIRM", "CONFIRMED")
            .when(action == "CORRECT", "CORRECTED")
            .when(action == "REJECT", "REJECTED")
            .when(F.col(t("status")) == "PENDING", f"AWAITING_{code}")
            .when(F.col("needs_review_final"), "HUMAN_REVIEW_REQUIRED")
            .otherwise("AI_REVIEW_READY"),
            "priority_rank": F.when(F.col("priority_final") == "alta", 1)
            .when(F.col("priority_final") == "media", 2)
            .otherwise(3),
        }
    )


def review_queue(
    findings: DataFrame, classified: DataFrame, reviewed: DataFrame, terms: K.Terms = K.DEFAULT_TERMS
) -> DataFrame:
    return apply_safety(enrich(findings, classified, reviewed, terms), terms)
