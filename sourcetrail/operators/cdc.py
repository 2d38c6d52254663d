"""Change data capture: the last event per key wins, however late older ones arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sourcetrail import contract as K


def latest_by(df: DataFrame, keys: list[str], sequence_by: str) -> DataFrame:
    """Whole newest row per key (SCD type 1).

    A plain aggregate: each task first reduces its own events to one row per key, so a key with a
    third of all events crosses the network as one row per task.  Events with equal sequence are
    ordered by their remaining columns, which makes the result independent of arrival order."""
    rest = [c for c in df.columns if c not in keys and c != sequence_by]
    newest = F.max(F.struct(F.col(sequence_by), *[F.col(c) for c in rest])).alias("newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "newest.*").select(*df.columns)


def normalize_review_decisions(events: DataFrame) -> DataFrame:
    """Upper-case enumerations and give review-level events a fixed key in the finding column."""
    scope = F.upper("scope")
    return events.select(
        "review_id",
        scope.alias("scope"),
        F.when(scope == "REVIEW", F.lit(K.REVIEW_LEVEL_KEY)).otherwise(F.col("finding_id")).alias("finding_id"),
        F.upper("action").alias("action"),
        "corrected_value",
        "corrected_unit",
        "reviewer_tech_id",
        "decided_at",
    )


def answers_complete(priority: Column, needs_review: Column, is_clear: Column) -> Column:
    return priority.isin(K.PRIORITIES) & needs_review.isNotNull() & is_clear.isNotNull()


def normalize_classifier_decisions(events: DataFrame, terms: K.Terms = K.DEFAULT_TERMS) -> DataFrame:
    """Lower-case the priority and downgrade incomplete answers to invalid instead of dropping them."""
    valid = terms.field("response_valid")
    priority = F.lower("priority")
    complete = answers_complete(priority, F.col("needs_review"), F.col("is_clear"))
    wanted = [field.split()[0] for field in terms.decisions_feed.split(", ")]
    changed = {
        "priority": priority.alias("priority"),
        valid: (F.coalesce(F.col(valid), F.lit(False)) & complete).alias(valid),
    }
    return events.select(*[changed.get(name, F.col(name)) for name in wanted])


LINEAGE_COLUMNS = ["_rescued_data", "_source_file", "_ingested_at"]
