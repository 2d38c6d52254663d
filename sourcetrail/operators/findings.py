"""Findings: the four kinds of things a reviewer has to look at, with deterministic ids.

They come as two tables: heads, one row per finding, and sources, one row per entry of its evidence."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sourcetrail import contract as K
from sourcetrail.operators import evidence as E
from sourcetrail.operators.digest import GATHER_LIMIT, ordered_digest
from sourcetrail.operators.quality import expect, finding_rules, source_rules
from sourcetrail.session import materialize

KEY = ["finding_type", "finding_subtype", "case_id", "test_code", "exam_date"]
HEAD = [*KEY, "summary", "n_evidence"]


class Found(NamedTuple):
    """heads: finding_id, the key, summary, n_evidence and, where cases are known, review_id.  sources: finding_id, the
    key and the fields of one entry of evidence."""

    heads: DataFrame
    sources: DataFrame


def _day(column: str) -> Column:
    return F.date_format(column, "dd/MM/yyyy")


def _or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def _single(df: DataFrame) -> DataFrame:
    """Findings that rest on exactly one entry, which they hold as ``evidence``."""
    return df.withColumn("n_evidence", F.lit(1).cast("long")).select(*HEAD, "evidence")


def range_findings(measurements: DataFrame) -> DataFrame:
    """Values outside the range their own document states, where it states both bounds.  No shuffle."""
    stated = F.col("ref_low").isNotNull() & F.col("ref_high").isNotNull()
    outside = stated & ((F.col("value") < F.col("ref_low")) | (F.col("value") > F.col("ref_high")))
    flagged = measurements.where((F.col("value_status") == "OK") & outside)
    return _single(
        flagged.withColumns(
            {
                "finding_type": F.lit("OUT_OF_DOCUMENT_RANGE"),
                "finding_subtype": F.when(F.col("value") < F.col("ref_low"), "BELOW_DOCUMENT_RANGE").otherwise(
                    "ABOVE_DOCUMENT_RANGE"
                ),
                "summary": F.format_string(
                    K.RANGE_TEXT, "test_name_raw", "value_raw", _or_empty("unit"), "ref_low", "ref_high"
                ),
                "evidence": F.array(E.evidence_struct()),
            }
        )
    )


def gap_findings(gaps: DataFrame) -> DataFrame:
    return _single(
        gaps.withColumns(
            {
                "finding_type": F.lit("GAP"),
                "finding_subtype": F.col("gap_type"),
                "summary": F.col("description"),
            }
        )
    )


def _notable(threshold_pct: float) -> Column:
    large = F.abs("delta_pct") >= F.lit(float(threshold_pct))
    return (F.col("direction") == "UNIT_CHANGED") | large


def _variation_text() -> Column:
    changed_unit = F.format_string(
        K.UNIT_CHANGE_TEXT,
        "test_name_raw",
        _day("previous_date"),
        F.coalesce("previous_unit", F.lit(K.NO_UNIT_TEXT)),
        _day("exam_date"),
        F.coalesce("unit", F.lit(K.NO_UNIT_TEXT)),
    )
    changed_value = F.format_string(
        K.VARIATION_TEXT,
        "test_name_raw",
        "delta_pct",
        _day("previous_date"),
        "previous_value",
        _or_empty("previous_unit"),
        _day("exam_date"),
        "value",
        _or_empty("unit"),
    )
    return F.when(F.col("finding_subtype") == "UNIT_CHANGED", changed_unit).otherwise(changed_value)


def _version_text() -> Column:
    unit = F.coalesce("unit", F.lit(""))
    return F.concat("value_raw", F.lit(" "), unit, F.lit(" ("), "document_id", F.lit(" p."), F.col("page_num").cast("string"), F.lit(")"))


def _conflict_text(terms: K.Terms) -> Column:
    return F.format_string(K.CONFLICT_TEXT.format(system=terms.system), "test_name_raw", _day("exam_date"), "n_versions", "versions")


def flagged_groups(dated: DataFrame, threshold_pct: float = K.VARIATION_PCT) -> DataFrame:
    """Variations and conflicts, with the dates that are evidence of them."""
    conflict = F.col("n_versions") > 1
    varied = E.has_predecessor() & _notable(threshold_pct)
    return E.paired(dated).where(conflict | varied).select(
        F.when(conflict, "CONFLICT").otherwise("TEMPORAL_VARIATION").alias("finding_type"),
        F.when(conflict, "DIVERGENT_VALUES").otherwise(F.col("direction")).alias("finding_subtype"),
        *E.GROUP,
        "test_name_raw",
        "n_versions",
        # the earlier date is evidence of a variation, never of a conflict
        F.when(~conflict, F.col("previous_date")).alias("previous_date"),
        "previous_value",
        "value",
        "previous_unit",
        "unit",
        "delta_pct",
        F.when(conflict, F.col("n_evidence"))
        .otherwise(F.col("n_evidence") + F.col("previous_evidence"))
        .alias("n_evidence"),
    )


def grouped_findings(
    measurements: DataFrame,
    terms: K.Terms = K.DEFAULT_TERMS,
    threshold_pct: float = K.VARIATION_PCT,
    limit: int = GATHER_LIMIT,
) -> Found:
    """Variations and conflicts together: both fetch their evidence in the same join.

    Groups and evidence are written once, as ids, texts and sources all read them."""
    groups = materialize(flagged_groups(E.per_date(measurements), threshold_pct), "flagged-groups")
    dates = F.array_compact(F.array("previous_date", "exam_date"))
    entries = materialize(E.evidence_of(groups, KEY, dates, measurements), "flagged-evidence")
    texts = E.joined_versions(entries.where(F.col("finding_type") == "CONFLICT"), KEY, _version_text, "; ")
    frame = groups.select(*KEY, _id_prefix().alias("prefix"), F.lit("").alias("suffix"), F.col("n_evidence").alias("n_items"))
    ids = ordered_digest(entries, KEY, pointer_of(*POINTED), ",", frame, limit).withColumnRenamed("digest", "finding_id")
    ids = materialize(ids, "finding-ids")
    summary = F.when(F.col("finding_type") == "CONFLICT", _conflict_text(terms)).otherwise(_variation_text())
    heads = groups.join(texts, KEY, "left").withColumn("summary", summary).select(*HEAD).join(ids, KEY)
    return Found(heads.select("finding_id", *HEAD), entries.join(ids, KEY).select("finding_id", *KEY, *K.EVIDENCE_FIELDS))


POINTED = ["document_id", "page_num", "char_start"]


def pointer_of(document: Column | str, page: Column | str, start: Column | str) -> Column:
    """document:page:offset, leaving out what is unknown."""
    page, start = (F.col(c) if isinstance(c, str) else c for c in (page, start))
    return F.concat_ws(":", document, page.cast("string"), start.cast("string"))


def pointer(entry: Column) -> Column:
    return pointer_of(*[entry[name] for name in POINTED])


def joined_pointers(entries: DataFrame, keys: list[str]) -> DataFrame:
    """``evidence``: the pointers to all entries of a group as one text, sorted."""
    pointers = F.sort_array(F.collect_list(pointer_of(*POINTED)))
    return entries.groupBy(*keys).agg(F.array_join(pointers, ",").alias("evidence"))


#: Kinds of findings that rest on one entry each; equal ones have equal ids and may repeat.
SINGLE = ["OUT_OF_DOCUMENT_RANGE", "GAP"]


def with_pointers(heads: DataFrame, sources: DataFrame) -> DataFrame:
    """Heads with all pointers of their finding as ``evidence``."""
    placed = sources.select("finding_id", "finding_type", *POINTED)
    single = F.col("finding_type").isin(SINGLE)
    entries = placed.where(single).dropDuplicates(["finding_id"]).unionByName(placed.where(~single))
    return heads.join(joined_pointers(entries, ["finding_id"]), "finding_id", "left")


def _id_prefix() -> Column:
    return F.concat_ws(
        "|", "finding_type", "finding_subtype", "case_id", _or_empty("test_code"),
        F.coalesce(F.col("exam_date").cast("string"), F.lit("")), F.lit("")
    )


def with_finding_ids(rows: DataFrame) -> DataFrame:
    """Finding id of rows whose whole evidence is in the row."""
    # nearly all rows have one entry, whose pointer needs no array work
    several = F.array_join(F.sort_array(F.transform("evidence", pointer)), ",")
    pointers = F.when(F.size("evidence") == 1, pointer(F.col("evidence")[0])).otherwise(several)
    return rows.withColumn("finding_id", F.sha2(F.concat(_id_prefix(), pointers), 256))


def sources_of(rows: DataFrame) -> DataFrame:
    """Sources of findings that hold their evidence."""
    return rows.select("finding_id", *KEY, F.inline("evidence"))


def findings(
    measurements: DataFrame,
    gaps: DataFrame,
    cases: DataFrame | None = None,
    terms: K.Terms = K.DEFAULT_TERMS,
    threshold_pct: float = K.VARIATION_PCT,
    limit: int = GATHER_LIMIT,
) -> Found:
    """All findings.  One without a source, or of an unknown kind, aborts the run.

    ``limit`` is how many pointers one task gathers for an id; beyond, they are sorted over the cluster, with equal ids."""
    single = with_finding_ids(range_findings(measurements).unionByName(gap_findings(gaps)))
    grouped = grouped_findings(measurements, terms, threshold_pct, limit)
    heads = single.select("finding_id", *HEAD).unionByName(grouped.heads)
    if cases is not None:
        heads = heads.join(cases.select("case_id", "review_id"), "case_id", "left")
    sources = sources_of(single).unionByName(grouped.sources)
    return Found(expect(heads, finding_rules(), "fail"), expect(sources, source_rules(), "fail"))
