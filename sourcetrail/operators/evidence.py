"""Timeline, conflicts, changes over time and gaps of measurements.

Grouped results hold counts and keys only.  The evidence behind them is a table of its own with one row
per entry, so even a group with a third of all measurements is spread over many tasks and nothing is left out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sourcetrail import contract as K

GROUP = ["case_id", "test_code", "exam_date"]


def evidence_struct(**changed: Column) -> Column:
    return F.struct(*[changed.get(name, F.col(name)).alias(name) for name in K.EVIDENCE_FIELDS])


def unit_key(unit: Column) -> Column:
    return F.lower(F.coalesce(unit, F.lit("")))


def version_key() -> Column:
    return F.concat_ws("|", F.col("value").cast("string"), unit_key(F.col("unit")))


def usable(measurements: DataFrame) -> DataFrame:
    return measurements.where((F.col("value_status") == "OK") & F.col("exam_date").isNotNull())


def timeline(measurements: DataFrame) -> DataFrame:
    """All measurements with the position of their date within the case.

    The ranking runs over the distinct dates of a case, which a calendar bounds, and is then
    joined to the measurements; the window never sees the measurements of a large case.  An
    undated measurement takes the first position, and shows none."""
    dates = measurements.select("case_id", "exam_date").distinct()
    position = F.dense_rank().over(Window.partitionBy("case_id").orderBy(F.col("exam_date").asc_nulls_first()))
    ranked = dates.withColumn("timeline_position", position).where(F.col("exam_date").isNotNull())
    # undated rows find no partner: they are dealt out by their id instead of meeting in one task
    spread = F.when(F.col("exam_date").isNull(), F.xxhash64("measurement_id")).otherwise(F.lit(0).cast("long"))
    keyed = measurements.withColumn("__spread", spread)
    ranked = ranked.withColumn("__spread", F.lit(0).cast("long"))
    return keyed.join(ranked, ["case_id", "exam_date", "__spread"], "left").select(
        "case_id",
        "exam_date",
        "timeline_position",
        "test_code",
        "test_name_raw",
        "value_raw",
        "value",
        "unit",
        "ref_low",
        "ref_high",
        "value_status",
        *K.EVIDENCE_FIELDS,
        "date_source_text",
        "measurement_id",
    )


def per_date(measurements: DataFrame) -> DataFrame:
    """Per case, test and date: how many versions of the result exist and how much evidence.

    Versions are collapsed first, so counting them is a plain count."""
    versions = (
        usable(measurements)
        .groupBy(*GROUP, version_key().alias("version"))
        .agg(
            F.min("test_name_raw").alias("test_name_raw"),
            F.min("value").alias("value"),
            F.min("unit").alias("unit"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    return versions.groupBy(*GROUP).agg(
        F.min("test_name_raw").alias("test_name_raw"),
        F.count(F.lit(1)).alias("n_versions"),
        F.min("value").alias("value"),
        F.min("unit").alias("unit"),
        F.sum("n").alias("n_evidence"),
    )


def conflicts(dated: DataFrame) -> DataFrame:
    """Groups that state more than one version; none of them is chosen."""
    return dated.where(F.col("n_versions") > 1).select(*GROUP, "test_name_raw", "n_versions", "n_evidence")


def paired(dated: DataFrame) -> DataFrame:
    """Every date next to the unambiguous date before it, with the change between the two.

    Dates with one version and dates with several form separate series, so one window pass serves
    both the comparison and the conflicts; only the first kind of series has a meaning as a sequence."""
    series = Window.partitionBy("case_id", "test_code", F.col("n_versions") == 1).orderBy("exam_date")
    rows = dated.withColumns(
        {
            "previous_date": F.lag("exam_date").over(series),
            "previous_value": F.lag("value").over(series),
            "previous_unit": F.lag("unit").over(series),
            "previous_evidence": F.lag("n_evidence").over(series),
        }
    )
    same_unit = unit_key(F.col("previous_unit")) == unit_key(F.col("unit"))
    change = F.col("value") - F.col("previous_value")
    rows = rows.withColumns(
        {
            "same_unit": same_unit,
            "delta_abs": F.when(same_unit, F.round(change, 4)),
            "delta_pct": F.when(
                same_unit & (F.col("previous_value") != 0),
                F.round(100 * change / F.nullif(F.abs("previous_value"), F.lit(0.0)), 2),
            ),
        }
    )
    direction = (
        F.when(~F.col("same_unit"), "UNIT_CHANGED")
        .when(F.col("delta_pct").isNull(), "NOT_COMPARABLE")
        .when(F.abs("delta_pct") < K.STABLE_PCT, "STABLE")
        .when(F.col("delta_pct") > 0, "UP")
        .otherwise("DOWN")
    )
    return rows.withColumn("direction", direction)


def has_predecessor() -> Column:
    return (F.col("n_versions") == 1) & F.col("previous_date").isNotNull()


def temporal_comparison(dated: DataFrame) -> DataFrame:
    """Each unambiguous date against the one before it."""
    return (
        paired(dated)
        .where(has_predecessor())
        .select(
            "case_id",
            "test_code",
            "test_name_raw",
            "previous_date",
            "exam_date",
            F.datediff("exam_date", "previous_date").alias("days_between"),
            "previous_value",
            "value",
            "previous_unit",
            "unit",
            "delta_abs",
            "delta_pct",
            "direction",
            (F.col("n_evidence") + F.col("previous_evidence")).alias("n_evidence"),
        )
    )


def evidence_of(groups: DataFrame, keys: list[str], dates: Column, measurements: DataFrame) -> DataFrame:
    """Evidence of every group, one row per entry: the keys, the date it is of, its fields, stated value and unit.

    ``dates`` lists the dates of a group whose measurements count; ``keys`` hold its case and test."""
    wanted = groups.select(*keys, F.explode(dates).alias("evidence_date"))
    entries = usable(measurements).select(
        "case_id", "test_code", F.col("exam_date").alias("evidence_date"), *K.EVIDENCE_FIELDS, "value_raw", "unit"
    )
    rows = wanted.join(entries, ["case_id", "test_code", "evidence_date"])
    return rows.select(*keys, "evidence_date", *K.EVIDENCE_FIELDS, "value_raw", "unit")


def comparison_evidence(comparison: DataFrame, measurements: DataFrame) -> DataFrame:
    """Evidence of every compared pair of dates, of the earlier date and of the later one."""
    return evidence_of(comparison, GROUP, F.array("previous_date", "exam_date"), measurements)


def joined_versions(evidence: DataFrame, keys: list[str], text: Callable[[], Column], separator: str) -> DataFrame:
    """``versions``: the distinct stated versions of a group as one text, in the order in which documents state them.

    Versions are reduced to distinct ones, joined per document, and the documents' texts then joined in order: the last
    step sees one text per document of the group, and the whole stands once, beside the group."""
    stated = ["document_id", "page_num", "value_raw", "unit"]
    first = evidence.groupBy(*keys, *stated).agg(F.min("line_no").alias("line"), F.min("char_start").alias("char"))
    own = F.struct("page_num", "line", "char", "value_raw", "unit", text().alias("text"))
    documents = first.groupBy(*keys, "document_id").agg(F.sort_array(F.collect_list(own)).alias("own"))
    documents = documents.select(
        *keys, F.struct("document_id", F.array_join(F.transform("own", lambda v: v["text"]), separator).alias("text")).alias("d")
    )
    whole = documents.groupBy(*keys).agg(F.sort_array(F.collect_list("d")).alias("all"))
    return whole.select(*keys, F.array_join(F.transform("all", lambda d: d["text"]), separator).alias("versions"))


def _gap_list(conditions: dict[str, Column]) -> Column:
    marks = [F.when(condition, F.lit(name)) for name, condition in conditions.items()]
    return F.filter(F.array(*marks), lambda gap: gap.isNotNull())


def measurement_gap_conditions() -> dict[str, Column]:
    ok = F.col("value_status") == "OK"
    return {
        "MISSING_DATE": F.col("exam_date").isNull(),
        "ILLEGIBLE_VALUE": F.col("value_status") == "ILLEGIBLE",
        "MISSING_VALUE": F.col("value_status") == "MISSING",
        "AMBIGUOUS_VALUE": F.col("value_status") == "AMBIGUOUS",
        "MISSING_UNIT": ok & F.col("unit").isNull(),
        "MISSING_REFERENCE_RANGE": ok & (F.col("ref_low").isNull() | F.col("ref_high").isNull()),
        "UNMAPPED_TEST": ~F.col("test_known"),
    }


def measurement_gaps(measurements: DataFrame, terms: K.Terms = K.DEFAULT_TERMS) -> DataFrame:
    """One row per gap of a measurement: a single pass, no shuffle."""
    text = F.lit(None).cast("string")
    for gap, (before, after) in K.MEASUREMENT_GAP_TEXT.items():
        sentence = F.concat(F.lit(before), F.col("test_name_raw"), F.lit(after.format(system=terms.system)))
        text = F.when(F.col("gap_type") == gap, sentence).otherwise(text)
    return measurements.withColumn("gap_type", F.explode(_gap_list(measurement_gap_conditions()))).select(
        "case_id",
        "gap_type",
        "test_code",
        "exam_date",
        "document_id",
        "page_num",
        text.alias("description"),
        F.array(evidence_struct()).alias("evidence"),
    )


def document_gaps(pages: DataFrame) -> DataFrame:
    """Unreadable and undeclared documents once each, pages without text once per page."""
    gap = (
        F.when(F.col("parse_error").isNotNull(), "DOCUMENT_UNREADABLE")
        .when(~F.col("synthetic_declared"), "NOT_SYNTHETIC_DOCUMENT")
        .when(~F.col("is_textual"), "NON_TEXTUAL_PAGE")
    )
    once = (F.col("gap_type") == "NON_TEXTUAL_PAGE") | (F.coalesce("page_num", F.lit(1)) == 1)
    text = F.lit(None).cast("string")
    for name, sentence in K.DOCUMENT_GAP_TEXT.items():
        text = F.when(F.col("gap_type") == name, F.lit(sentence)).otherwise(text)
    nothing = F.lit(None).cast("int")
    return (
        pages.withColumn("gap_type", gap)
        .where(F.col("gap_type").isNotNull() & once)
        .select(
            "case_id",
            "gap_type",
            F.lit(None).cast("string").alias("test_code"),
            F.lit(None).cast("date").alias("exam_date"),
            "document_id",
            "page_num",
            text.alias("description"),
            F.array(
                evidence_struct(line_no=nothing, char_start=nothing, char_end=nothing, source_text=F.lit(""))
            ).alias("evidence"),
        )
    )


def all_gaps(measurements: DataFrame, pages: DataFrame, terms: K.Terms = K.DEFAULT_TERMS) -> DataFrame:
    return measurement_gaps(measurements, terms).unionByName(document_gaps(pages))
