"""Documents to pages, pages to measurements.

Both steps work inside one row (array functions over the page list and the line list), so they run
without a shuffle, treat pages of any length the same way, and accept streaming frames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sourcetrail import contract as K
from sourcetrail.functions import text as X

PAGE_BREAK = "\f"


def text_pages(content: Column) -> Column:
    """Pages of a UTF-8 text document separated by form feeds; NULL if the bytes are not UTF-8."""
    text = content.cast("string")
    return F.when(F.is_valid_utf8(text), F.split(text, PAGE_BREAK, -1))


def document_pages(
    documents: DataFrame,
    pages: Column,
    error: Column | None = None,
    marker: str = K.DECLARATION_MARKER,
    mask: Callable[[Column], Column] | None = X.mask_identifiers,
) -> DataFrame:
    """One row per page, identifiers masked; a document without pages keeps one row with NULLs.

    The whole document is blanked when none of its pages carries the declaration."""
    hide = mask or (lambda text: text)
    prepared = documents.select(
        "*", X.fixed(pages).alias("__pages"), (F.lit(None).cast("string") if error is None else error).alias("__error")
    )
    declared = F.coalesce(F.exists("__pages", lambda page: X.declares(page, marker)), F.lit(False))
    prepared = prepared.select("*", X.fixed(declared).alias("synthetic_declared"))
    kept = [c for c in documents.columns if c not in ("content", "text")]
    fanned = prepared.select(
        *kept,
        F.col("__error").alias("parse_error"),
        "synthetic_declared",
        F.posexplode_outer("__pages").alias("__position", "__page"),
    )
    return fanned.select(
        *kept,
        "parse_error",
        "synthetic_declared",
        (F.col("__position") + 1).cast("int").alias("page_num"),
        X.fixed(
            F.when(F.col("synthetic_declared") & F.col("__position").isNotNull(), hide(F.col("__page")))
        ).alias("page_text"),
    ).select(
        *kept,
        "parse_error",
        "synthetic_declared",
        "page_num",
        "page_text",
        X.is_textual(F.col("page_text")).alias("is_textual"),
        F.current_timestamp().alias("extracted_at"),
    )


def declared_documents(pages: DataFrame, keys: list[str], text: str, marker: str = K.DECLARATION_MARKER) -> DataFrame:
    """The declaration gate where pages already are rows: one flag per document, combined map-side."""
    return pages.groupBy(*keys).agg(
        F.coalesce(F.bool_or(X.declares(F.col(text), marker)), F.lit(False)).alias("synthetic_declared")
    )


def page_lines(pages: DataFrame, text: str = "page_text", keep: list[str] | None = None) -> DataFrame:
    """Every line with its number and character offsets, terminators included in the line."""
    keep = [c for c in pages.columns if c != text] if keep is None else keep
    return pages.select(*keep, F.posexplode(X.line_table(F.col(text))).alias("__at", "__row")).select(
        *keep,
        (F.col("__at") + 1).cast("int").alias("line_no"),
        F.col("__row.start").alias("char_start"),
        F.col("__row.end").alias("char_end"),
        F.col("__row.line").alias("line"),
    )


def _dated_lines(text: Column) -> Column:
    """Lines with their end and the number and text of the date line that governs each of them, if any.

    Only two numbers per line go through the fold.  The governing *line* is carried, not its date: an impossible date
    thereby clears the date of the lines below it and still stays visible as their source."""

    def dated(lines: Column) -> Column:
        def step(line: Column, at: Column) -> Column:
            sets_date = F.contains(line, F.lit(":")) & line.rlike(K.DATE_LINE_NEEDS) & line.rlike(K.DATE_LINE)
            return F.struct(F.length(line).alias("n"), F.when(sets_date, at + 1).otherwise(0).alias("at"))

        def carried(last: Column, line: Column) -> Column:
            by = F.when(line["at"] > 0, line["at"]).otherwise(last["by"])
            return F.struct((last["end"] + line["n"]).alias("end"), by.alias("by"))

        states = X.running_fold(F.transform(lines, step), F.struct(F.lit(0).alias("end"), F.lit(0).alias("by")), carried)
        return F.zip_with(
            lines,
            states,
            lambda line, s: F.struct(
                line.alias("line"), s["end"].alias("end"), s["by"].alias("by"), F.get(lines, s["by"] - 1).alias("date_line")
            ),
        )

    return X.let(X.split_lines(text), dated)


def _none_if_empty(value: Column) -> Column:
    return F.when(value != "", value)


def test_code_of(name: Column, synonyms: dict[str, str]) -> tuple[Column, Column]:
    key = X.name_key(name)
    return _code(key, X.literal_lookup(key, synonyms))


def _code(key: Column, known: Column) -> tuple[Column, Column]:
    slug = F.regexp_replace(F.regexp_replace(F.upper(key), "[^A-Z0-9]+", "_"), "^_+|_+$", "")
    return F.coalesce(known, F.concat(F.lit("UNK_"), slug)), known.isNotNull()


def with_test_codes(
    named: DataFrame, synonyms: dict[str, str] | DataFrame, name: str = "test_name_raw", key: Column | None = None
) -> DataFrame:
    """Rows with ``test_code`` and ``test_known`` for their names.

    ``synonyms`` is a dictionary, which becomes a literal, or a table of any size with ``name`` and ``test_code``, which is
    joined; a stream is joined to it as it stands.  Names are compared by their key, which the caller may have at hand; of a
    name's codes the smallest counts."""
    keyed = named.select("*", X.fixed(X.name_key(F.col(name)) if key is None else key).alias("__key"))
    if isinstance(synonyms, dict):
        code, known = _code(F.col("__key"), X.literal_lookup(F.col("__key"), synonyms))
        both = X.fixed(F.struct(code.alias("test_code"), known.alias("test_known")))
        return keyed.select("*", both.alias("__test")).select(*named.columns, "__test.*")
    table = synonyms.select(X.name_key(F.col("name")).alias("__key"), F.col("test_code").alias("__code"))
    table = table.groupBy("__key").agg(F.min("__code").alias("__code"))
    keyed = keyed.join(table, "__key", "left")
    code, known = _code(F.col("__key"), F.col("__code"))
    return keyed.select(*named.columns, code.alias("test_code"), known.alias("test_known"))


def measurement_id() -> Column:
    return F.sha2(F.concat_ws("|", "document_id", "page_num", "char_start"), 256)


def extract_measurements(pages: DataFrame, synonyms: dict[str, str] | DataFrame | None = None) -> DataFrame:
    """Results found on readable pages, each with the exact place it came from."""
    synonyms = K.TEST_SYNONYMS if synonyms is None else synonyms
    place = ["case_id", "document_id", "page_num", "ingested_at"]
    lines = (
        pages.where(F.col("is_textual") & F.col("synthetic_declared"))
        .select(*place, F.posexplode(_dated_lines(F.col("page_text"))).alias("__at", "__row"))
        .where((F.col("__row.by") != F.col("__at") + 1) & F.contains(F.col("__row.line"), F.lit(":")))
        .select("*", X.fixed(X.strip_left(F.col("__row.line"))).alias("__left"))
        .select("*", X.fixed(X.strip_right(F.col("__left"))).alias("source_text"))
        .select(
            *place,
            (F.col("__at") + 1).cast("int").alias("line_no"),
            (F.col("__row.end") - F.length("__left")).alias("char_start"),
            (F.col("__row.end") - F.length("__left") + F.length("source_text")).alias("char_end"),
            "source_text",
            F.col("__row.date_line").alias("__date_line"),
        )
    )
    source = F.col("source_text")
    strict, loose = F.col("__strict"), F.col("__loose")
    matched = (
        lines.select("*", X.fixed(X.match_groups(source, K.RESULT_LINE, 5)).alias("__strict"))
        .select("*", X.fixed(F.when(strict.isNull(), X.match_groups(source, K.LOOSE_LINE, 2))).alias("__loose"))
        .where(strict.isNotNull() | loose.isNotNull())
        .withColumn("date_source_text", X.strip(F.col("__date_line")))
    )
    value_raw = F.coalesce(strict[1], loose[1])
    token = F.col("__token")
    status = (
        F.when(strict.isNull(), "AMBIGUOUS")
        .when(token.isin(K.ILLEGIBLE_TOKENS), "ILLEGIBLE")
        .when(token.isin(K.MISSING_TOKENS), "MISSING")
        .otherwise("OK")
    )
    named = matched.select(
        "*",
        X.fixed(X.strip(F.coalesce(strict[0], loose[0]))).alias("test_name_raw"),
    ).select("*", X.fixed(X.fold_case(value_raw)).alias("__token")).select(
        "*", value_raw.alias("value_raw"), status.alias("value_status"),
        X.fixed(X.fold_case(F.col("test_name_raw"))).alias("__folded"),
    )
    coded = with_test_codes(named, synonyms, key=X.folded_key(F.col("__folded"))).where(
        (strict.isNotNull() | F.col("test_known"))
        & ~F.col("__folded").isin(K.NON_RESULT_NAMES)
    )

    def group(number: int) -> Column:
        return _none_if_empty(strict[number])

    return coded.select(
        *place,
        "line_no",
        "char_start",
        "char_end",
        "source_text",
        X.calendar_date(F.regexp_extract("date_source_text", K.DATE_LINE, 1)).alias("exam_date"),
        "date_source_text",
        "test_name_raw",
        "test_code",
        "test_known",
        "value_raw",
        F.when(F.col("value_status") == "OK", X.decimal_comma(F.col("value_raw"))).alias("value"),
        "value_status",
        group(2).alias("unit"),
        X.decimal_comma(group(3)).alias("ref_low"),
        X.decimal_comma(group(4)).alias("ref_high"),
        F.lit(K.EXTRACTOR_VERSION).alias("extractor_version"),
        measurement_id().alias("measurement_id"),
        F.current_timestamp().alias("processed_at"),
    )


def misplaced_evidence(measurements: DataFrame, pages: DataFrame) -> DataFrame:
    """Measurements whose offsets do not lead back to their source text; empty when all is well."""
    texts = pages.select("document_id", "page_num", "page_text")
    found = F.substring(
        F.col("page_text"), F.col("char_start") + 1, F.col("char_end") - F.col("char_start")
    )
    joined = measurements.join(texts, ["document_id", "page_num"], "left")
    return joined.where(~F.coalesce(found == F.col("source_text"), F.lit(False))).select(measurements.columns)
