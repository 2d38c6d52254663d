"""Scans of text columns for things that must not be there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sourcetrail import contract as K
from sourcetrail.functions.text import running_fold
from sourcetrail.operators.extract import page_lines


def hits(text: Column, patterns: dict[str, str]) -> Column:
    """Names of all patterns found in the text."""
    return F.filter(
        F.array(*[F.when(text.rlike(pattern), F.lit(name)) for name, pattern in patterns.items()]),
        lambda name: name.isNotNull(),
    )


def secret_scan(texts: DataFrame, key: list[str], text: str, patterns: dict[str, str]) -> DataFrame:
    """One row per text and kind of secret (by name of its pattern) found in it."""
    return texts.select(*key, F.explode(hits(F.col(text), patterns)).alias("kind"))


def residual_identifiers(texts: DataFrame, columns: list[str], patterns: dict[str, str] | None = None) -> DataFrame:
    """How many texts still show an identifier, per column and kind."""
    patterns = {k: K.INLINE_IDENTIFIERS[k] for k in ("cpf", "email")} if patterns is None else patterns
    pairs = [(column, kind) for column in columns for kind in patterns]
    counted = texts.agg(
        *[F.count_if(F.col(column).rlike(patterns[kind])).alias(f"n_{i}") for i, (column, kind) in enumerate(pairs)]
    )
    rows = [
        F.struct(F.lit(column).alias("column_name"), F.lit(kind).alias("kind"), F.col(f"n_{i}").alias("n_texts"))
        for i, (column, kind) in enumerate(pairs)
    ]
    return counted.select(F.inline(F.array(*rows)))


def claim_scan(
    texts: DataFrame,
    key: list[str],
    text: str,
    claim: str,
    negation: str,
) -> DataFrame:
    """Claims made without a negation before them on the same line, one row each."""
    lines = page_lines(texts.select(*key, text), text).where(F.col("line").rlike(claim))
    steps = F.zip_with(
        F.split("line", claim, -1),
        F.regexp_extract_all("line", F.lit(claim), F.lit(0)),
        lambda before, match: F.struct(before.alias("before"), match.alias("match")),
    )
    zero = F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit(None).cast("string").alias("claim"))

    def place(last: Column, part: Column) -> Column:
        start = last["end"] + F.length(part["before"])
        end = start + F.length(F.coalesce(part["match"], F.lit("")))
        return F.struct(start.alias("start"), end.alias("end"), part["match"].alias("claim"))

    found = lines.select(*key, "line_no", "line", F.inline(running_fold(steps, zero, place)))
    unguarded = ~F.substring(F.col("line"), F.lit(1), F.col("start")).rlike(negation)
    return found.where(F.col("claim").isNotNull() & unguarded).select(*key, "line_no", "claim")
