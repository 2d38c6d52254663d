"""Language of web pages by Bayesian fusion of evidence.

The posterior of a language is the product of what the pieces of evidence say: the likelihood of the page's text under
byte-trigram models of labelled documents (tempered, as neighbouring trigrams are not independent), of the language the
markup declares, and a prior of the host.  Host priors are counts of the texts' own decisions, smoothed towards those of
the address suffix (the last label of the host), which are smoothed towards those of all pages; the tables come from
grouped aggregation.  How far declarations can be trusted is estimated from the same pages.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sourcetrail.llm.html_text import parse
from sourcetrail.llm.redirects import host_of
from sourcetrail.llm.tables import Scratch, ship, written

#: Cells that byte trigrams are hashed into; the models are a table of cells by languages.
CELLS = 1 << 14
#: Languages whose models are at hand at a time; where the labels name more, texts are scored by one block of them after
#: the other.
LANGUAGES = 64
#: Weight of a trigram's evidence against an independent one, and the most trigrams a text counts as.
TEMPER, MOST_EVIDENCE = 0.2, 400.0
#: Pseudo-counts of the level above in the smoothed host and suffix counts.
HOST_WEIGHT, SUFFIX_WEIGHT = 5.0, 20.0


def cells(text: str | None) -> np.ndarray:
    """Counts of the text's hashed byte trigrams; words are lower-cased and separated by single spaces."""
    data = np.frombuffer((" " + " ".join((text or "").lower().split()) + " ").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    if len(data) < 4:
        return np.zeros(CELLS, np.int64)
    h = (data[:-2] * np.uint32(65599) + data[1:-1]) * np.uint32(65599) + data[2:]
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return np.bincount((h >> np.uint32(18)).astype(np.int64), minlength=CELLS)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["lang", "cell", "n"])
        sums.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if lang not in sums:
                if len(sums) >= 4 * LANGUAGES:
                    yield from out()
                sums[lang] = np.zeros(CELLS, np.int64)
            sums[lang] += cells(text)
    yield from out()


def text_models(docs: DataFrame, scratch: Scratch) -> tuple[list[str], Iterator[np.ndarray]]:
    """All labelled languages by name, and by blocks of them the log-probabilities of their trigram cells (languages by
    cells), from docs (lang, text)."""
    docs = docs.where("lang is not null and text is not null").select("lang", "text")
    counted = docs.mapInArrow(_counts, "lang string, cell int, n long")
    counted = scratch.written(counted.groupBy("lang", "cell").agg(F.sum("n").alias("n")), "language-cells")
    seen = {r["lang"] for r in counted.select("lang").distinct().collect()}
    # a label may have texts without a trigram only
    names = sorted(seen | {r["lang"] for r in docs.select("lang").distinct().collect()})

    def blocks() -> Iterator[np.ndarray]:
        for at in range(0, len(names), LANGUAGES):
            place = {lang: i for i, lang in enumerate(names[at : at + LANGUAGES])}
            table = np.full((len(place), CELLS), 0.5)
            for r in counted.where(F.col("lang").isin(list(place))).collect():  # LANGUAGES * CELLS at most
                table[place[r["lang"]], r["cell"]] += r["n"]
            yield np.log(table / table.sum(1, keepdims=True))

    return names, blocks()


def _page_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The trigram cells of all of a page's text that is not dropped, and their counts."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            used, counts = [], []
            for source in part.column(1).to_pylist():
                n = cells(" ".join(b.text for b in parse(source).blocks if not b.dropped))
                used.append(np.flatnonzero(n).astype(np.int32))
                counts.append(n[used[-1]])
            columns = [part.column(0), pa.array(used, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64())), pa.array([[]] * len(used), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*columns, *part.columns[2:5]], names=["page_id", "cells", "counts", "text_log", "declared", "host", "suffix"])


def _scored(model: np.ndarray):
    """Appends the scores under the languages of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for used, n, before in zip(batch.column(1), batch.column(2), batch.column(3).to_pylist(), strict=True):
                used, n = used.values.to_numpy(), n.values.to_numpy()
                total = int(n.sum())
                scores = model[:, used] @ n
                scores = scores * (TEMPER * min(1.0, MOST_EVIDENCE / total)) if total else scores
                out.append(before + scores.tolist())
            yield batch.set_column(3, "text_log", pa.array(out, pa.list_(pa.float64())))

    return run


def _normal(logs: Column) -> Column:
    """Probabilities from an array of logarithms."""
    top = F.array_max(logs)
    shifted = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(shifted, F.lit(0.0), lambda a, x: a + x)
    return F.transform(shifted, lambda x: x / total)


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """page_id, lang (null if docs have no labelled text), probability, declared, host and host_pages of every page.

    pages: page_id, url, html; docs: text, lang.  Null html has no text and declares nothing, null urls have an empty
    host: such pages go by what is left, in the end by the prior of all pages.  Ties go to the first language by name;
    repeated rows stay repeated; empty pages give no rows; other columns are ignored.
    """
    ship(pages.sparkSession)
    scratch = Scratch()
    names, models = text_models(docs, scratch)
    tag = F.regexp_extract("html", r"(?is)<html\b[^>]*>", 0)
    declared = F.lower(F.regexp_extract(tag, r"(?is)\blang\s*=\s*[\"']?\s*([a-z]{2,3})", 1))
    host = F.coalesce(host_of(F.col("url")), F.lit(""))
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    pages = pages.select("page_id", "html", F.nullif(declared, F.lit("")).alias("declared"), host.alias("host"))
    pages = pages.withColumn("suffix", F.regexp_extract("host", r"([^.]*)$", 1))
    schema = "page_id long, cells array<int>, counts array<long>, text_log array<double>, declared string, host string, suffix string"
    seen = pages.mapInArrow(_page_cells, schema)
    for i, model in enumerate(models):
        # one block follows the first in a stage of its own, so a task holds one block at a time
        seen = (scratch.written(seen, "language-scores") if i else seen).mapInArrow(_scored(model), schema)
    top = F.transform("text_log", lambda x: x - F.array_max("text_log"))
    seen = written(seen.select("page_id", top.alias("text_log"), "declared", "host", "suffix"), "language-evidence")
    scratch.clear()
    if not names:
        return seen.select("page_id", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("probability"), "declared", "host", F.lit(None).cast("long").alias("host_pages"))

    # what the texts alone say, page by page and language by language
    votes = seen.select("declared", "host", "suffix", F.posexplode(_normal(F.col("text_log"))).alias("l", "p"))
    by_host = written(votes.groupBy("host", "suffix", "declared", "l").agg(F.sum("p").alias("p"), F.count("*").alias("n")), "language-votes")

    overall = {r["l"]: r["p"] for r in by_host.groupBy("l").agg(F.sum("p").alias("p")).collect()}
    total = sum(overall.values()) or 1.0
    base = F.array(*[F.lit((overall.get(i, 0.0) + 1.0) / (total + len(names))) for i in range(len(names))])

    def vector(df: DataFrame, *keys: str) -> DataFrame:
        """Sums of the probabilities by key, one array in the order of the languages."""
        sums = df.groupBy(*keys, "l").agg(F.sum("p").alias("p"))
        return sums.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("l", "p"))), lambda x: x["p"]).alias("counts"))

    def smoothed(counts: Column, above: Column, weight: float) -> Column:
        n = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(counts, above, lambda c, b: (c + weight * b) / (n + weight))

    suffixes = vector(by_host, "suffix").select(F.col("suffix").alias("s"), smoothed(F.col("counts"), base, SUFFIX_WEIGHT).alias("suffix_prior"))
    hosts = vector(by_host, "host", "suffix").join(suffixes, F.col("suffix") == F.col("s"))
    pages_of = F.aggregate("counts", F.lit(0.0), lambda a, x: a + x)
    hosts = hosts.select(F.col("host").alias("h"), smoothed(F.col("counts"), F.col("suffix_prior"), HOST_WEIGHT).alias("prior"), "suffix_prior", F.round(pages_of).cast("long").alias("host_pages"))
    # how often a language's pages declare what: logarithm of the share, smoothed
    per_language = Window.partitionBy("l")
    said = by_host.where("declared is not null").groupBy("declared", "l").agg(F.sum("p").alias("p"))
    kinds = said.select("declared").distinct().count()
    said = said.withColumn("share", F.log((F.col("p") + 0.5) / (F.sum("p").over(per_language) + 0.5 * (kinds + 1))))
    said = said.groupBy(F.col("declared").alias("d")).agg(F.transform(F.array_sort(F.collect_list(F.struct("l", "share"))), lambda x: x["share"]).alias("declared_log"))

    joined = seen.join(hosts, F.col("host") == F.col("h")).join(said, F.col("declared") == F.col("d"), "left")
    # the host prior already holds what the suffix says, as its level of the hierarchy
    log_prior = F.transform("prior", lambda x: F.log(x))
    logs = F.zip_with("text_log", log_prior, lambda a, b: a + b)
    none = F.array_repeat(F.lit(0.0), len(names))
    logs = F.zip_with(logs, F.coalesce("declared_log", none), lambda a, b: a + b)
    out = joined.select("page_id", _normal(logs).alias("p"), "declared", "host", "host_pages")
    best = F.array_max("p")
    return out.select("page_id", F.element_at(F.array(*map(F.lit, names)), F.array_position("p", best).cast("int")).alias("lang"), best.alias("probability"), "declared", "host", "host_pages")
