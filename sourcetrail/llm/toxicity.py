"""Toxicity by weak supervision.

Voters are short tests of a text: lexicon voters (a word, or a word beginning that inflected forms share) found by their
association with the label in labelled rows, and pattern voters (shouting, symbol runs, ...).  A generative label model
explains all votes by a hidden class: for each voter how often it fires in toxic and in clean texts, fitted by
expectation maximisation without looking at the labels of single rows; voters that fire together within a class are
estimated to be correlated and share their weight.  Its posteriors are the labels for a logistic regression, which gives
the score; its slope and level are set by the labelled rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sourcetrail.llm.tables import ship, written

#: Labelled rows that voters, label model and classifier are fitted on, at most; statistics above need no more.
FIT_ROWS = 20_000
#: Lexicon voters, at most.
LEXICON_VOTERS = 256
#: A voter must occur in so many fitted texts.
LEAST_TEXTS = 3
BEGINNINGS = (4, 5, 6, 7)

_WORD = re.compile(r"[^\W\d_]+")
PATTERNS = (
    ("shouting", re.compile(r"\b[A-ZÀ-Þ]{4,}\b(?:\W+[A-ZÀ-Þ]{2,}\b){3}")),
    ("exclaiming", re.compile(r"!{2,}")),
    ("asking", re.compile(r"\?{2,}")),
    ("symbols", re.compile(r"[%&$#*@]{3,}")),
    ("stretched", re.compile(r"([^\W\d_])\1{3,}")),
    ("second person", re.compile(r"\b(?:you|your|du|dein|tu|ton|tú)\b", re.IGNORECASE)),
    ("link", re.compile(r"https?://|www\.")),
)


@dataclass
class Voters:
    """Lexicon voters by their term: whole words, and beginnings of words."""

    words: dict[str, int]
    beginnings: dict[str, int]

    @property
    def size(self) -> int:
        return len(self.words) + len(self.beginnings) + len(PATTERNS)

    def fired(self, text: str | None) -> list[int]:
        """Numbers of the voters that fire on the whole text."""
        if not text:
            return []
        found, first = set(), len(self.words) + len(self.beginnings)
        for word in set(_WORD.findall(text.lower())):
            if word in self.words:
                found.add(self.words[word])
            for n in BEGINNINGS:
                if len(word) > n and word[:n] in self.beginnings:
                    found.add(self.beginnings[word[:n]])
        for i, (_, pattern) in enumerate(PATTERNS):
            if pattern.search(text):
                found.add(first + i)
        return sorted(found)


def association(toxic: int, clean: int, all_toxic: int, all_clean: int) -> float:
    """Log-likelihood ratio of a term's share in toxic texts against clean ones; 0 where it is not larger."""
    n, total = toxic + clean, all_toxic + all_clean
    if not toxic or toxic * all_clean <= clean * all_toxic:
        return 0.0

    def part(x: float, y: float) -> float:
        return x * math.log(x / y) if x > 0 else 0.0

    return 2 * (
        part(toxic, n * all_toxic / total)
        + part(clean, n * all_clean / total)
        + part(all_toxic - toxic, (total - n) * all_toxic / total)
        + part(all_clean - clean, (total - n) * all_clean / total)
    )


def choose_voters(rows: list[tuple[str, bool, int, int]], all_toxic: int, all_clean: int, n_terms: int) -> Voters:
    """The strongest terms, none within another: (term, is a beginning, toxic texts, clean texts)."""
    least = 2 * math.log(max(2, n_terms)) + 4
    scored = [(association(t, c, all_toxic, all_clean), term, start) for term, start, t, c in rows if t > c]
    scored = sorted((x for x in scored if x[0] >= least), key=lambda x: (-x[0], len(x[1]), x[1], x[2]))
    words, beginnings, number = {}, {}, 0
    for _, term, start in scored:
        if number == LEXICON_VOTERS:
            break
        if term in words or any(term[:n] in beginnings for n in BEGINNINGS if n <= len(term)):
            continue
        if start and any(x.startswith(term) for x in (*words, *beginnings)):
            continue
        (beginnings if start else words)[term] = number
        number += 1
    return Voters(words, beginnings)


def label_model(votes: np.ndarray, prior: float, start: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of the toxic class for each row of votes (0 or 1), and the voters' correlations within classes.

    start: first guess of the posteriors.  Of the voters that fire on a text, each counts 1 over 1 plus its correlations
    with the others that fire there; silent voters share their weight with all they are correlated with.
    """
    posterior, related = start.astype(float), np.zeros((votes.shape[1], votes.shape[1]))
    for _ in range(rounds):
        rates, related = [], np.zeros_like(related)
        anchored = (posterior + start) / 2  # the classes keep their meaning
        for p, held in ((posterior, anchored), (1 - posterior, 1 - anchored)):
            rate = np.clip((held @ votes + 0.5 * votes.mean(0)) / (held.sum() + 1), 1e-5, 1 - 1e-5)
            centred = (votes - p @ votes / (p.sum() + 1e-9)) * np.sqrt(p)[:, None]
            cov = centred.T @ centred / (p.sum() + 1)
            sd = np.sqrt(np.diag(cov)) + 1e-9
            corr = np.clip(cov / np.outer(sd, sd), 0, 1)
            np.fill_diagonal(corr, 0)
            related = np.maximum(related, np.where(corr > 0.1, corr, 0))
            rates.append(rate)
        on, off = np.log(rates[0] / rates[1]), np.log((1 - rates[0]) / (1 - rates[1]))
        logit = math.log(prior / (1 - prior)) + (votes / (1 + votes @ related)) @ on + (1 - votes) @ (off / (1 + related.sum(1)))
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        done = np.abs(new - posterior).max(initial=0) < 1e-4
        posterior = new
        if done:
            break
    return posterior, related


def fit_linear(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 25) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by Newton's method with a quadratic penalty on the weights."""
    design = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(design.shape[1])
    ridge = np.full(len(w), penalty)
    ridge[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (y - p) - ridge * w
        curve = (design * (p * (1 - p))[:, None]).T @ design + np.diag(ridge)
        step = np.linalg.solve(curve, gradient)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


@dataclass
class Model:
    voters: Voters
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        z = self.bias + sum(self.weights[i] for i in self.voters.fired(text))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _votes(voters: Voters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fired = [voters.fired(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fired, pa.list_(pa.int32()))], names=["toxic", "fired"])

    return run


def _beginnings(words: Column, n: int) -> Column:
    return F.transform(F.filter(words, lambda w: F.length(w) > n), lambda w: F.substring(w, 1, n))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """docs (doc_id, text), labels (doc_id, toxic 0 or 1), both only of rows that may be learned from.

    Labels of null and rows without a text are left out; of several labels of an id the mean decides; without labels of
    both kinds every score is the share of toxic ones.
    """
    ship(docs.sparkSession)
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id")
    known = known.agg((F.avg(F.col("toxic").cast("double")) >= 0.5).alias("toxic"))
    words = F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: w != ""))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)  # so small that it may be broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").where("text is not null").withColumn("words", words)
    # near copies would make all their words look telling: one of those with the same smallest word hashes stays
    mark = F.slice(F.array_sort(F.transform(F.filter("words", lambda w: F.length(w) > 5), lambda w: F.xxhash64(w))), 1, 4)
    rows = rows.withColumn("mark", F.when(F.size(mark) == 4, F.xxhash64(mark)).otherwise(F.xxhash64("text")))
    rows = rows.dropDuplicates(["mark", "toxic"])
    rows = written(rows.select("toxic", "text", "words"), "toxicity-sample")
    counts = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = counts.get(True, 0), counts.get(False, 0)
    if not n_toxic or not n_clean:
        share = (n_toxic + 0.5) / (n_toxic + n_clean + 1) if n_toxic else 0.0
        bias = math.log(share / (1 - share)) if share else -30.0
        return Model(Voters({}, {}), np.zeros(len(PATTERNS)), bias)

    starts = [_beginnings(F.col("words"), n) for n in BEGINNINGS]
    terms = F.concat(
        F.transform("words", lambda w: F.struct(w.alias("term"), F.lit(False).alias("start"))),
        F.transform(F.array_distinct(F.flatten(F.array(*starts))), lambda w: F.struct(w.alias("term"), F.lit(True).alias("start"))),
    )
    pairs = rows.select("toxic", F.explode(terms).alias("t")).select("toxic", "t.term", "t.start")
    table = written(
        pairs.groupBy("term", "start").agg(
            F.count_if("toxic").alias("toxic_texts"), F.count_if(~F.col("toxic")).alias("clean_texts")
        ),
        "toxicity-terms",
    )
    n_terms = table.count()
    strong = table.where((F.col("toxic_texts") >= LEAST_TEXTS) & (F.col("toxic_texts") > F.col("clean_texts")))
    # more than enough to choose from; the fit is bounded anyway
    strong = strong.orderBy(F.desc(F.col("toxic_texts") - F.col("clean_texts")), "term", "start").limit(50 * LEXICON_VOTERS)
    voters = choose_voters([tuple(r) for r in strong.collect()], n_toxic, n_clean, n_terms)

    fired = rows.select("toxic", "text").mapInArrow(_votes(voters), "toxic boolean, fired array<int>").collect()
    x = np.zeros((len(fired), voters.size))
    for i, r in enumerate(fired):
        x[i, r["fired"]] = 1
    prior = n_toxic / (n_toxic + n_clean)
    lexicon = len(voters.words) + len(voters.beginnings)
    guess = np.where(x[:, :lexicon].any(1), 0.98, 0.01)
    posterior, _ = label_model(x, prior, guess)
    weights, bias = fit_linear(x, posterior)
    # slope and level of the score, so that it can be read as a probability of the label
    slope, level = fit_linear((x @ weights + bias)[:, None], np.array([float(r["toxic"]) for r in fired]), penalty=0.1)
    slope = max(float(slope[0]), 0.0)
    return Model(voters, weights * slope, bias * slope + level)


def _scores(model: Model, n_columns: int, text_at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                scores = [model.score(t) for t in part.column(text_at).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(n_columns)] + [pa.array(scores, pa.float64())], names=names)

    return run


def with_scores(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """docs (any columns, among them text) with the toxicity score of each whole text; null and empty texts have the
    score of a text on which no voter fires.  Rows are kept as they are, repeated ones too; an input
    column of that name is replaced."""
    ship(docs.sparkSession)
    docs = docs.drop(column)
    names = [*docs.columns, column]
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])
    return docs.mapInArrow(_scores(model, len(docs.columns), docs.columns.index("text"), names), schema)
