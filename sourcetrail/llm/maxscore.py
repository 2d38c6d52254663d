"""Exact top-k search by inner product with MaxScore.

Vectors of integers are read as documents of terms: dimension d stands for two terms, its positive and its negative part.
A query matches the terms whose sign agrees with its own; the others take away from the score.  Candidates are packed into
shards with postings by term.  For a query, the largest contribution of each of its terms within a shard bounds the term;
terms are ordered by bound, and those whose bounds together cannot reach the k-th best score so far are non-essential.
Only the postings of the essential terms are traversed; for what they reach, the non-essential terms are probed from the
largest bound down, as long as the candidate can still compete.  Shards pass their k best on, which are merged by query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sourcetrail.llm.tables import ship, written

#: Vectors of a shard and queries of a block: what one task holds at a time.
SHARD_ROWS, BLOCK_ROWS = 8192, 1024
#: Non-essential terms that are probed between two comparisons with the threshold.
PROBE = 8


class Shard:
    """Postings of a set of vectors: by term, the vectors with a part of that sign and its size."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")  # ties go to the smaller id, so rows stand in the order of ids
        self.ids, self.vectors = ids[order], vectors[order]
        self.postings, self.most = [], []
        for sign in (1, -1):
            part = np.maximum(sign * self.vectors, 0)
            self.most.append(part.max(0, initial=0))
            self.postings.append([np.flatnonzero(part[:, d]) for d in range(part.shape[1])])

    def search(self, query: np.ndarray, k: int, own: int | None, floor: int | None) -> list[tuple[int, int]]:
        """The k best (score, id), except the query itself; floor: a score that k others are known to have."""
        n = len(self.ids)
        if not n:
            return []
        signs = np.where(query >= 0, 0, 1)
        bounds = np.array([self.most[s][d] for d, s in enumerate(signs)], np.int64) * np.abs(query)
        order = np.argsort(bounds, kind="stable")
        # the first threshold: the scores of the vectors with the largest parts in the strongest term
        strong = order[-1]
        sample = self.postings[signs[strong]][strong]
        if len(sample) > 4 * k:
            sample = sample[np.argpartition(-np.abs(self.vectors[sample, strong]), 4 * k)[: 4 * k]]
        known = self.vectors[sample] @ query
        known = known[self.ids[sample] != own] if own is not None else known
        threshold = np.partition(known, len(known) - k)[len(known) - k] if len(known) >= k else np.iinfo(np.int64).min
        if floor is not None:
            threshold = max(threshold, floor)
        reach = np.cumsum(bounds[order])
        first = int(np.searchsorted(reach, threshold, side="left"))  # terms before are non-essential
        essential, rest = order[first:], order[:first][::-1]
        if threshold <= 0:  # what matches no term at all scores 0 or less and may still be among the best
            rows = np.arange(n)
        elif not len(essential):
            return []
        else:
            reached = np.zeros(n, bool)
            for d in essential:
                reached[self.postings[signs[d]][d]] = True
            rows = np.flatnonzero(reached)
        scores = self.vectors[rows][:, essential] @ query[essential]
        left = int(bounds[rest].sum())
        for at in range(0, len(rest), PROBE):
            alive = scores + left >= threshold
            rows, scores = rows[alive], scores[alive]
            terms = rest[at : at + PROBE]
            scores = scores + self.vectors[np.ix_(rows, terms)] @ query[terms]
            left -= int(bounds[terms].sum())
        keep = scores >= threshold
        if own is not None:
            keep &= self.ids[rows] != own
        rows, scores = rows[keep], scores[keep]
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return list(zip(scores[best].tolist(), self.ids[rows[best]].tolist(), strict=True))


def _packed(rows: int, names: tuple[str, str]):
    """Packs consecutive vectors of a task into one row each `rows`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        parts: list[np.ndarray] = []

        def out(n: int) -> pa.RecordBatch:
            nonlocal ids, parts
            columns = [np.array(ids[:n], np.int64).tobytes()], [np.concatenate(parts[:n]).astype(np.int64).tobytes() if n else b""]
            ids, parts = ids[n:], parts[n:]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=list(names))

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(i)
                parts.append(v.values.to_numpy(zero_copy_only=False).astype(np.int64))
                if len(ids) == rows:
                    yield out(rows)
        if ids:
            yield out(len(ids))

    return run


def _search(k: int):
    names = ["query_id", "vec_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard_ids, shard_data, ids, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own_ids, ids = np.frombuffer(shard_ids, np.int64), np.frombuffer(ids, np.int64)
                vectors = np.frombuffer(shard_data, np.int64).reshape(len(own_ids), -1)
                shard = Shard(own_ids, vectors)
                queries = np.frombuffer(data, np.int64).reshape(len(ids), -1)
                rows = [(int(q), i, s) for q, v in zip(ids, queries, strict=True) for s, i in shard.search(v, k, int(q), None)]
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each query the k vectors of the highest inner product with it.

    vectors and queries: vec_id (unique in each), components (array of integers, all of one length; scores are of 64 bits).  A vector
    with the query's id is not its candidate.  Ties go to the smaller vec_id; fewer than k candidates are all returned;
    rows with a null id, null vector or null component take no part; without vectors or queries there are no rows.  Every
    shard meets every block of queries, and only the k best of each query leave it.
    """
    ship(vectors.sparkSession)

    def valid(df: DataFrame) -> DataFrame:
        whole = F.col("vec_id").isNotNull() & F.col("components").isNotNull() & ~F.exists("components", lambda x: x.isNull())
        return df.where(whole).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("components").cast("array<long>").alias("components"))

    shards = valid(vectors).mapInArrow(_packed(SHARD_ROWS, ("shard_ids", "shard")), "shard_ids binary, shard binary")
    blocks = valid(queries).mapInArrow(_packed(BLOCK_ROWS, ("ids", "data")), "ids binary, data binary")
    blocks = written(blocks.select(F.monotonically_increasing_id().alias("row"), "*"), "query-blocks")
    # number the blocks without gaps; a block holds a thousand queries, so there are few
    numbers = blocks.select("row", (F.row_number().over(Window.orderBy("row")) - 1).alias("block"))
    blocks = written(blocks.join(numbers, "row").select("block", "ids", "data"), "query-blocks")
    many = blocks.count()
    if not many:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    shards = written(shards, "vector-shards").select("*", F.explode(F.sequence(F.lit(0), F.lit(many - 1))).alias("block"))
    met = shards.join(blocks, "block").select("shard_ids", "shard", "ids", "data")
    found = met.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
