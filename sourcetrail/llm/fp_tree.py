"""Ranked lexical search over document FP-trees.

Items ask for few terms, so documents are kept as their term vectors restricted to these.  Terms are numbered from the
most to the least frequent, and the vectors of a shard, each in that order, share the paths of a trie.  A node knows, for
every term, the largest frequency among the documents below it, and their smallest length factor m; both together bound
what any of them can score.  An item descends depth first, the child of the highest bound first, and leaves out what stays
under its k-th best score so far, which it carries on to the task's next shard.  The k best of each task are merged.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sourcetrail.llm.tables import Scratch, discard, ship, written
from sourcetrail.session import run_folder

#: Terms of a block of items, on average; what a task keeps of a block follows it.
BLOCK_TERMS = 16_384
#: Documents and terms of documents that one tree takes, documents of a leaf, and cells of a tree's bounds.
SHARD_ROWS, SHARD_CELLS, LEAF, BOUND_CELLS = 16_384, 1 << 21, 64, 1 << 24
#: Parts in which the tasks' best rows of an item are merged first.
MERGE_PARTS = 64

_LETTERS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c > 0x7F or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """Runs of digits, letters and characters beyond ASCII; only A-Z are lower-cased."""
    return text.translate(_LETTERS).split()


def _columns(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(set(terms(t.as_py()))) if t.is_valid else [] for t in batch.column(1).cast(pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary()))], names=["item", "terms"])


def _vectors(numbers: dict[bytes, int]):
    """doc_id, n, numbers of the terms that are asked for, their frequencies; texts without terms are left out."""
    types = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
    names = ["doc_id", "n", "terms", "tf"]
    asked = numbers.keys()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part, rows = batch.slice(at, 512), []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()), strict=True):
                    words = terms(text.as_py() or b"")
                    if words:
                        count = Counter(words)
                        held = [(numbers[t], count[t]) for t in count.keys() & asked]
                        rows.append((doc_id, len(words), [t for t, _ in held], [f for _, f in held]))
                yield _columns(rows, types, names)

    return run


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Share of a term's weight that a document of length factor m gets for tf occurrences, in millionths."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class Tree:
    """The trie of a shard.  Documents stand in the order of their sorted vectors, a node is a range of them; nodes are
    numbered so that the children of one stand together."""

    def __init__(self, ids: list[int | None], m: np.ndarray, sizes: np.ndarray, ranks: np.ndarray, tf: np.ndarray, n_terms: int, leaf: int = LEAF):
        # each vector from its most frequent term on, then the vectors in lexicographic order
        doc = np.repeat(np.arange(len(sizes)), sizes)
        by_rank = np.lexsort((ranks, doc))
        ranks, tf = ranks[by_rank], tf[by_rank]
        ends = np.cumsum(sizes)
        data, cuts = ranks.astype(">u4").tobytes(), [0, *(ends * 4).tolist()]
        paths = [data[a:b] for a, b in zip(cuts, cuts[1:])]
        order = sorted(range(len(paths)), key=paths.__getitem__)
        self.paths = [paths[i] for i in order]
        order = np.array(order)
        sizes = sizes[order]
        self.at = np.concatenate([[0], np.cumsum(sizes)])
        cells = np.repeat(ends[order] - sizes - self.at[:-1], sizes) + np.arange(self.at[-1])
        self.ranks, tf, m = ranks[cells], tf[cells], m[order]
        self.ids = [ids[i] for i in order]
        self.impact = impacts(tf, np.repeat(m, sizes))
        self.leaf = max(leaf, 2 * len(sizes) * n_terms // BOUND_CELLS)
        self._grow()
        self._bound(tf, m, n_terms)

    def _grow(self) -> None:
        self.first, self.last, self.child, self.children = [0], [len(self.ids)], [0], [0]
        at = 0
        while at < len(self.first):
            a, b = self.first[at], self.last[at]
            cuts = self._branches(a, b) if b - a > self.leaf else []
            if len(cuts) > 1:
                self.child[at], self.children[at] = len(self.first), len(cuts)
                self.first += cuts
                self.last += [*cuts[1:], b]
                self.child += [0] * len(cuts)
                self.children += [0] * len(cuts)
            at += 1

    def _branches(self, a: int, b: int) -> list[int]:
        """Where the branches of a node begin; neighbours that a leaf has room for stay together."""
        low, high = self.paths[a], self.paths[b - 1]
        shared = 0  # the path that all documents of the node have in common
        while shared < min(len(low), len(high)) and low[shared : shared + 4] == high[shared : shared + 4]:
            shared += 4
        steps = [p[shared : shared + 4] for p in self.paths[a:b]]
        starts = [a, *(a + i for i in range(1, b - a) if steps[i] != steps[i - 1]), b]
        if len(starts) == 2:  # the same vector throughout
            return []
        cuts, begin = [], a
        for start, end in zip(starts, starts[1:]):
            if cuts and end - begin <= self.leaf:
                continue
            cuts.append(start)
            begin = start
        return cuts

    def _bound(self, tf: np.ndarray, m: np.ndarray, n_terms: int) -> None:
        first, last, child, children = (np.array(x) for x in (self.first, self.last, self.child, self.children))
        leaves = np.flatnonzero(children == 0)
        leaves = leaves[np.argsort(first[leaves])]
        most, least = np.zeros((len(first), n_terms), np.int32), np.zeros(len(first), np.int64)
        least[leaves] = np.minimum.reduceat(m, first[leaves])
        owner = np.repeat(np.repeat(leaves, last[leaves] - first[leaves]), np.diff(self.at))
        np.maximum.at(most, (owner, self.ranks), tf)
        for v in np.flatnonzero(children)[::-1]:
            below = slice(child[v], child[v] + children[v])
            most[v], least[v] = most[below].max(0), least[below].min()
        for v in range(0, len(most), 64):  # in place: below a million, whatever the frequency
            most[v : v + 64] = impacts(most[v : v + 64].astype(np.int64), least[v : v + 64, None])
        self.bounds = most

    def search(self, ranks: np.ndarray, weights: np.ndarray, weight_of: np.ndarray, best: list[tuple], k: int) -> None:
        """Brings `best`, the k best (-score, no id, id) of an item so far, up to date.  weight_of: weights by rank."""
        upper = (self.bounds[:, ranks].astype(np.int64) @ weights).tolist()
        floor = max(1, -best[-1][0]) if len(best) == k else 1
        stack = [0]
        while stack:
            v = stack.pop()
            if upper[v] < floor:
                continue
            if self.children[v]:
                below = range(self.child[v], self.child[v] + self.children[v])
                stack += sorted((c for c in below if upper[c] >= floor), key=upper.__getitem__)
                continue
            a, b = self.first[v], self.last[v]
            cells = slice(self.at[a], self.at[b])
            scores = np.add.reduceat(weight_of[self.ranks[cells]] * self.impact[cells], self.at[a:b] - self.at[a])
            good = np.flatnonzero(scores >= floor)
            if len(good):
                best += [(-int(scores[i]), self.ids[a + i] is None, self.ids[a + i] or 0) for i in good.tolist()]
                best.sort()
                del best[k:]
                floor = max(1, -best[-1][0]) if len(best) == k else 1


def _search(items: list[tuple[int, np.ndarray, np.ndarray]], rank_of: np.ndarray, n_docs: int, all_terms: int, k: int):
    """items: number, ranks of its terms, their weights."""
    types, names = [pa.int64(), pa.int64(), pa.int64()], ["item", "doc_id", "score"]
    n_terms = len(rank_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple]] = {i: [] for i, _, _ in items}
        weight_of = np.zeros(n_terms, np.int64)
        ids: list[int | None] = []
        parts: list[tuple[np.ndarray, ...]] = []

        def finish() -> None:
            if not ids:
                return
            m, sizes, ranks, tf = (np.concatenate(x) for x in zip(*parts, strict=True))
            tree = Tree(ids.copy(), m, sizes, ranks, tf, n_terms)
            for item, own, weights in items:
                weight_of[own] = weights
                tree.search(own, weights, weight_of, best[item], k)
                weight_of[own] = 0
            ids.clear()
            parts.clear()

        cells = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                doc_ids = part.column(0).to_pylist()
                n = part.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
                sizes = part.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                ranks = rank_of[part.column(2).flatten().to_numpy(zero_copy_only=False)]
                tf = part.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                held = sizes > 0
                ids += [i for i, h in zip(doc_ids, held.tolist(), strict=True) if h]
                parts.append((10 + 90 * n[held] * n_docs // all_terms, sizes[held], ranks, tf))
                cells += len(ranks)
                if len(ids) >= SHARD_ROWS or cells >= SHARD_CELLS:
                    finish()
                    cells = 0
        finish()
        rows = [(item, None if none else i, -s) for item, found in best.items() for s, none, i in found]
        yield _columns(rows, types, names)

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each item: in parts first, so that no task takes all rows of one item."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    found = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(MERGE_PARTS)))
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order)))
    found = found.where(F.col("rank") <= k).drop("part", "rank")
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k documents of the highest score above 0 for each item.

    docs: doc_id, text; items: item_id, text; other columns are ignored.  A score sums, over the item's distinct terms,
    weight * (10^9 tf div (1000 tf + 8 m)), the weight being floor(1000 ln((2N + 2) / (2 df + 1))) and m = 10 + 90 n N div L
    (N documents with terms, L their terms, n the document's).  Equal scores go to the smaller doc_id, rows without an id
    last.  A null or empty text has no terms: such a document is not counted, such an item has no rows.  Rows that repeat
    an id are documents or items of their own; an item without an id is answered under a null.  Empty tables give no rows.

    Items are dealt into blocks of about `block_terms` terms; for each the driver holds the terms and their weights, and all
    documents are read once.  Documents move nowhere: only the k best of each task are exchanged.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = items.select(F.monotonically_increasing_id().alias("item"), "item_id", F.col("text").cast("string").alias("text"))
    items = written(items, "items")
    asked = items.select("item", "text").mapInArrow(_item_terms, "item long, terms array<binary>").where(F.size("terms") > 0)
    asked = written(asked, "item-terms")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-total // block_terms)
    folder = run_folder(spark, "ranked-documents")
    spark.createDataFrame([], "item long, doc_id long, score long, rank int").write.parquet(folder)
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).collect()
        vocabulary = sorted({bytes(t) for r in own for t in r.terms})
        if not vocabulary:
            continue
        numbers = {t: i for i, t in enumerate(vocabulary)}
        held = Scratch()
        schema = "doc_id long, n long, terms array<int>, tf array<int>"
        vectors = held.written(docs.mapInArrow(_vectors(numbers), schema), "term-vectors")
        n_docs, all_terms = vectors.agg(F.count("*"), F.sum("n")).first()
        if n_docs:
            weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
            df = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
            df = {r.term: (r.df, r.weight) for r in df.select("term", "df", weight.alias("weight")).collect()}
            ranks = np.empty(len(vocabulary), np.int64)
            ranks[sorted(range(len(vocabulary)), key=lambda t: (-df.get(t, (0, 0))[0], t))] = np.arange(len(vocabulary))
            queries = []
            for r in own:
                known = [t for t in (numbers[bytes(t)] for t in r.terms) if t in df]
                if known:
                    queries.append((r.item, ranks[known], np.array([df[t][1] for t in known], np.int64)))
            found = vectors.mapInArrow(_search(queries, ranks, n_docs, all_terms, k), "item long, doc_id long, score long")
            _best(found, k).select("item", "doc_id", "score", "rank").write.mode("append").parquet(folder)
        held.clear()
    discard(asked)
    found = spark.read.schema("item long, doc_id long, score long, rank int").parquet(folder)
    return found.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
