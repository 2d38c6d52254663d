"""Hard-negative mining with cover trees over norm-augmented vectors.

A component is added to each vector so that all have the norm of the longest, which leaves inner products with an anchor
(whose added component is 0) as they are and turns them into distances on a sphere.  A shard of rows becomes a cover tree:
the rows of a node lie within its covering radius around a row of its own, radii shrink from level to level by `BASE`, and
every row of a node is covered by a child.  The radius of a node bounds the inner products of all rows below it with an
anchor from both sides.  A search descends to the nodes of the highest bounds first; nodes outside the windows of scores, or
under the k-th best score so far, are skipped, and the rows at the leaves are scored exactly.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sourcetrail.llm.tables import Scratch, ship
from sourcetrail.session import run_folder

#: Rows of a tree, the factor between the radii of two levels, and rows below which a node is a leaf.
SHARD_ROWS, BASE, LEAF = 4096, 1.3, 32
#: Children with fewer rows have no node: their rows stand with their parent.
LEAST_ROWS = 4
#: Nodes that a search opens together.
OPENED = 64
#: Bytes of anchors that a task holds at a time, and anchors whose bounds are computed together.
ANCHOR_BYTES, ANCHOR_ROWS = 4 << 20, 128
#: Relative allowance for rounding in bounds.
SLACK = 1e-9
#: Inner products below are exact in numbers of 32 and of 64 bits.
EXACT_32, EXACT_64 = 2.0**23, 2.0**52


def matrix(vectors: list, width: int) -> np.ndarray:
    """One row per vector; missing components are 0."""
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _split(products: np.ndarray, inside: np.ndarray, center: int, radius: float, norm: float) -> tuple[np.ndarray, list]:
    """Children that cover all rows within the radius of a level further down, and the rows of the smallest ones."""
    while True:
        radius /= BASE
        if radius <= norm * 1e-6:  # equal rows, but for rounding
            return inside, []
        enough = norm**2 - radius**2 / 2  # inner product of two points at that distance
        covered = products[center, inside] >= enough
        if not covered.all():
            break
    own, below = [], []
    while True:
        covered |= inside == center
        mine, inside = inside[covered], inside[~covered]
        if len(mine) < LEAST_ROWS:
            own.append(mine)
        else:
            below.append((mine, center, radius))
        if not len(inside):
            return np.concatenate([*own, inside]), below
        center = int(inside[0])
        covered = products[center, inside] >= enough


@dataclass
class CoverTree:
    """Rows in tree order, and nodes numbered so that the children of one stand together.  A node's own rows, first to last,
    are those it verifies itself: all of a leaf, and those of children too small for a node."""

    rows: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    #: by node: place of its center, cosine of the angle around the center in which all rows below lie
    centers: np.ndarray
    cos: np.ndarray
    first: np.ndarray
    last: np.ndarray
    child: np.ndarray
    children: np.ndarray
    norm: float

    @classmethod
    def grown(cls, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> CoverTree:
        x = vectors.astype(np.float64)
        norms = (x * x).sum(1)
        norm = float(np.sqrt(norms.max(initial=0)))
        points = np.column_stack([x, np.sqrt(np.maximum(norm**2 - norms, 0))])
        products = points @ points.T
        order: list[int] = []
        cos, first, last, child, children = [], [], [], [], []
        nodes = [(np.arange(len(rows)), 0, 2 * norm)]  # rows, one of them as the center, radius of the level
        for inside, center, radius in nodes:  # grows on the way
            cos.append(max(-1.0, products[center, inside].min() / (norm**2 or 1.0) - SLACK))
            own, below = (inside, []) if len(inside) <= LEAF else _split(products, inside, center, radius, norm)
            first.append(len(order))
            order += own.tolist()
            last.append(len(order))
            child.append(len(nodes))
            children.append(len(below))
            nodes += below
        place = np.array(order, np.int64)
        centers = np.argsort(place)[[center for _, center, _ in nodes]]
        numbers = [np.array(x, np.int64) for x in (first, last, child, children)]
        return cls(rows[place], ids[place], labels[place], vectors[place], centers, np.array(cos), *numbers, norm)

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Most and least inner product of each anchor with the rows of each node."""
        a = anchors.astype(np.float64)
        size = np.sqrt((a * a).sum(1))[:, None] * self.norm
        cos = np.clip((a @ self.vectors[self.centers].astype(np.float64).T) / np.where(size > 0, size, 1), -1, 1)
        sin, near = np.sqrt(1 - cos * cos), self.cos
        far = np.sqrt(np.maximum(1 - near * near, 0))
        most = np.where(cos >= near, 1, cos * near + sin * far)
        least = np.where(cos <= -near, -1, cos * near - sin * far)
        return size * (most + SLACK), size * (least - SLACK)

    def search(
        self, anchor: np.ndarray, most: np.ndarray, least: np.ndarray, windows: list[tuple[float, float]], wanted: np.ndarray,
        best: list[list[tuple]], k: int,
    ) -> None:
        """Brings `best`, for each window [low, high] the k best (-score, id, row) so far, up to date with the rows marked in
        wanted.  The windows of an anchor are searched together, and the `OPENED` nodes with the highest bounds are opened
        together; a node that is outside or too low for every window is left out with all below it."""
        high = np.array([h for _, h in windows])
        floor = np.array([max(low, -found[-1][0]) if len(found) == k else low for (low, _), found in zip(windows, best)])
        nodes = np.zeros(1, np.int64)
        while True:
            nodes = nodes[((most[nodes, None] >= floor) & (least[nodes, None] <= high)).any(1)]
            if not len(nodes):
                return
            opened, nodes = nodes, nodes[:0]
            if len(opened) > OPENED:
                order = np.argpartition(-np.minimum(most[opened], high.max()), OPENED)
                opened, nodes = opened[order[:OPENED]], opened[order[OPENED:]]
            rows = _ranges(self.first[opened], self.last[opened])
            rows = rows[wanted[rows]]
            scores = self.vectors[rows] @ anchor
            for w, found in enumerate(best):
                good = np.flatnonzero((scores >= floor[w]) & (scores <= high[w]))
                if len(good) > 4 * k:  # only those that can be among the best, with all ties
                    good = good[scores[good] >= np.partition(scores[good], len(good) - k)[len(good) - k]]
                if len(good):
                    at = rows[good]
                    found += zip((-scores[good]).astype(np.int64).tolist(), self.ids[at].tolist(), self.rows[at].tolist())
                    found.sort()
                    del found[k:]
                    floor[w] = max(windows[w][0], -found[-1][0]) if len(found) == k else windows[w][0]
            nodes = np.concatenate([nodes, _ranges(self.child[opened], self.child[opened] + self.children[opened])])


def _ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    sizes = end - begin
    ends = np.cumsum(sizes)
    return np.repeat(begin - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _trees(shard_rows: int):
    """Packs the rows of a task into trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def out() -> pa.RecordBatch:
            rows, ids, labels, vectors = zip(*held, strict=True)
            held.clear()
            tree = CoverTree.grown(np.array(rows), np.array(ids), np.array(labels), matrix(vectors, max(map(len, vectors))))
            if np.abs(tree.vectors).max(initial=0) < 1 << 15:
                tree.vectors = tree.vectors.astype(np.int16)
            return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(tree)], pa.binary())], names=["tree"])

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                for row in zip(*(c.to_pylist() for c in batch.slice(at, 1024).columns), strict=True):
                    held.append(row)
                    if len(held) == shard_rows:
                        yield out()
        if held:
            yield out()

    return run


#: The searches of an anchor: its number in its block, whether for rows of its own label, and by window its number, least and
#: most score (infinite: any).
Search = tuple[int, bool, list[tuple[int, float, float]]]


def _search(rows: np.ndarray, labels: np.ndarray, anchors: np.ndarray, searches: list[Search], k: int):
    """The k best rows of each window, as anchor (its row), window, score, row, id."""
    types, names = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()], ["anchor", "window", "score", "row", "vec_id"]
    largest = float(np.sqrt((anchors.astype(np.float64) ** 2).sum(1).max(initial=0)))
    parts: dict[int, list[Search]] = {}
    for s in searches:
        parts.setdefault(s[0] // ANCHOR_ROWS, []).append(s)

    def fitting(tree: CoverTree) -> np.ndarray:
        wide = tree.vectors.shape[1]
        return anchors[:, :wide] if wide <= anchors.shape[1] else np.pad(anchors, ((0, 0), (0, wide - anchors.shape[1])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[list[tuple]]] = {a: [[] for _ in windows] for a, _, windows in searches}
        for batch in batches:
            for packed in batch.column(0):
                tree: CoverTree = pickle.loads(packed.as_py())
                # integers, as floating numbers where these hold every product exactly
                reach = largest * tree.norm
                tree.vectors = tree.vectors.astype(np.float32 if reach < EXACT_32 else np.float64 if reach < EXACT_64 else np.int64)
                own = fitting(tree)
                exact = own.astype(tree.vectors.dtype)
                for part, wanted in parts.items():
                    begin = part * ANCHOR_ROWS
                    most, least = tree.bounds(own[begin : begin + ANCHOR_ROWS])
                    for a, same, windows in wanted:
                        fit = ((tree.labels == labels[a]) == same) & (tree.rows != rows[a])
                        limits = [(low, high) for _, low, high in windows]
                        tree.search(exact[a], most[a - begin], least[a - begin], limits, fit, best[a], k)
        found = [
            (int(rows[a]), w, -s, r, i)
            for a, _, windows in searches for (w, _, _), got in zip(windows, best[a], strict=True) for s, i, r in got
        ]
        columns = list(zip(*found, strict=True)) if found else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return run


_FOUND = "anchor long, window int, score long, row long, vec_id long"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each search over all tasks."""
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    is_anchor: Callable[[Column], Column],
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    shard_rows: int = SHARD_ROWS,
    anchor_bytes: int = ANCHOR_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    vectors: vec_id, label, components (array of integers); other columns are ignored.  Anchors are the rows whose vec_id
    satisfies is_anchor.  Their positives are the `positives` rows of the same label with the highest inner products; for
    each, the `negatives` best rows of other labels whose score is `low` to `high` per cent of the positive's are returned
    (all, if fewer; for a negative positive score there are none).  Ties go to the smaller vec_id.  Rows with a null id,
    label, vector or component take no part.  Rows that repeat an id are rows of their own, as anchors too: a row is only
    never its own positive or negative.  A shorter vector's missing components, an empty one's all, count as 0.  Scores are
    of 64 bits.  Empty tables, and anchors without positives or negatives, give no rows.

    All rows meet all anchors: trees are built once and written; anchors come in blocks of bounded size, each of which reads
    the trees twice.  Only the best rows of each task are exchanged.
    """
    spark = vectors.sparkSession
    ship(spark)
    whole = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("components").isNotNull()
    whole = whole & ~F.exists("components", lambda x: x.isNull())
    given = vectors.where(whole).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"), F.col("components").cast("array<long>").alias("components"),
    )
    scratch = Scratch()
    rows = scratch.written(given, "numbered-vectors")
    trees = scratch.written(rows.mapInArrow(_trees(shard_rows), "tree binary"), "cover-trees")
    anchors = rows.where(is_anchor(F.col("vec_id")))
    many, wide = anchors.agg(F.count("*"), F.max(F.size("components"))).first()
    blocks = -(-many * max(wide or 0, 1) * 8 // anchor_bytes)
    folder = run_folder(spark, "hard-negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(folder)
    for block in range(blocks):
        own = anchors.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).collect()
        if not own:
            continue
        numbers, labels = np.array([r.row for r in own]), np.array([r.label for r in own])
        queries = matrix([r.components for r in own], wide)
        place = {r.row: i for i, r in enumerate(own)}
        first = [(i, True, [(0, -np.inf, np.inf)]) for i in range(len(own))]
        nearest = trees.mapInArrow(_search(numbers, labels, queries, first, positives), _FOUND)
        windows: dict[int, list[tuple[int, float, float]]] = {}
        chosen = {}
        for r in _ranked(nearest, positives).collect():  # `positives` rows for each anchor of the block
            i, least, most = place[r.anchor], -(-low * r.score // 100), high * r.score // 100
            if least <= most:
                windows.setdefault(i, []).append((r.rank, least, most))
                chosen[r.anchor, r.rank] = (own[i].vec_id, r.vec_id, r.score)
        if not windows:
            continue
        searches = [(i, False, found) for i, found in windows.items()]
        found = _ranked(trees.mapInArrow(_search(numbers, labels, queries, searches, negatives), _FOUND), negatives)
        pairs = spark.createDataFrame([(*k, *v) for k, v in chosen.items()], "anchor long, window int, anchor_id long, positive_id long, positive_score long")
        found = found.join(pairs, ["anchor", "window"])
        found.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")).write.mode("append").parquet(folder)
    scratch.clear()
    return spark.read.schema(schema).parquet(folder)
