"""Size-aware heavy-light Jaccard join on word shingles.

Two sets of sizes a <= b with Jaccard >= T share at least o = ceil(T (a + b) / (1 + T)) elements, so b <= a / T and at
most a + b - 2 o elements are in one of them only.

* **Light sets** (size below the boundary) list all their subsets of a fixed size c = ceil(T b), for every size b that
  a larger partner may have.  A linking pair always shares such a subset.
* **Heavy sets** go through inverted lists.  A list's key is a slice of the set: for each class of sizes the shingles
  are dealt by hash into m slices, m exceeding the number of elements two linking sets of that class can differ in, so
  a linking pair agrees in a slice.  A slice holds several shingles, so a line or passage that many texts share does
  not make a long list by itself, unlike a list per shingle.  Light sets that a heavy one can reach are listed too.
* **The boundary** is the first size at which listing subsets costs more than keeping and scanning slices.

Lists are then scanned in rounds.  A parity sketch of 1,024 bits stands beside each entry and rules most pairs out at
once (it can only ever rule out pairs that differ in too many elements).  Sets may differ in more elements than such a
sketch can show when they are large, so pairs of large sets then go through sketches that follow their size.  A round
compares the members of a list with one centre of the list, verifies the pairs that are left
on the whole sets, and labels what they connect; lists with one label are left out from then on.  What remains
after the rounds is compared pair by pair across labels, so no link is lost and a group of many near copies costs a
few comparisons per member, not all pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations
from math import comb
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sourcetrail.llm.components import components
from sourcetrail.llm.shingles import WordHashes, mix, shingle_set, words
from sourcetrail.llm.tables import Scratch, is_empty, ship, written

_U = np.uint64
#: Cost of keeping, moving and scanning one entry of an inverted list, in units of one listed subset.
LIST_COST = 4.0
#: Classes of sizes in the inverted lists: the largest size of a class by its smallest.
CLASS_RATIO = 1.5
#: Rounds against a centre before the remaining pairs are compared one by one.
ROUNDS = 1
#: Words of 64 bits of a set's parity sketch.
SKETCH = 16


def overlap(a: int, b: int, percent: int) -> int:
    """Least intersection of sets of sizes a and b with 100 * intersection >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


def largest_partner(n: int, percent: int) -> int:
    return 100 * n // percent


def _subset_size(b: int, percent: int) -> int:
    return -(-percent * b // 100)


def light_cost(n: int, percent: int) -> int:
    return sum(
        comb(n, c) for b in range(n, largest_partner(n, percent) + 1) if (c := _subset_size(b, percent)) <= n and (c < b)
    )


@lru_cache(maxsize=4096)
def _slices(low: int, percent: int) -> tuple[int, int, int]:
    """For the class of sizes that starts at low: its end, its number of slices, how many may be empty."""
    high = max(low, int(low * CLASS_RATIO))
    differ = max(
        a + b - 2 * overlap(a, b, percent)
        for b in range(max(low, high - 20), high + 1)
        for a in range(max(1, _subset_size(b, percent)), b + 1)
        if a + b >= 2 * overlap(a, b, percent)
    )
    spare = 2 + (differ + 1) // 10
    return high, differ + 1 + spare, spare


@lru_cache(maxsize=64)
def boundary(percent: int) -> int:
    """First size that is heavy."""
    n = 1
    while True:
        _, m, _ = _slices(n, percent)
        if light_cost(n, percent) > LIST_COST * m * 1.3:
            return n
        n += 1


@lru_cache(maxsize=65536)
def _classes(n: int, percent: int) -> tuple[tuple[int, int, int], ...]:
    """(start, slices, spare) of the classes in which a set of size n can have its larger partner."""
    out, low = [], boundary(percent)
    top = largest_partner(n, percent)
    while low <= top:
        high, m, spare = _slices(low, percent)
        if high >= n:
            out.append((low, m, spare))
        low = high + 1
    return tuple(out)


def signatures(s: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the subsets and slices of a set of hashed elements; linking but unequal sets share one."""
    n = len(s)
    if not n:
        return s
    out, first = [], boundary(percent)
    if n < first:
        total, singles = np.add.reduce(mix(s)), mix(s)
        for b in range(n, min(largest_partner(n, percent), first - 1) + 1):
            c = _subset_size(b, percent)
            if c > n or c == b:  # c = b: equal sets only, which are one already
                continue
            left = n - c
            if left == 0:
                sums = np.array([total], np.uint64)
            elif left == 1:
                sums = total - singles
            else:
                picks = np.array(list(combinations(range(n), left)))
                sums = total - np.add.reduce(singles[picks], axis=1)
            out.append(mix(sums * _U(2) + mix(np.array([c], np.uint64))))
    for low, m, spare in _classes(n, percent):
        h = mix(s + mix(np.array([low], np.uint64)))
        part = ((h >> _U(32)) % _U(m)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part, h = part[order], h[order]
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        sums = np.add.reduceat(mix(h), starts)
        filled = part[starts].astype(np.uint64)
        salt = mix(np.array([low], np.uint64) * _U(3))
        out.append(mix(sums + mix(filled + salt)))
        if m - len(starts) > spare:  # more empty slices than spare ones: they count as slices too
            empty = np.setdiff1d(np.arange(m, dtype=np.uint64), filled)
            out.append(mix(mix(empty + salt) + _U(1)))
    return np.unique(np.concatenate(out)) if out else s[:0]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))


def _mark(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def _profiles(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                cache.trim()
                sets = [shingle_set(words(t), k, cache) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_mark(s) for s in sets], pa.binary()),
                        _lists([signatures(s, percent) for s in sets]),
                        part.column(3),
                    ],
                    names=["doc_id", "text_hash", "n", "mark", "sigs", "second_hash"],
                )

    return run


def sketch(s: np.ndarray, bits: int = 64 * SKETCH) -> np.ndarray:
    """Parity of the number of elements in each of so many cells.  Two sketches differ in at most as many bits as
    elements are in one of the sets only, so a pair can be ruled out, never ruled in, without its sets."""
    cells = np.bincount((mix(s + _U(7)) % _U(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(cells.astype(np.uint8)).view(np.uint64)


def wide_bits(n: int) -> int:
    """Cells of the wide sketch of a set of size n: a power of two, two cells for each element or more."""
    return max(64 * SKETCH, 1 << (2 * n - 1).bit_length())


def folded(wide: np.ndarray, length: int) -> np.ndarray:
    """The sketch of fewer cells, a divisor of the wide one's."""
    return np.bitwise_xor.reduce(wide.reshape(-1, length), axis=0)


def may_link(a: int, b: int, left: bytes | None, right: bytes | None, percent: int) -> bool:
    """Whether sets of sizes a and b with these wide sketches can link; without one the narrow sketch has spoken."""
    if left is None or right is None:
        return True
    x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
    length = min(len(x), len(y))
    differ = int(np.bitwise_count(folded(x, length) ^ folded(y, length)).sum())
    return differ <= a + b - 2 * overlap(a, b, percent)


def _each_set(k: int, names: list[str], columns):
    """Columns of the sets whose mark is the row's, from (rid, text, mark)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, last = WordHashes(), None
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                cache.trim()
                rids, sets = [], []
                for rid, text, mark in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if rid == last:  # the same row of the table once more
                        continue
                    s = shingle_set(words(text), k, cache)
                    if _mark(s) == mark:
                        last = rid
                        rids.append(rid)
                        sets.append(s)
                yield pa.RecordBatch.from_arrays([pa.array(rids, pa.int64()), *columns(sets)], names=["rid", *names])

    return run


def _sketches(sets: list[np.ndarray]) -> list[pa.Array]:
    wide = [sketch(s, wide_bits(len(s))) for s in sets]
    beyond = pa.array([w.tobytes() if len(w) > SKETCH else None for w in wide], pa.binary())
    return [_lists([folded(w, SKETCH) for w in wide]), beyond]


def _near_pairs(percent: int):
    """Of pairs with sizes and wide sketches (u, v, n, wide, n2, wide2) those that can link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("n", "n2", "wide", "wide2")), strict=True)
            yield batch.select(["u", "v"]).filter(pa.array([may_link(*row, percent) for row in rows], pa.bool_()))

    return run


def _pairs(left: str, right: str) -> list:
    return [F.least(left, right).alias("u"), F.greatest(left, right).alias("v")]


def jaccard_classes(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs (doc_id, text; other columns are ignored).

    Texts link when the Jaccard similarity of their sets of k-word shingles is at least percent / 100; component_id is
    the smallest doc_id reachable over links.  Texts without words (null, empty, white space) have no shingles and are
    their own component; texts with fewer than k words have one shingle, the whole sequence.  Repeated rows stay
    repeated; an empty table gives no rows.
    """
    return classes_of_rows(docs, k, percent).select("doc_id", "n_shingles", "component_id")


def text_hashes() -> list[Column]:
    """Two hashes of 64 bits, with different seeds, by which a text is told from the others of its doc_id."""
    return [F.xxhash64("text").alias("text_hash"), F.xxhash64(F.lit(1), "text").alias("second_hash")]


def classes_of_rows(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``jaccard_classes`` with text_hash, second_hash (of the row's text) and stands: whether the row stands for its
    component, as the one with the smallest (doc_id, row).  Rows without an id are ranked apart, so a component can have
    one row with an id and one without that stand for it; rows without words all stand."""
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    profiles = docs.select("*", *text_hashes()).mapInArrow(
        _profiles(k, percent), "doc_id long, text_hash long, n long, mark binary, sigs array<long>, second_hash long"
    )
    scratch = Scratch()
    signed = scratch.written(profiles.select(F.monotonically_increasing_id().alias("row"), "*"), "set-signatures")
    profiles = scratch.written(signed.drop("sigs"), "set-profiles")
    # equal sets are one: the row with the smallest number stands for all
    heads = profiles.where("mark is not null").groupBy("mark").agg(F.min("row").alias("rid"), F.min("n").alias("n"))
    heads = scratch.written(heads, "set-heads")
    own = ["row", "doc_id", "text_hash", "second_hash", "n"]
    members = profiles.select(*own, "mark").join(heads.select("mark", "rid"), "mark", "left").select(*own, "rid")
    # first the signatures that stand more than once, then without those of equal sets; one exchange serves the counts
    # and the entries that are joined with them, as both read the same rows and columns
    entries = signed.select(F.col("row").alias("rid"), F.explode("sigs").alias("sig"))
    entries = entries.where("rid is not null and sig is not null").repartition("sig")
    shared = entries.groupBy("sig").agg(F.count("rid").alias("length")).where("length > 1").select("sig")
    repeated = scratch.written(entries.join(shared, "sig").join(heads.select("rid", "n"), "rid"), "set-entries")
    shared = repeated.groupBy("sig").agg(F.count("*").alias("length")).where("length > 1")
    lists = scratch.written(repeated.join(shared, "sig"), "set-lists")
    scratch.drop(signed, repeated)  # most of what is on disk so far; the lists hold all that is used of it

    if is_empty(lists):
        labelled = members.withColumn("component", F.col("rid"))
    else:
        classes = components(_links(docs, profiles, lists, k, percent, scratch)).withColumnRenamed("node", "rid")
        labelled = members.join(classes, "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    labelled = labelled.select(*own, "component")
    named, place = F.col("doc_id").isNotNull(), F.struct("doc_id", "row")
    least = labelled.groupBy("component").agg(
        F.min("doc_id").alias("component_id"),
        F.min_by("row", F.when(named, place)).alias("first_named"),
        F.min(F.when(~named, F.col("row"))).alias("first_unnamed"),
    )
    first = F.when(named, F.col("first_named")).otherwise(F.col("first_unnamed"))
    result = labelled.join(least, "component", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "text_hash",
        "second_hash",
        (F.col("component").isNull() | (F.col("row") == first)).alias("stands"),
    )
    result = written(result, "set-classes")  # a few numbers a row; all else can go
    scratch.clear()
    return result


def _links(docs: DataFrame, profiles: DataFrame, lists: DataFrame, k: int, percent: int, scratch: Scratch) -> DataFrame:
    """Verified links between the sets in the lists, enough to connect what any link connects."""
    # the texts of listed sets, found again by the row's mark
    listed = profiles.join(lists.select(F.col("rid").alias("row")).distinct(), "row")
    named = listed.select("doc_id", "text_hash", F.col("row").alias("rid"), "mark", "n")
    sketched = _texts_of(docs, named).mapInArrow(_each_set(k, ["sketch", "wide"], _sketches), "rid long, sketch array<long>, wide binary")
    sets = scratch.written(sketched.dropDuplicates(["rid"]), "set-sketches")
    wides = sets.join(named.select("rid", "n"), "rid").select("rid", "n", "wide")

    def verified(pairs: DataFrame) -> DataFrame:
        left = wides.withColumnRenamed("rid", "u")
        right = wides.select(F.col("rid").alias("v"), F.col("n").alias("n2"), F.col("wide").alias("wide2"))
        rest = pairs.join(left, "u").join(right, "v").select("u", "v", "n", "wide", "n2", "wide2")
        rest = scratch.written(rest.mapInArrow(_near_pairs(percent), "u long, v long"), "set-near-pairs")
        # whole sets are made and moved for these pairs only
        ends = rest.select(F.col("u").alias("rid")).union(rest.select(F.col("v").alias("rid"))).distinct()
        texts = _texts_of(docs, named.join(ends, "rid"))
        whole = texts.mapInArrow(_each_set(k, ["elements"], lambda sets: [_lists(sets)]), "rid long, elements array<long>")
        whole = scratch.written(whole, "set-elements")
        left = whole.select(F.col("rid").alias("u"), F.col("elements").alias("a"))
        right = whole.select(F.col("rid").alias("v"), F.col("elements").alias("b"))
        both = F.size(F.array_intersect("a", "b"))
        union = F.size("a") + F.size("b") - both
        found = rest.join(left, "u").join(right, "v").where(100 * both >= percent * union).select("u", "v")
        found = scratch.written(found, "set-links")
        scratch.drop(rest, whole)
        return found

    bits = [f"b{i}_" for i in range(SKETCH)]
    sketches = sets.select("rid", *[F.col("sketch")[i].alias(b) for i, b in enumerate(bits)])
    # a set in many long lists is close to many: those are the centres
    weights = lists.groupBy("rid").agg(F.sum("length").alias("weight")).join(sketches, "rid")
    whole_lists = scratch.written(lists.join(weights, "rid"), "set-open-lists")

    def other(column: str) -> Column:
        return F.col(column).alias(column + "2")

    size = F.col("n") + F.col("n2")
    may_differ = size - 2 * F.floor((size * percent + 99 + percent) / (100 + percent))
    differ = reduce(add, [F.bit_count(F.col(b).bitwiseXOR(F.col(b + "2"))) for b in bits])
    near = (F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent) & (differ <= may_differ)
    links, tested = None, None
    open_lists = whole_lists.withColumn("comp", F.col("rid"))
    for turn in range(ROUNDS + 1):
        if turn < ROUNDS:
            order = F.struct(-F.col("weight"), F.xxhash64("rid", F.lit(turn)))
            centre = open_lists.groupBy("sig").agg(F.min_by(F.struct("rid", "n", "comp", *bits), order).alias("c")).select("sig", "c.*")
        else:
            # all that differs from the list's first component, against the whole list
            heads = open_lists.groupBy("sig").agg(F.min("comp").alias("first"))
            centre = open_lists.join(heads, "sig").where("comp <> first")
        centre = centre.select("sig", *[other(c) for c in ("rid", "n", "comp", *bits)])
        pairs = open_lists.join(centre, "sig").where((F.col("comp") != F.col("comp2")) & near)
        pairs = pairs.select(*_pairs("rid", "rid2")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["u", "v"], "left_anti")
        pairs = scratch.written(pairs, "set-pairs")
        found = verified(pairs)
        links = found if links is None else links.union(found)
        if turn == ROUNDS:
            break
        tested = pairs if tested is None else tested.union(pairs)
        # two steps towards the smallest linked set: equal labels are connected, which is all that is needed here
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        one = both.groupBy(F.col("u").alias("rid")).agg(F.least(F.min("v"), F.min("u")).alias("label"))
        one = scratch.written(one, "set-labels")
        two = one.join(one.select(F.col("rid").alias("label"), F.col("label").alias("next")), "label", "left")
        two = two.select("rid", F.coalesce("next", "label").alias("label"))
        open_lists = whole_lists.join(two, "rid", "left").withColumn("comp", F.coalesce("label", "rid")).drop("label")
        mixed = open_lists.groupBy("sig").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b").select("sig")
        open_lists = scratch.written(open_lists.join(mixed, "sig"), "set-open-lists")
        if is_empty(open_lists):
            break
    return links


def _texts_of(docs: DataFrame, named: DataFrame) -> DataFrame:
    """(rid, text, mark) of the named sets.  A doc_id may be null or stand on several rows."""
    keys = [F.coalesce("doc_id", F.lit(-1)).alias("key"), "text_hash"]
    texts = docs.select("text", F.xxhash64("text").alias("text_hash"), "doc_id").select("text", *keys)
    return texts.join(named.select("rid", "mark", *keys), ["key", "text_hash"]).select("rid", "text", "mark")
