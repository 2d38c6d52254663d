"""Benchmark decontamination with spaced seeds.

A seed is a fixed mask laid over consecutive tokens; the masked-out tokens do not count, so a passage is found although
some of its words were replaced.  Seeds of all benchmark positions go into a table; documents are scanned once with a
filter of fixed size built from it, what passes is joined with the table by hash, and each hit is verified by aligning
document and item around it: substitutions are allowed as long as most tokens agree.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sourcetrail.llm.shingles import WordHashes, hashes, mix
from sourcetrail.llm.tables import Scratch, ship, written

#: 1: the token counts, 0: any token.
MASKS = ("111010011", "1100101011", "1101001101", "11110011")
#: Masks of items of fewer than SHORT tokens, beside those of MASKS that fit: together they find such an item however
#: the tokens that may differ lie.
SHORT_MASKS, SHORT = ("1111", "10111", "11011", "11101", "110011"), 12
#: Items of fewer tokens must occur as they are.
LEAST_ITEM = 5
#: Tokens of an overlap (of the whole item if it is shorter), and the share of them that must agree.
OVERLAP, AGREE = 12, 0.75
#: Bits of the scanning filter, a fixed 2 MB whatever the benchmark's size; a fuller filter only passes more to the join.
FILTER_BITS = 1 << 24
#: Tokens (or documents, where they are empty) that are scanned at once.
BLOCK = 1 << 14

#: Scripts that put no spaces between words: South-East Asian ones and Tibetan, kana, bopomofo, yi, Han.
_UNSPACED = (
    "\u0e00-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff\u1950-\u19df\u1a20-\u1aaf\ua9e0-\ua9ff\uaa60-\uaadf"
    "\u3005-\u3007\u3021-\u3029\u3031-\u303c\u3041-\u30ff\u3105-\u312f\u31a0-\u31bf\u31f0-\u31ff\ua000-\ua48f\uff66-\uff9f"
    "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U0001aff0-\U0001b16f\U00020000-\U0003ffff"
)
_TOKEN, _CUT = re.compile(r"[^\W_]+"), re.compile(rf"(?=[{_UNSPACED}])[^\W_]|(?:(?![{_UNSPACED}])[^\W_])+")
_ANY_UNSPACED = re.compile(f"[{_UNSPACED}]")
_U = np.uint64
_SPAN = min(map(len, MASKS))


def tokens(text: str | None, cache: WordHashes) -> np.ndarray:
    """Hashes of the lower-cased letter and digit runs of a text; in scripts without spaces each character is one."""
    text = (text or "").lower()
    found = (_CUT if not text.isascii() and _ANY_UNSPACED.search(text) else _TOKEN).findall(text)
    return hashes([w.encode("utf-8", "surrogatepass") for w in found], cache)


def seed_hashes(t: np.ndarray, mask: str) -> np.ndarray:
    """One hash for each position at which the mask fits."""
    n = len(t) - len(mask) + 1
    if n <= 0:
        return t[:0]
    h = np.full(n, sum(3**i for i, c in enumerate(mask) if c == "1") + len(mask), np.uint64)
    for i, c in enumerate(mask):
        if c == "1":
            h = h * _U(0x9E3779B97F4A7C15) + t[i : i + n]
    return mix(h)


def masks_of(n: int) -> tuple[str, ...]:
    """Masks of an item of n tokens."""
    if n < LEAST_ITEM:
        return ("1" * n,) if n else ()
    return tuple(m for m in (*MASKS, *(SHORT_MASKS if n < SHORT else ())) if len(m) <= n)


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = WordHashes()
    for batch in batches:
        rows = []
        for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            t = tokens(text, cache)
            if not len(t):
                continue
            seeds = [(h, at) for m in masks_of(len(t)) for at, h in enumerate(seed_hashes(t, m).view(np.int64).tolist())]
            rows.append((item, t.view(np.int64), [h for h, _ in seeds], [at for _, at in seeds]))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32())]
        names = ["item_id", "item_tokens", "seeds", "places"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return h & _U(FILTER_BITS - 1), (h >> _U(32)) & _U(FILTER_BITS - 1)


def _scan(bitmap: np.ndarray, masks: tuple[str, ...]):
    """Documents with their tokens and the seeds that pass the filter; documents without such seeds are left out."""

    def passes(h: np.ndarray) -> np.ndarray:
        a, b = _bits(h)
        one = (bitmap[a >> _U(3)] >> (a & _U(7)).astype(np.uint8)) & 1
        at = np.flatnonzero(one)
        b = b[at]
        return at[((bitmap[b >> _U(3)] >> (b & _U(7)).astype(np.uint8)) & 1) == 1]

    names = ["doc_id", "text_hash", "tokens", "seeds", "places"]
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32())]

    def found(block: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document of the block, seed and place of all that passes, by document, mask and place."""
        t, ends = np.concatenate(block), np.cumsum([len(own) for own in block])
        owners, seeds, places = [], [], []
        for mask in masks:
            h = seed_hashes(t, mask)
            hit = passes(h)
            owner = np.searchsorted(ends, hit, side="right")
            inside = hit + len(mask) <= ends[owner]  # else the mask would reach into the next document
            hit, owner = hit[inside], owner[inside]
            if len(mask) < LEAST_ITEM - 1:  # whole items: the first occurrence is the one that counts
                order = np.lexsort((hit, h[hit], owner))
                again = (np.diff(owner[order]) == 0) & (np.diff(h[hit[order]]) == 0)
                first = np.sort(order[np.concatenate([[True], ~again])[: len(order)]])
                hit, owner = hit[first], owner[first]
            owners.append(owner)
            seeds.append(h[hit])
            places.append(hit)
        owner, at = np.concatenate(owners), np.concatenate(places)
        order = np.argsort(owner, kind="stable")
        starts = np.concatenate([[0], ends])[owner]
        return owner[order], np.concatenate(seeds)[order].view(np.int64), (at - starts)[order].astype(np.int32)

    def passed(docs: list[tuple]) -> pa.RecordBatch:
        owner, seeds, places = found([t for _, _, t in docs])
        rows = []
        for d, n in zip(*(x.tolist() for x in np.unique(owner, return_counts=True)), strict=True):
            doc_id, text_hash, t = docs[d]
            rows.append((doc_id, text_hash, t.view(np.int64), seeds[:n], places[:n]))
            seeds, places = seeds[n:], places[n:]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, docs, n = WordHashes(), [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                cache.trim()
                for doc_id, text_hash, text in zip(*(c.to_pylist() for c in batch.slice(at, 1000).columns), strict=True):
                    t = tokens(text, cache)
                    docs.append((doc_id, text_hash, t))
                    n += len(t)
                    if n >= BLOCK or len(docs) >= BLOCK:
                        if masks:
                            yield passed(docs)
                        docs, n = [], 0
        if docs and masks:
            yield passed(docs)

    return run


def align(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int] | None:
    """Best overlap with item position i on document position i + shift: (first item position, length, tokens that agree);
    None if it is too short or too little of it agrees."""
    first, last = max(0, -shift), min(len(item), len(doc) - shift)
    if last <= first:
        return None
    same = doc[first + shift : last + shift] == item[first:last]
    gain = np.concatenate([[0], np.cumsum(np.where(same, 1, -2))])
    low = np.minimum.accumulate(gain)
    end = int(np.argmax(gain - low))
    begin = int(np.argmax(gain[: end + 1] == low[end]))
    least = min(OVERLAP, len(item))
    if end - begin < least or same[begin:end].sum() < AGREE * (end - begin):
        found = _longest(same)
        if found is None or found[1] - found[0] < least:
            return None
        begin, end = found
    return first + begin, end - begin, int(same[begin:end].sum())


def _longest(same: np.ndarray) -> tuple[int, int] | None:
    """The longest stretch of which the share AGREE is true, the first of several; None if nothing is."""
    gain = np.concatenate([[0.0], np.cumsum(np.where(same, 1 - AGREE, -AGREE))])
    low = np.minimum.accumulate(gain)  # falls: a stretch to some end begins at the first place that is as low
    begins = np.searchsorted(-low, -gain - 1e-9)
    lengths = np.arange(len(gain)) - begins
    end = int(np.argmax(lengths))
    return (int(begins[end]), end) if lengths[end] > 0 else None


_FOUND = "row long, doc_id long, text_hash long, item_id long, item_start int, doc_start int, length int, agree int"


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _FOUND.split(", ")]
    types = [pa.int64()] * 4 + [pa.int32()] * 4
    for batch in batches:
        rows = []
        ids = [batch.column(i).to_pylist() for i in range(5)]
        docs, items = batch.column(5), batch.column(6)
        for i, (row, doc_id, text_hash, item, shift) in enumerate(zip(*ids, strict=True)):
            best = align(docs[i].values.to_numpy(), items[i].values.to_numpy(), shift)
            if best:
                start, length, agree = best
                rows.append((row, doc_id, text_hash, item, start, start + shift, length, agree))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The benchmark items found in documents, one row for each document and item: doc_id, text_hash (xxhash64 of the text,
    as rows may share an id), item_id, doc_start and item_start (in tokens), length, agree (tokens that are equal).

    docs: doc_id, text; benchmark: item_id, text; other columns are ignored.  Of several overlaps with an item the one with
    most equal tokens counts, then the first.  Null and empty texts, items without tokens and empty tables match nothing;
    items of fewer than 5 tokens must occur word for word; documents without a leak have no row; repeated rows stay
    repeated, repeated items are one.
    """
    ship(docs.sparkSession)
    scratch = Scratch()
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    schema = "item_id long, item_tokens array<long>, seeds array<long>, places array<int>"
    items = items.mapInArrow(_item_seeds, schema).select(F.monotonically_increasing_id().alias("item_row"), "*")
    items = scratch.written(items, "leak-items")
    seeds = items.select("item_row", F.explode(F.arrays_zip("seeds", "places")).alias("s"))
    seeds = seeds.select("item_row", F.col("s.seeds").alias("seed"), F.col("s.places").alias("item_place"))
    seeds = scratch.written(seeds, "leak-seeds")

    bit = F.explode(F.array(F.col("seed").bitwiseAND(FILTER_BITS - 1), F.shiftrightunsigned("seed", 32).bitwiseAND(FILTER_BITS - 1)))
    cells = seeds.select(bit.alias("bit")).groupBy(F.shiftright("bit", 5).alias("word"))
    cells = cells.agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 31 as int))")).alias("bits")).collect()  # FILTER_BITS / 32 at most
    bitmap = np.zeros(FILTER_BITS // 32, "<u4")
    for r in cells:
        bitmap[r["word"]] = r["bits"]
    sizes = items.select(F.least(F.size("item_tokens"), F.lit(SHORT)).alias("n")).distinct().collect()  # SHORT at most
    masks = tuple(sorted({m for r in sizes for m in masks_of(r["n"])}))

    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string"))
    schema = "doc_id long, text_hash long, tokens array<long>, seeds array<long>, places array<int>"
    scanned = named.mapInArrow(_scan(bitmap.view(np.uint8), masks), schema)
    scanned = scratch.written(scanned.select(F.monotonically_increasing_id().alias("row"), "*"), "leak-scan")
    hits = scanned.select("row", F.explode(F.arrays_zip("seeds", "places")).alias("s"))
    hits = hits.select("row", F.col("s.seeds").alias("seed"), F.col("s.places").alias("place")).join(seeds, "seed")
    hits = hits.select("row", "item_row", (F.col("place") - F.col("item_place")).alias("shift")).distinct()
    pairs = hits.join(scanned.select("row", "doc_id", "text_hash", "tokens"), "row")
    pairs = pairs.join(items.select("item_row", "item_id", "item_tokens"), "item_row")
    found = pairs.select("row", "doc_id", "text_hash", "item_id", "shift", "tokens", "item_tokens").mapInArrow(_verify, _FOUND)
    best = F.max_by(
        F.struct("doc_id", "text_hash", "doc_start", "item_start", "length", "agree"),
        F.struct("agree", -F.col("doc_start"), -F.col("item_start"), "length"),
    )
    best = found.groupBy("row", "item_id").agg(best.alias("b"))
    result = best.select("b.doc_id", "b.text_hash", "item_id", "b.doc_start", "b.item_start", "b.length", "b.agree")
    result = written(result, "leaks")  # a few numbers for each leak; all else can go
    scratch.clear()
    return result
