"""Removal of long byte strings that occur more than once, by threshold-bounded interval expansion.

A string of `min_length` bytes that occurs twice has the same smallest k-gram hash (its anchor) at the same place in
both occurrences.  So it suffices to look at anchors: around an anchor a match reaches at most min_length - k bytes to
the left and min_length bytes to the right, its context.

1. Anchors of every text with hashes of their contexts (linear, on numpy arrays).  Equal contexts are one from here on:
   a context that occurs twice is repeated as a whole.
2. Different contexts can only match if they agree on the half of a match left or right of the anchor; these hashes
   bring contexts together in buckets.  Contexts alone in their buckets are done.
3. Within buckets the suffixes at the anchors are sorted (a suffix array of the anchored suffixes with its common
   prefixes) and extended backward one byte at a time, breadth first: an interval splits by the byte before its suffixes
   (the Burrows-Wheeler column), the common prefix of neighbours grows by one over the minimum in between, and intervals
   that are single or can no longer reach min_length are dropped.  Neighbours that reach min_length mark a match.
   A bucket beyond `bucket_rows` contexts is not gathered: its contexts are compared over the cluster by hashes of what all
   windows of a stretch share, and those that agree by 128-bit hashes of their windows, with the same result.
4. Every occurrence of a matched context gets its span; spans of a document are merged and cut out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sourcetrail.llm.shingles import mix
from sourcetrail.llm.tables import Scratch, discard, is_empty, ship, written

#: Contexts of one bucket that a task sorts in memory (about 3 KB each); larger buckets are dealt over the cluster.
BUCKET_ROWS = 32_768
#: Repeated windows of large buckets (28 bytes each) that are sent to all executors; more of them are joined by exchange.
SENT_ROWS = 100_000
#: Contexts expanded together, and rows that a task builds at once.
EXPAND_ROWS, OUT_ROWS = 4096, 16_384


def _bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def anchor_length(min_length: int) -> int:
    return 1 << max(0, (min_length // 6).bit_length() - 1)


def _sliding(values: np.ndarray, width: int, take) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = take(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return take(values[:-rest], values[rest:]) if rest else values


def anchors(data: bytes, min_length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the smallest k-gram hash (all of them, if tied) of each run of min_length bytes, and their hashes."""
    n, k = len(data), anchor_length(min_length)
    if n < min_length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    step, size = 0xD6E8FEB86659FD93, 1
    while size < k:
        h = h[:-size] * np.uint64(step) + h[size:]
        step, size = step * step % 2**64, size * 2
    h = mix(h)
    width = min_length - k + 1
    least = _sliding(h, width, np.minimum)
    padded = np.zeros(len(least) + 2 * (width - 1), np.uint64)
    padded[width - 1 : width - 1 + len(least)] = least
    at = np.flatnonzero(h == _sliding(padded, width, np.maximum))
    return at, h[at]


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


_OCCURRENCES = "key long, text_hash long, p int, h long, c1 long, c2 long, left_half long, right_half long"


def _occurrences(min_length: int):
    k = anchor_length(min_length)
    reach, half = min_length - k, (min_length - k) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("key", pa.int64()), ("text_hash", pa.int64()), ("p", pa.int32())]
            + [(c, pa.int64()) for c in ("h", "c1", "c2", "left_half", "right_half")]
        )
        rows: list[list] = [[] for _ in schema]

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(r, f.type) for r, f in zip(rows, schema, strict=True)], schema=schema)
            for r in rows:
                r.clear()
            return made

        for batch in batches:
            for i in range(batch.num_rows):
                key, text_hash, text = (c[i].as_py() for c in batch.columns)
                data = _bytes(text)
                places, hs = anchors(data, min_length)
                for p, h in zip(places.tolist(), hs.view(np.int64).tolist(), strict=True):
                    lead = min(p, reach)
                    c = xxhash.xxh3_128_intdigest(data[p - lead : p + min_length], lead)
                    rows[0].append(key)
                    rows[1].append(text_hash)
                    rows[2].append(p)
                    rows[3].append(h)
                    rows[4].append(_signed(c >> 64))
                    rows[5].append(_signed(c & (2**64 - 1)))
                    rows[6].append(_signed(xxhash.xxh3_64_intdigest(data[p - half : p + k], 1)) if p >= half else None)
                    end = p + min_length - half
                    rows[7].append(_signed(xxhash.xxh3_64_intdigest(data[p:end], 2)) if end <= len(data) else None)
                    if len(rows[0]) >= OUT_ROWS:
                        yield out()
        if rows[0]:
            yield out()

    return run


def expand(bucket: np.ndarray, left: np.ndarray, lead: np.ndarray, right: np.ndarray, length: np.ndarray, least: int):
    """Matches of at least `least` bytes between contexts of a bucket.

    left: bytes before the anchors, the nearest last; lead: how many of them count; right: bytes from the anchors on, of
    which `length` count.  Returns for each context the largest and smallest number of bytes that a matching window of
    `least` bytes reaches to the left of the anchor; -1 and a large number if there is none.
    """
    m, reach = left.shape
    most, fewest = np.full(m, -1), np.full(m, 1 << 30)
    wide = right.shape[1]
    key = np.ascontiguousarray(right).view(f"S{wide}").ravel()
    order = np.argsort(length, kind="stable")
    order = order[np.argsort(key[order], kind="stable")]
    order = order[np.argsort(bucket[order], kind="stable")]
    common = np.full(m, -1)
    for at in range(1, m, 4096):
        a, b = order[at - 1 : min(at + 4095, m - 1)], order[at : at + 4096]
        differ = right[a] != right[b]
        same = np.where(differ.any(1), differ.argmax(1), wide)
        same = np.minimum(same, np.minimum(length[a], length[b]))
        common[at : at + 4096] = np.where(bucket[a] == bucket[b], same, -1)
    for j in range(reach + 1):
        hit = np.flatnonzero(common >= least)
        for who in (order[hit], order[hit - 1]):
            most[who] = j
            fewest[who] = np.minimum(fewest[who], j)
        # a new interval starts where the common prefix cannot reach the threshold any more
        starts = common + (reach - j) < least
        size_of = np.diff(np.append(np.flatnonzero(starts), len(starts))) if len(starts) else np.zeros(0, int)
        interval = np.cumsum(starts) - 1
        keep = (np.repeat(size_of, size_of) > 1) & (lead[order] > j)
        if j == reach or not keep.any():
            break
        at = np.flatnonzero(keep)
        before = left[order[at], reach - 1 - j].astype(np.int64)
        group = interval[at] * 256 + before
        by = np.argsort(group, kind="stable")
        at, group = at[by], group[by]
        bounds = np.empty(2 * max(0, len(at) - 1), np.int64)
        bounds[0::2], bounds[1::2] = at[:-1] + 1, at[1:] + 1
        grown = np.full(len(at), -1)
        if len(at) > 1:
            low = np.minimum.reduceat(np.append(common, -1), bounds)[::2]
            grown[1:] = np.where(group[1:] == group[:-1], low + 1, -1)
        order, common = order[at], grown
    return most, fewest


def _contexts(min_length: int):
    """Cuts the contexts of a document's anchors out of its text, one row for each bucket."""
    k = anchor_length(min_length)
    reach = min_length - k
    schema = pa.schema(
        [("bucket", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("lead", pa.int32())]
        + [("context", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data, wanted = _bytes(batch.column(0)[i].as_py()), batch.column(1)[i].as_py()
                for at in range(0, len(wanted), OUT_ROWS):
                    rows = []
                    for w in wanted[at : at + OUT_ROWS]:
                        lead = min(w["p"], reach)
                        rows.append((w["bucket"], w["c1"], w["c2"], lead, data[w["p"] - lead : w["p"] + min_length]))
                    columns = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


_MATCHES = "c1 long, c2 long, most int, fewest int"


def _expanded(min_length: int):
    """Expands whole buckets; the rows come sorted by bucket and context, repeated if the table repeats its rows."""
    reach = min_length - anchor_length(min_length)

    def matches(rows: list[tuple]) -> pa.RecordBatch:
        bucket, c1, c2, lead, context = (list(x) for x in zip(*rows, strict=True))
        m, lead = len(rows), np.array(lead)
        left, right = np.zeros((m, max(1, reach)), np.uint8), np.zeros((m, min_length), np.uint8)
        length = np.zeros(m, np.int64)
        for i, (n, text) in enumerate(zip(lead.tolist(), context, strict=True)):
            data = np.frombuffer(text, np.uint8)
            if n:
                left[i, reach - n : reach] = data[:n]
            length[i] = len(data) - n
            right[i, : length[i]] = data[n:]
        most, fewest = expand(np.array(bucket), left[:, :reach] if reach else left[:, :0], lead, right, length, min_length)
        hit = np.flatnonzero(most >= 0)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.array(c1, np.int64)[hit]),
                pa.array(np.array(c2, np.int64)[hit]),
                pa.array(most[hit].astype(np.int32)),
                pa.array(fewest[hit].astype(np.int32)),
            ],
            names=["c1", "c2", "most", "fewest"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for row in (r for b in batches for at in range(0, b.num_rows, 500) for r in zip(*(c.to_pylist() for c in b.slice(at, 500).columns), strict=True)):
            if rows and row[:3] == rows[-1][:3]:
                continue
            if len(rows) >= EXPAND_ROWS and row[0] != rows[-1][0]:
                yield matches(rows)
                rows = []
            rows.append(row)
        if rows:
            yield matches(rows)

    return run


#: Stretches that the windows around an anchor are dealt into.
STRETCHES = 8


def _stretches(min_length: int) -> list[tuple[int, int]]:
    """First and last number of bytes left of the anchor of the windows in each stretch."""
    reach = min_length - anchor_length(min_length)
    step = -(-(reach + 1) // STRETCHES)
    return [(j, min(reach, j + step - 1)) for j in range(0, reach + 1, step)]


def _shared(min_length: int):
    """What all windows of a stretch share, as a hash, for the contexts of hot buckets.

    It lies within every window of the stretch, so a context that a text's end leaves only some of them holds it as well."""
    schema = pa.schema([("bucket", pa.int64()), ("stretch", pa.int32()), ("c1", pa.int64()), ("c2", pa.int64()), ("shared", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 500) for b in batches for at in range(0, b.num_rows, 500)):
            rows = []
            for bucket, c1, c2, lead, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for i, (low, high) in enumerate(_stretches(min_length)):
                    if max(low, min_length - len(data) + lead) <= min(high, lead):
                        rows.append((bucket, i, c1, c2, _signed(xxhash.xxh3_64_intdigest(data[lead - low : lead - high + min_length]))))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def _windows(min_length: int):
    """Windows of min_length bytes in the given stretches of contexts, as hashes with their place at the anchor."""
    schema = pa.schema([(c, pa.int64()) for c in ("bucket", "w1", "w2", "c1", "c2")] + [("j", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = []
                for bucket, c1, c2, lead, data, stretch in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True):
                    low, high = _stretches(min_length)[stretch]
                    for j in range(max(low, min_length - len(data) + lead), min(high, lead) + 1):
                        w = xxhash.xxh3_128_intdigest(data[lead - j : lead - j + min_length])
                        rows.append((bucket, _signed(w >> 64), _signed(w & (2**64 - 1)), c1, c2, j))
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Sorted, disjoint spans; touching ones are one."""
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return out


def _cut(n_columns: int, text_at: int, schema: T.StructType):
    arrow = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                all_spans, kept, texts = [], [], []
                for text, spans in zip(part.column(text_at).to_pylist(), part.column(n_columns).to_pylist(), strict=True):
                    data, last, pieces = _bytes(text), 0, []
                    spans = merged([(s["begin"], min(s["end"], len(data))) for s in spans or ()])
                    for begin, end in spans:
                        pieces.append(data[last:begin])
                        last = end
                    pieces.append(data[last:])
                    kept.append(b"".join(pieces))
                    texts.append(None if text is None else kept[-1].decode("utf-8", "ignore"))
                    all_spans.append([{"begin": b, "end": e} for b, e in spans])
                columns = [part.column(i) for i in range(n_columns)] + [pa.array(kept, pa.binary()), pa.array(texts, pa.string()), pa.array(all_spans, arrow)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return run


def _hot_matches(contexts: DataFrame, min_length: int, scratch: Scratch) -> DataFrame:
    """Matches within buckets of any size, grouped over the cluster."""
    hot = scratch.written(contexts.dropDuplicates(["bucket", "c1", "c2"]), "repeat-hot").repartition("c1", "c2")
    shared = hot.mapInArrow(_shared(min_length), "bucket long, stretch int, c1 long, c2 long, shared long")
    shared = scratch.written(shared, "repeat-stretches")
    match = ["bucket", "stretch", "shared"]
    twice = shared.groupBy(*match).agg(F.count("*").alias("n")).where("n > 1").select(*match)
    open_stretches = shared.join(twice, match).select("bucket", "stretch", "c1", "c2")
    windows = hot.join(open_stretches, ["bucket", "c1", "c2"]).select("bucket", "c1", "c2", "lead", "context", "stretch")
    windows = scratch.written(windows.mapInArrow(_windows(min_length), "bucket long, w1 long, w2 long, c1 long, c2 long, j int"), "repeat-windows")
    match = ["bucket", "j", "w1", "w2"]
    twice = windows.groupBy(*match).agg(F.count("*").alias("n")).where("n > 1").select(*match)
    # few windows, each in very many contexts: sent to the contexts, which then need no exchange
    twice = scratch.written(twice, "repeat-twice")
    if twice.count() <= SENT_ROWS:
        twice = F.broadcast(twice)
    return windows.join(twice, match).groupBy("c1", "c2").agg(F.max("j").alias("most"), F.min("j").alias("fewest"))


def without_repeats(docs: DataFrame, min_length: int = 400, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """docs (doc_id, text and any other columns) with three more columns: kept_bytes, the UTF-8 bytes of the text without
    every byte that a repeated string of min_length bytes covers; kept_text, these bytes as text without characters that
    were cut in two (null for a null text); removed_spans, the maximal runs taken out (begin, end; in bytes).

    A string is repeated if it starts anywhere else too, in the same text or another; matches do not cross texts.  Input
    columns with the names of new ones are replaced.  Null and empty texts have no bytes; texts shorter than min_length keep all; equal texts remove each other whole; rows that
    repeat an id are texts of their own; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    docs = docs.drop("kept_bytes", "kept_text", "removed_spans", "__key", "__text_hash", "__spans")
    scratch = Scratch()
    reach = min_length - anchor_length(min_length)
    place = [F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("key"), F.xxhash64("text").alias("text_hash")]
    keyed = docs.select(*place, F.col("text").cast("string").alias("text"))

    found = scratch.written(keyed.mapInArrow(_occurrences(min_length), _OCCURRENCES), "repeat-anchors")
    again = found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    found, anchored = scratch.written(found.join(again, "h").drop("h"), "repeat-candidates"), found
    discard(anchored)
    scratch.tables.remove(anchored)

    # one row for each context
    first = F.min(F.struct("key", "text_hash", "p")).alias("at")
    unique = found.groupBy("c1", "c2").agg(F.count("*").alias("n"), first, F.min("left_half").alias("l"), F.min("right_half").alias("r"))
    unique = scratch.written(unique.select("c1", "c2", "n", "at.*", "l", "r"), "repeat-contexts")
    whole = unique.where("n > 1").select("c1", "c2", F.least("p", F.lit(reach)).alias("most"), F.lit(None).cast("int").alias("fewest"))

    halves = unique.select("c1", "c2", "key", "text_hash", "p", F.explode(F.array("l", "r")).alias("bucket")).where("bucket is not null")
    sizes = scratch.written(halves.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1"), "repeat-buckets")

    def contexts_of(buckets: DataFrame) -> DataFrame:
        wanted = halves.join(buckets.select("bucket"), "bucket").groupBy("key", "text_hash")
        wanted = wanted.agg(F.collect_list(F.struct("bucket", "c1", "c2", "p")).alias("wanted"))
        cut = keyed.join(wanted, ["key", "text_hash"]).select("text", "wanted")
        return cut.mapInArrow(_contexts(min_length), "bucket long, c1 long, c2 long, lead int, context binary")

    cool = contexts_of(sizes.where(F.col("m") <= bucket_rows)).repartition("bucket").sortWithinPartitions("bucket", "c1", "c2")
    hits = whole.union(cool.mapInArrow(_expanded(min_length), _MATCHES))
    large = sizes.where(F.col("m") > bucket_rows)
    if not is_empty(large):
        hits = hits.union(_hot_matches(contexts_of(large), min_length, scratch))
    # a whole context reaches to its ends; for it `fewest` is what its length leaves
    spans = hits.groupBy("c1", "c2").agg(
        F.max("most").alias("most"),
        F.min("fewest").alias("fewest"),
        F.max(F.col("fewest").isNull()).alias("whole"),
    )
    end = F.when(F.col("whole"), F.lit(min_length)).otherwise(F.lit(min_length) - F.col("fewest"))
    spans = found.join(spans, ["c1", "c2"]).select(
        "key", "text_hash", F.struct((F.col("p") - F.col("most")).alias("begin"), (F.col("p") + end).alias("end")).alias("span")
    )
    spans = spans.groupBy("key", "text_hash").agg(F.collect_set("span").alias("__spans"))
    spans = written(spans.withColumnsRenamed({"key": "__key", "text_hash": "__text_hash"}), "repeat-spans")
    scratch.clear()

    names = docs.columns
    with_keys = docs.select("*", place[0].alias("__key"), place[1].alias("__text_hash"))
    joined = with_keys.join(spans, ["__key", "__text_hash"], "left").select(*names, "__spans")
    schema = T.StructType(
        docs.schema.fields
        + [
            T.StructField("kept_bytes", T.BinaryType()),
            T.StructField("kept_text", T.StringType()),
            T.StructField("removed_spans", T.ArrayType(T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
        ]
    )
    return joined.mapInArrow(_cut(len(names), names.index("text"), schema), schema)
