"""SentencePiece ids of whole texts by a table of distinct chunks.

A marked text has the marker in the place of each space and one before it.  Where no piece holds a marker after another
character, no merge crosses the place before a run of markers, so a text's ids are those of its chunks in order: a chunk is
a run of markers with what follows up to the next run.

Documents form blocks of some millions of characters.  A block keeps its distinct chunks, dealt into buckets by hash, and
each of its documents as the numbers of its chunks.  A bucket of the table gathers the chunks of all blocks; each distinct
one is segmented once, by the library itself.  The ids go back to the blocks, where numbers become ids by position.  Only
distinct chunks of blocks and numbers are exchanged, both packed.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sourcetrail.llm.tables import ship

MARK = "▁"
#: Characters of a block at least (its last document may be longer), and chunk numbers that one row holds at least.
BLOCK_CHARS, ROW_NUMBERS = 8 << 20, 1 << 18
#: Bytes of text whose distinct chunks one bucket takes, and tasks at most of each exchange.
BUCKET_BYTES, MOST_TASKS = 128 << 20, 50_000
#: Chunks of a block whose numbers follow their frequency, as small numbers pack better.
FREQUENT = 1 << 16

_CHUNKS = re.compile(r" +[^ ]*")
_CROSSING = re.compile(f"[^{MARK}]{MARK}")
#: route: where a row goes, a bucket's number, or -1 minus a block's number.
_ROWS = "route long, block long, kind int, part int, doc_ids array<long>, sizes array<int>, data binary"
_ARROW = pa.schema([
    ("route", pa.int64()), ("block", pa.int64()), ("kind", pa.int32()), ("part", pa.int32()),
    ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("data", pa.binary()),
])
_IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
WORDS, ORDER, TEXTS = range(3)


def processor(model: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=model)


def chunks_are_apart(model: str) -> bool:
    """Whether the model marks spaces in front, leaves all other characters as they are, and has no piece over a marker."""
    sp = processor(model)
    same = "ﬁ１ é \t\n​　A"
    if sp.normalize("a") != MARK + "a" or sp.normalize("  " + same + " ") != f"{MARK * 3}{same.replace(' ', MARK)}{MARK}":
        return False
    return not any(_CROSSING.search(sp.id_to_piece(i)) for i in range(sp.get_piece_size()))


def chunks(text: str) -> list[str]:
    """Chunks of the marked text without their first marker, other markers as spaces."""
    if not text:
        return []
    text = " " + text.replace(MARK, " ")
    if "  " in text or text.endswith(" "):
        return [c[1:] for c in _CHUNKS.findall(text)]
    return text.split(" ")[1:]


def _packed(*arrays: np.ndarray | bytes) -> bytes:
    """Byte strings and arrays of 32-bit numbers, these by byte position, compressed."""
    out = []
    for a in arrays:
        raw = a if isinstance(a, bytes) else np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
        data = pa.compress(raw, codec="zstd", asbytes=True)
        out += [len(raw).to_bytes(8, "little"), len(data).to_bytes(8, "little"), data]
    return b"".join(out)


def _unpacked(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        raw, size = int.from_bytes(data[at : at + 8], "little"), int.from_bytes(data[at + 8 : at + 16], "little")
        out.append(pa.decompress(data[at + 16 : at + 16 + size], raw, codec="zstd", asbytes=True) if raw else b"")
        at += 16 + size
    return out


def _numbers(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


class Block:
    """Documents as numbers of chunks, and the distinct chunks."""

    def __init__(self, number: int, whole: bool = False):
        self.number, self.whole, self.size = number, whole, 0
        self.known: defaultdict[str, int] = defaultdict()
        self.known.default_factory = self.known.__len__
        self.doc_ids: list[int | None] = []
        self.numbers: list[np.ndarray] = []

    def add(self, doc_id: int | None, text: str) -> None:
        parts = [text.replace(MARK, " ")] * bool(text) if self.whole else chunks(text)
        self.doc_ids.append(doc_id)
        self.numbers.append(np.fromiter(map(self.known.__getitem__, parts), np.uint32, len(parts)))
        self.size += len(text)

    def rows(self, buckets: int) -> Iterator[tuple]:
        """The distinct chunks by bucket, the frequent ones' places among them, the documents."""
        keys = list(self.known)
        bucket = np.fromiter((zlib.crc32(k.encode()) % buckets for k in keys), np.int64, len(keys))
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=buckets))
        home = -1 - self.number
        for a, b in zip(cuts, cuts[1:]):
            data = _packed(MARK.join(keys[i] for i in order[a:b]).encode())
            yield int(bucket[order[a]]), self.number, WORDS, int(bucket[order[a]]), None, None, data
        # frequent chunks have the first numbers; the others follow in the order of the table
        places = np.empty(len(keys), np.uint32)
        places[order] = np.arange(len(keys), dtype=np.uint32)
        flat = np.concatenate(self.numbers) if self.numbers else np.empty(0, np.uint32)
        frequent = np.argsort(-np.bincount(flat, minlength=len(keys)), kind="stable")[:FREQUENT]
        number = places + np.uint32(len(frequent))
        number[frequent] = np.arange(len(frequent), dtype=np.uint32)
        yield home, self.number, ORDER, 0, None, None, _packed(places[frequent])
        part, first, n = 0, 0, 0
        for i, a in enumerate(self.numbers):
            n += len(a)
            if n >= ROW_NUMBERS or i == len(self.numbers) - 1:
                taken = self.numbers[first : i + 1]
                data = _packed(number[np.concatenate(taken)])
                yield home, self.number, TEXTS, part, self.doc_ids[first : i + 1], [len(t) for t in taken], data
                part, first, n = part + 1, i + 1, 0


def _batch(row: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _ARROW, strict=True)], schema=_ARROW)


def _blocks(buckets: int, whole: bool, block_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        block = Block(number, whole)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                block.add(doc_id, text.as_py() or "")
                if block.size >= block_chars:
                    yield from map(_batch, block.rows(buckets))
                    block = Block(block.number + 1, whole)
        if block.doc_ids:
            yield from map(_batch, block.rows(buckets))

    return run


def _segmented(model: str):
    """Rows sorted by bucket: each distinct chunk of a bucket is segmented once, whatever blocks hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(model)
        lone = sp.encode("a ")[len(sp.encode("a")) :]  # a marker with nothing behind it; the library puts one before any text
        bucket, table = None, {}
        for batch in batches:
            routes, blocks, kinds = (batch.column(i).to_pylist() for i in range(3))
            for route, block, kind, data in zip(routes, blocks, kinds, batch.column(6), strict=True):
                if kind != WORDS:
                    continue
                if route != bucket:
                    bucket, table = route, {"": np.array(lone, "<u4")}
                keys = _unpacked(data.as_py())[0].decode().split(MARK)
                new = [k for k in keys if k not in table]
                for k, ids in zip(new, sp.encode(new, num_threads=1) if new else [], strict=True):
                    table[k] = np.array(ids, "<u4")
                found = [table[k] for k in keys]
                sizes = np.fromiter(map(len, found), np.uint32, len(found))
                yield _batch((-1 - block, block, WORDS, route, None, None, _packed(sizes, np.concatenate(found))))

    return run


def _joined(block: pa.Table, words: pa.Table) -> pa.Table:
    """The documents of a block with the ids of their chunks, by position."""
    if not block.num_rows or block["kind"][0].as_py() == WORDS:
        return _IDS.empty_table()
    order = np.argsort(words["part"].to_numpy(), kind="stable").tolist()
    parts = [_unpacked(words["data"][i].as_py()) for i in order]
    sizes = np.concatenate([_numbers(p[0]) for p in parts] + [np.empty(0, np.uint32)]).astype(np.int64)
    ids = np.concatenate([_numbers(p[1]) for p in parts] + [np.empty(0, np.uint32)]).astype(np.int32)
    kinds = block["kind"].to_pylist()
    frequent = _numbers(_unpacked(block["data"][kinds.index(ORDER)].as_py())[0])
    places = np.concatenate([frequent, np.arange(len(sizes), dtype=np.uint32)])
    starts, counts = (np.cumsum(sizes) - sizes)[places], sizes[places]
    out = []
    for i in (i for i, kind in enumerate(kinds) if kind == TEXTS):
        numbers = _numbers(_unpacked(block["data"][i].as_py())[0])
        begin, many = starts[numbers], counts[numbers]
        ends = np.cumsum(many)
        values = ids[np.repeat(begin - (ends - many), many) + np.arange(ends[-1] if len(ends) else 0)]
        at = np.concatenate([[0], np.cumsum(block["sizes"][i].as_py())])
        offsets = np.concatenate([[0], ends])[at].astype(np.int32)
        arrays = [pa.array(block["doc_ids"][i].as_py(), pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32()))]
        out.append(pa.RecordBatch.from_arrays(arrays, schema=_IDS))
    return pa.Table.from_batches(out, schema=_IDS)


def encode(docs: DataFrame, model: str, block_chars: int = BLOCK_CHARS, least_buckets: int = 32) -> DataFrame:
    """doc_id, ids (array of int): the ids of each whole text as the library gives them, without begin and end ids.

    docs: doc_id, text; other columns are ignored.  A null or empty text has no ids; rows that repeat an id or have none are
    documents of their own; an empty table gives no rows.  A text of any length is encoded whole; one without spaces is a
    single chunk.  Markers in the text count as spaces, as in the library.  With a model whose pieces cross markers, or that
    rewrites characters, each whole text is a chunk.  Memory follows a block (`block_chars` or the longest text) and a bucket.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(least_buckets, size // BUCKET_BYTES)
    tasks = min(max(buckets, size // BLOCK_CHARS), MOST_TASKS)
    # both exchanges go by the same key: documents as numbers move once, and their chunks' ids come to them
    blocks = docs.mapInArrow(_blocks(buckets, not chunks_are_apart(model), block_chars), _ROWS).repartition(tasks, "route")
    words = blocks.sortWithinPartitions("route").mapInArrow(_segmented(model), _ROWS).repartition(tasks, "route")
    return blocks.groupBy("route").cogroup(words.groupBy("route")).applyInArrow(_joined, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """The rows of `encoded` with the text of their `ids` as `decoded`.  No ids give an empty text, null ids a null."""
    ship(encoded.sparkSession)
    given = encoded.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = processor(model)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            texts = [sp.decode(x.as_py()) if x.is_valid else None for x in ids]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in given]
    return encoded.mapInArrow(run, ", ".join([*fields, "decoded string"]))
