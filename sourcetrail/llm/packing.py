"""Packing of tokenised documents into windows by non-negative least squares on the histogram of lengths.

Documents are cut into full windows and a rest.  Shallow combinations of up to three lengths that fill a window exactly
are enumerated, their repeat counts solved for by non-negative least squares against the histogram, rounded and held to
what is there.  The residual pieces are packed greedily, longest first, cut at the window's end.  The plan is bounded by
the window (a few thousand combinations), whatever the number of documents: a piece finds its place from its length and
its rank among the pieces of that length, and ranks come from counts per task, so nothing is sorted or gathered.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sourcetrail.llm.tables import ship, written

#: Words with their ids that a worker remembers, at most (about 150 bytes each).
CACHED_WORDS = 800_000
#: Longer stretches are encoded each time they occur.
LONGEST_WORD = 64
#: New words that are encoded in one call, characters of text and rows that are encoded together.
JOINED_WORDS, CHUNK_CHARS, CHUNK_ROWS = 500, 4 << 20, 2048
#: Combinations of three lengths for each smallest length.
TRIPLES = 16

#: White space as Python's \s knows it, before a space.
_SPACES = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}] "
_CUTS = re.compile(r"(?<=\S)(?= )")


class Encoder:
    """Token ids of whole texts.  A byte-level vocabulary never merges over a space that follows a non-space, so texts are
    encoded in stretches between such spaces.  A chunk's stretches are told apart by Arrow; the ids of those that occur
    again are remembered, one flat array for all with the place and number of each.  New ones are encoded joined, and
    the lengths of the tokens in bytes say where each ends."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        names = self.tokenizer.get_vocab()
        self.token_bytes = np.zeros(max(names.values(), default=0) + 1, np.int64)
        for name, i in names.items():  # a byte-level name has one character for each byte
            self.token_bytes[i] = len(added[i].content.encode()) if i in added else len(name)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.begins, self.counts = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.slots = 0

    def _remember(self, ids: np.ndarray, counts: np.ndarray) -> None:
        """Ids of more stretches, which get the next slots."""
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.slots + len(counts) > len(self.counts):
            self.begins, self.counts = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begins, self.counts))
        self.ids[self.used : self.used + len(ids)] = ids
        self.counts[self.slots : self.slots + len(counts)] = counts
        self.begins[self.slots : self.slots + len(counts)] = self.used + np.cumsum(counts) - counts
        self.used, self.slots = self.used + len(ids), self.slots + len(counts)

    def _one_by_one(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(stretches, add_special_tokens=False)]
        flat = np.fromiter((i for ids in found for i in ids), np.uint32, sum(map(len, found)))
        return flat, np.fromiter(map(len, found), np.int64, len(found))

    def _encoded(self, stretches: list[str], joined: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of stretches that begin with a space, and how many each has; so many at the start end in no white space."""
        flats, counts = [], []
        sizes = pc.binary_length(pa.array(stretches, pa.large_string())).to_numpy(zero_copy_only=False)
        for at in range(0, joined, JOINED_WORDS):
            part = stretches[at : min(joined, at + JOINED_WORDS)]
            ends = np.cumsum(sizes[at : at + len(part)])
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            reached = np.cumsum(self.token_bytes[ids])
            last = np.searchsorted(reached, ends)
            # a vocabulary without some byte leaves it out
            if not len(ids) or reached[-1] != ends[-1] or (reached[last] != ends).any():
                ids, n = self._one_by_one(part)
            else:
                n = np.diff(last + 1, prepend=0)
            flats.append(ids)
            counts.append(n)
        ids, n = self._one_by_one(stretches[joined:])
        return np.concatenate([*flats, ids]), np.concatenate([*counts, n])

    def _stretches(self, texts: pa.Array) -> tuple[list[str], pa.Array, np.ndarray]:
        """First stretch of each text, the others of all texts without the space they begin with, how many each text has."""
        parts = pc.split_pattern(texts, " ")
        odd = np.flatnonzero(pc.match_substring_regex(texts, _SPACES).to_numpy(zero_copy_only=False))
        if len(odd):
            lists = parts.to_pylist()
            for i in odd.tolist():
                first, *rest = _CUTS.split(texts[i].as_py())
                lists[i] = [first, *[s[1:] for s in rest]]
            parts = pa.array(lists, pa.large_list(pa.large_string()))
        values, ends = parts.flatten(), np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64))
        counts = np.diff(ends, prepend=0)
        first = ends - counts
        others = np.ones(len(values), bool)
        others[first] = False
        return values.take(pa.array(first)).to_pylist(), values.filter(pa.array(others)), counts - 1

    def encode(self, texts: list[str | None] | pa.Array) -> list[np.ndarray]:
        texts = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())).cast(pa.large_string()).fill_null("")
        if not len(texts):
            return []
        if len(self.known) > CACHED_WORDS:
            self.forget()
        firsts, others, many = self._stretches(texts)
        coded = others.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        slots = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(slots < 0)
        apart = np.fromiter((not words[i] or words[i][-1].isspace() for i in new.tolist()), bool, len(new))
        new = new[np.argsort(apart, kind="stable")]
        fresh = [words[i] for i in new.tolist()]
        slots[new] = np.arange(self.slots, self.slots + len(new))
        kept_used, kept_slots = self.used, self.slots
        self._remember(*self._encoded([" " + w for w in fresh], len(fresh) - int(apart.sum())))
        # each text's stretches in order, the first one's ids in slots of their own
        first_slots = np.arange(self.slots, self.slots + len(firsts))
        self._remember(*self._one_by_one(firsts))
        order = np.empty(len(others) + len(firsts), np.int64)
        starts = np.cumsum(many + 1) - (many + 1)
        at_first = np.zeros(len(order), bool)
        at_first[starts] = True
        order[at_first] = first_slots
        order[~at_first] = slots[coded.indices.to_numpy()]
        counts = self.counts[order]
        ends = np.cumsum(counts)
        flat = self.ids[np.arange(int(ends[-1])) + np.repeat(self.begins[order] - (ends - counts), counts)]
        long = [len(w) > LONGEST_WORD for w in fresh]
        if any(long):  # long ones and first stretches are not remembered; the others move up
            short = ~np.array(long)
            n, begin = self.counts[kept_slots : kept_slots + len(fresh)][short], self.begins[kept_slots : kept_slots + len(fresh)][short]
            ids = self.ids[np.arange(int(n.sum())) + np.repeat(begin - (np.cumsum(n) - n), n)]
            self.used, self.slots = kept_used, kept_slots
            self._remember(ids, n)
            fresh = [w for w, x in zip(fresh, long, strict=True) if not x]
        else:
            self.used, self.slots = int(self.begins[first_slots[0]]), int(first_slots[0])
        self.known.update(zip(fresh, range(kept_slots, kept_slots + len(fresh)), strict=True))
        return np.split(flat, ends[np.cumsum(many + 1) - 1][:-1])


def chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Begin and length of runs of rows of about CHUNK_CHARS bytes of text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(sizes):
        before = int(sizes[at - 1]) if at else 0
        end = min(max(at + 1, int(np.searchsorted(sizes, before + CHUNK_CHARS, side="right"))), at + CHUNK_ROWS)
        yield at, end - at
        at = end


_encoders: dict[str, Encoder] = {}


def encoder_for(path: str) -> Encoder:
    """The worker's encoder: what it remembers serves all tasks that the worker runs."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


@dataclass
class Plan:
    """Where the pieces of each length go.  runs[length]: (first rank, combination's first sequence, pieces of this length
    in a sequence, offset of the first); rest[length]: (first rank, place in the stream of residual pieces)."""

    window: int
    runs: dict[int, list[tuple[int, int, int, int]]] = field(default_factory=dict)
    rest: dict[int, tuple[int, int]] = field(default_factory=dict)
    sequences: int = 0
    residue: int = 0
    bounds: list[int] = field(default_factory=list)

    def places(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start in the piece, length, sequence, offset) of the piece's parts: one, unless it is cut."""
        if length in self.rest and rank >= self.rest[length][0]:
            first, base = self.rest[length]
            at, out, done = base + (rank - first) * length, [], 0
            while done < length:
                full = self.residue // self.window * self.window
                if at < full:
                    number, begin = at // self.window, at // self.window * self.window
                    end = begin + self.window
                else:
                    i = int(np.searchsorted(self.bounds, at, side="right")) - 1
                    number, begin, end = full // self.window + i, self.bounds[i], self.bounds[i + 1]
                take = min(length - done, end - at)
                out.append((done, take, self.sequences + number, at - begin))
                at, done = at + take, done + take
            return out
        runs = self.runs[length]
        low, high = 0, len(runs)
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if runs[mid][0] <= rank else (low, mid)
        first, sequence, many, offset = runs[low]
        return [(0, length, sequence + (rank - first) // many, offset + (rank - first) % many * length)]


def combinations_of(window: int) -> np.ndarray:
    """Rows of up to three lengths (0: none) that add up to the window."""
    rows = [(window, 0, 0)] + [(window - a, a, 0) for a in range(1, window // 2 + 1)]
    for a in range(1, window // 3 + 1):
        seconds = range(a, (window - a) // 2 + 1)
        for b in seconds[:: max(1, len(seconds) // TRIPLES)]:
            rows.append((window - a - b, b, a))
    return np.array(rows)


def least_squares(rows: np.ndarray, histogram: np.ndarray, rounds: int = 400) -> np.ndarray:
    """x >= 0 that minimises |A x - histogram|, A counting each length in each combination; accelerated projection."""
    flat, owner = rows.ravel(), np.repeat(np.arange(len(rows)), rows.shape[1])
    used = flat > 0
    flat, owner = flat[used], owner[used]
    per_length = np.bincount(flat, minlength=len(histogram))
    scale = 1 / np.sqrt(np.bincount(owner, per_length[flat], minlength=len(rows)))  # diagonal steps that cannot overshoot
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(rounds):
        error = np.bincount(flat, y[owner], minlength=len(histogram)) - histogram
        gradient = np.bincount(owner, error[flat], minlength=len(rows))
        new = np.maximum(0, y - scale**2 * gradient)
        faster = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / faster * (new - x), new, faster
    return x


def plan_for(counts: dict[int, int], window: int) -> Plan:
    """counts: number of pieces by length, 1 to window."""
    plan = Plan(window)
    histogram = np.zeros(window + 1)
    for length, n in counts.items():
        histogram[length] = n
    left = {length: n for length, n in counts.items() if n}
    rank = dict.fromkeys(left, 0)
    rows = combinations_of(window)
    present = np.all((rows == 0) | (histogram[rows] > 0), axis=1)
    rows = rows[present]
    if len(rows):
        repeats = least_squares(rows, histogram)
        repeats[rows[:, 0] == window] = counts.get(window, 0)
        for i in np.argsort(-repeats, kind="stable"):
            many = Counter(int(x) for x in rows[i] if x)
            times = min(int(round(repeats[i])), *(left[x] // n for x, n in many.items()))
            if times <= 0:
                continue
            offset = 0
            for length, n in sorted(many.items(), reverse=True):
                plan.runs.setdefault(length, []).append((rank[length], plan.sequences, n, offset))
                rank[length] += n * times
                left[length] -= n * times
                offset += n * length
            plan.sequences += times
    for length in sorted(left, reverse=True):
        if left[length]:
            plan.rest[length] = (rank[length], plan.residue)
            plan.residue += length * left[length]
    # the stream's end is cut into powers of two, which need no padding
    at = plan.residue // window * window
    plan.bounds = [at]
    for bit in reversed(range(window.bit_length())):
        if (plan.residue - plan.bounds[0]) >> bit & 1:
            at += 1 << bit
            plan.bounds.append(at)
    return plan


def _pieces(path: str, window: int, end_id: int):
    names = ["part", "doc_id", "start", "length", "doc_tokens", "nth", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seen, end = encoder_for(path), TaskContext.get().partitionId(), Counter(), np.array([end_id], np.uint32)
        narrow = encoder.tokenizer.get_vocab_size() <= 2**16
        for batch in batches:
            for at, n in chunks(batch.column(1)):
                piece = batch.slice(at, n)
                rows = []
                for doc_id, ids in zip(piece.column(0).to_pylist(), encoder.encode(piece.column(1)), strict=True):
                    ids = np.append(ids, end)
                    kept = ids.astype(np.uint16) if narrow else ids
                    for start in range(0, len(ids), window):
                        cut = kept[start : start + window]
                        rows.append((part, doc_id, start, len(cut), len(ids), seen[len(cut)], cut.tobytes()))
                        seen[len(cut)] += 1
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
                types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return run


_PACKED = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _placed(plan: Plan):
    names = [x.split()[0] for x in _PACKED.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                rows = []
                for doc_id, start, length, doc_tokens, rank, data in zip(*(c.to_pylist() for c in batch.slice(at, 1000).columns), strict=True):
                    ids = np.frombuffer(data, np.uint16 if len(data) == 2 * length else np.uint32).astype("<u4")
                    for begin, n, sequence, offset in plan.places(length, rank):
                        rows.append((doc_id, start + begin, n, ids[begin : begin + n].tobytes(), doc_tokens, sequence, offset))
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return run


def pack(docs: DataFrame, tokenizer_path: str, window: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces of all documents with their places: doc_id, start (ids of the document before it), length, ids (unsigned
    little-endian 32-bit), doc_tokens, sequence_id, offset.

    docs: doc_id, text; other columns are ignored.  A null or empty text has the end id alone; rows that repeat an id are
    documents of their own.  window is a power of two.  An empty table gives no rows.  Sequences are full except where
    the last residual pieces end, and those have lengths that are powers of two.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "part int, doc_id long, start long, length long, doc_tokens long, nth long, ids binary"
    pieces = written(docs.mapInArrow(_pieces(tokenizer_path, window, end_id), schema), "packing-pieces")
    # written by tasks that counted their pieces of each length: the counts of the tasks before give the ranks
    counts = written(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "packing-counts")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_for(histogram, window)
    ranked = pieces.join(before, ["part", "length"])
    ranked = ranked.select("doc_id", "start", "length", "doc_tokens", (F.col("before") + F.col("nth")).alias("rank"), "ids")
    return ranked.mapInArrow(_placed(plan), _PACKED)
