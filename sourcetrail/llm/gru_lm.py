"""A gated recurrent language model with a class-factored softmax, in numpy.

Tokens are words and an end; the most frequent words are classes of their own, the others are clustered by their ending
according to the frequent words of the texts they stand in.  The recurrent network reads the classes so far and predicts
the next class; within its class a word has its smoothed share of the training counts.  Training is truncated
backpropagation through time: every task trains on its documents from a common start, and the tasks' weights are averaged
over the cluster.  Scoring carries the state across windows, so a document has one likelihood, whatever its length.
Counts of words are exact: frequent words are looked up in a table of fixed size, all others are joined.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sourcetrail.llm.shingles import words
from sourcetrail.llm.tables import ship, written

#: Words that are classes of their own, clusters of the other words, endings that are clustered.
OWN_CLASS, CLUSTERS, ENDINGS = 47, 16, 1024
CLASSES = 1 + OWN_CLASS + CLUSTERS
HIDDEN, WINDOW, STREAMS = 24, 32, 128
#: Words whose counts are at hand while texts are scored; the others are joined.
TABLE_WORDS = 30_000
#: Documents of the common start and of a chunk that is trained or scored at once.
START_DOCS, CHUNK_DOCS = 2000, 512
#: Weight of the classes' plain shares beside the network.
PLAIN = 0.02
END = b""


def tokenise(text: str | None) -> list[bytes]:
    return [*words(text), END]


# -- the network ----------------------------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Network:
    """Gated recurrent units over class ids, with a softmax over classes."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None, seed: int = 0):
        rng = np.random.default_rng(seed)

        def start(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / math.sqrt(HIDDEN)).astype(np.float32)

        self.w = weights or {
            "read": start(CLASSES, 3 * HIDDEN),
            "keep": start(HIDDEN, 2 * HIDDEN),
            "renew": start(HIDDEN, HIDDEN),
            "bias": np.zeros(3 * HIDDEN, np.float32),
            "out": start(HIDDEN, CLASSES) * 0.1,
            "out_bias": np.zeros(CLASSES, np.float32),
        }

    def forward(self, before: np.ndarray, fresh: np.ndarray, h: np.ndarray) -> dict[str, np.ndarray]:
        """before: classes read, one step a row; fresh: whether a document begins, which clears the state."""
        steps, n = before.shape
        x = self.w["read"][before] + self.w["bias"]
        x[fresh] = self.w["bias"]  # nothing was read at the start of a document
        old, new = np.empty((steps, n, HIDDEN), np.float32), np.empty((steps, n, HIDDEN), np.float32)
        gates, cand = np.empty((steps, n, 2 * HIDDEN), np.float32), np.empty((steps, n, HIDDEN), np.float32)
        hu = np.empty((steps, n, HIDDEN), np.float32)
        for t in range(steps):
            h = np.where(fresh[t][:, None], 0, h) if fresh[t].any() else h
            old[t] = h
            gates[t] = _sigmoid(x[t, :, : 2 * HIDDEN] + h @ self.w["keep"])
            hu[t] = h @ self.w["renew"]
            cand[t] = np.tanh(x[t, :, 2 * HIDDEN :] + gates[t, :, HIDDEN:] * hu[t])
            z = gates[t, :, :HIDDEN]
            h = cand[t] + z * (h - cand[t])
            new[t] = h
        return {"old": old, "gates": gates, "cand": cand, "hu": hu, "new": new, "last": h}

    def logs(self, h: np.ndarray) -> np.ndarray:
        """Logarithms of the class probabilities."""
        s = h.reshape(-1, HIDDEN) @ self.w["out"] + self.w["out_bias"]
        s -= s.max(1, keepdims=True)
        return s - np.log(np.exp(s).sum(1, keepdims=True))

    def gradients(self, before, fresh, target, used, state) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the mean loss over the used targets of one window, and the state after it."""
        f = self.forward(before, fresh, state)
        steps, n = before.shape
        error = np.exp(self.logs(f["new"]))
        error[np.arange(steps * n), target.ravel()] -= 1
        error *= used.ravel()[:, None] / max(1, int(used.sum()))
        error = error.astype(np.float32)
        flat = f["new"].reshape(-1, HIDDEN)
        g = {"out": flat.T @ error, "out_bias": error.sum(0)}
        dh_out = (error @ self.w["out"].T).reshape(steps, n, HIDDEN)
        dx = np.empty((steps, n, 3 * HIDDEN), np.float32)
        dh = np.zeros((n, HIDDEN), np.float32)
        dhu = np.empty((steps, n, HIDDEN), np.float32)
        for t in reversed(range(steps)):
            dh = dh + dh_out[t]
            z, r = f["gates"][t, :, :HIDDEN], f["gates"][t, :, HIDDEN:]
            dcand = dh * (1 - z) * (1 - f["cand"][t] ** 2)
            dz = dh * (f["old"][t] - f["cand"][t]) * z * (1 - z)
            dr = dcand * f["hu"][t] * r * (1 - r)
            dhu[t] = dcand * r
            dx[t, :, :HIDDEN], dx[t, :, HIDDEN : 2 * HIDDEN], dx[t, :, 2 * HIDDEN :] = dz, dr, dcand
            dh = dh * z + dx[t, :, : 2 * HIDDEN] @ self.w["keep"].T + dhu[t] @ self.w["renew"].T
            dh[fresh[t]] = 0
        flat_old = f["old"].reshape(-1, HIDDEN)
        g["keep"] = flat_old.T @ dx[:, :, : 2 * HIDDEN].reshape(-1, 2 * HIDDEN)
        g["renew"] = flat_old.T @ dhu.reshape(-1, HIDDEN)
        flat_dx = dx.reshape(-1, 3 * HIDDEN)
        g["bias"] = flat_dx.sum(0)
        hot = np.zeros((CLASSES, steps * n), np.float32)
        read = np.flatnonzero(~fresh.ravel())
        hot[before.ravel()[read], read] = 1
        g["read"] = hot @ flat_dx
        return g, f["last"]


@dataclass
class Window:
    """Some steps of the streams, one step a row: classes to predict and read, where a document begins, places that hold
    tokens, and (document, stream, first step, step after the last) of what is in it."""

    target: np.ndarray
    before: np.ndarray
    fresh: np.ndarray
    used: np.ndarray
    parts: list[tuple[int, int, int, int]]


class Streams:
    """Documents dealt over parallel streams of about the same length, the longest streams first.

    Only one window of them stands as matrices at a time, however long the documents are."""

    def __init__(self, docs: list[np.ndarray], n: int):
        n = max(1, min(n, len(docs)))
        load = [0] * n
        self.order: list[list[int]] = [[] for _ in range(n)]
        import heapq

        heap = [(0, i) for i in range(n)]
        for d in sorted(range(len(docs)), key=lambda i: -len(docs[i])):
            size, i = heapq.heappop(heap)
            self.order[i].append(d)
            load[i] = size + len(docs[d])
            heapq.heappush(heap, (load[i], i))
        self.order.sort(key=lambda o: -sum(len(docs[d]) for d in o))
        self.lengths = np.array([sum(len(docs[d]) for d in o) for o in self.order])
        self.docs = docs

    def windows(self) -> Iterator[Window]:
        """The windows, each of the streams that still run in it."""
        at_doc, read = [0] * len(self.order), [0] * len(self.order)  # where each stream stands
        longest = int(self.lengths.max(initial=0))
        for at in range(0, longest, WINDOW):
            steps, n = min(WINDOW, longest - at), int((self.lengths > at).sum())
            w = Window(*(np.zeros((steps, n), t) for t in (np.int64, np.int64, bool, bool)), [])
            for i in range(n):
                step = 0
                while step < steps and at_doc[i] < len(self.order[i]):
                    d, begin = self.order[i][at_doc[i]], read[i]
                    ids = self.docs[d]
                    end = min(len(ids), begin + steps - step)
                    stop = step + end - begin
                    w.target[step:stop, i] = ids[begin:end]
                    skip = int(begin == 0 and end > 0)  # nothing was read at the start of a document
                    w.before[step + skip : stop, i] = ids[begin + skip - 1 : end - 1]
                    if skip:
                        w.fresh[step, i] = True
                    w.used[step:stop, i] = True
                    w.parts.append((d, i, step, stop))
                    step, read[i] = stop, end
                    if end == len(ids):
                        at_doc[i], read[i] = at_doc[i] + 1, 0
            yield w


class Adam:
    def __init__(self, network: Network, rate: float):
        self.rate, self.t = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in network.w.items()}
        self.v = {k: np.zeros_like(v) for k, v in network.w.items()}

    def step(self, network: Network, g: dict[str, np.ndarray], filled: float) -> None:
        """filled: share of the window's places that hold tokens; a few streams must not move the weights like many."""
        self.t += 1
        norm = math.sqrt(sum(float((x * x).sum()) for x in g.values()))
        scale = min(1.0, 1.0 / (norm + 1e-9))
        for k, x in g.items():
            x = x * scale
            self.m[k] = 0.9 * self.m[k] + 0.1 * x
            self.v[k] = 0.99 * self.v[k] + 0.01 * x * x
            m, v = self.m[k] / (1 - 0.9**self.t), self.v[k] / (1 - 0.99**self.t)
            network.w[k] = (network.w[k] - filled * self.rate * m / (np.sqrt(v) + 1e-7)).astype(np.float32)


def train(network: Network, optimiser: Adam, docs: list[np.ndarray]) -> None:
    """One pass over documents (arrays of class ids) by truncated backpropagation; the state runs on over windows."""
    streams = Streams(docs, STREAMS)
    state = np.zeros((len(streams.order), HIDDEN), np.float32)
    for w in streams.windows():
        g, state = network.gradients(w.before, w.fresh, w.target, w.used, state[: w.used.shape[1]])
        optimiser.step(network, g, int(w.used.sum()) / (STREAMS * WINDOW))


def score(network: Network, docs: list[np.ndarray], shares: np.ndarray) -> np.ndarray:
    """Log10 probability of each document's class sequence; the network is mixed with a little of the plain shares."""
    streams = Streams(docs, 2 * STREAMS)
    state, totals = np.zeros((len(streams.order), HIDDEN), np.float32), np.zeros(len(docs))
    for w in streams.windows():
        f = network.forward(w.before, w.fresh, state[: w.used.shape[1]])
        logs = network.logs(f["new"])
        own = np.exp(logs[np.arange(w.target.size), w.target.ravel()]).reshape(w.target.shape)
        out = np.log((1 - PLAIN) * own + PLAIN * shares[w.target])
        for d, i, begin, stop in w.parts:
            totals[d] += out[begin:stop, i].sum(dtype=np.float64)
        state = f["last"]
    return totals / math.log(10)


# -- classes of words -----------------------------------------------------------------------------------------------


@dataclass
class Classes:
    """Class of any word: 0 for the end, own classes of frequent words, else the cluster of the word's ending."""

    own: dict[bytes, int]
    endings: dict[bytes, int]
    memory: dict[bytes, int] = field(default_factory=dict)

    def of(self, tokens: list[bytes]) -> np.ndarray:
        if len(self.memory) > 300_000:
            self.memory = {}
        known = self.memory
        if not known:
            known[END] = 0
            known.update(self.own)
        last = 1 + OWN_CLASS
        for w in set(tokens):
            if w not in known:
                known[w] = last + self.endings.get(w[-2:], CLUSTERS - 1)
        return np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))


def cluster(sums: np.ndarray, k: int, rounds: int = 20) -> np.ndarray:
    """Clusters rows of counts by their shares (k-means on square roots, started from the farthest rows)."""
    weight = sums.sum(1)
    x = np.sqrt((sums + 0.1) / (sums + 0.1).sum(1, keepdims=True))
    centres = [x[int(np.argmax(weight))]]
    while len(centres) < min(k, len(x)):
        far = np.min([((x - c) ** 2).sum(1) for c in centres], axis=0) * np.sqrt(weight)
        centres.append(x[int(np.argmax(far))])
    c = np.array(centres)
    label = np.zeros(len(x), int)
    for _ in range(rounds):
        label = ((x[:, None, :] - c[None]) ** 2).sum(2).argmin(1)
        for i in range(len(c)):
            if weight[label == i].sum() > 0:
                c[i] = np.average(x[label == i], axis=0, weights=weight[label == i])
    return label


# -- tasks ----------------------------------------------------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"])
        counts.clear()
        return rows

    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts.update(tokenise(text))
            if len(counts) > 400_000:
                yield out()
    if counts:
        yield out()


def _together(own: dict[bytes, int], endings: dict[bytes, int]):
    """How often words of an ending share a text with the frequent words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(endings), OWN_CLASS + 1))
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen = Counter(tokenise(text))
                shares, ends = np.zeros(OWN_CLASS + 1), Counter()
                for w, n in seen.items():
                    if w in own:
                        shares[own[w]] += n
                    elif w[-2:] in endings:
                        ends[endings[w[-2:]]] += n
                if ends and shares.any():
                    at = np.fromiter(ends.keys(), int, len(ends))
                    sums[at] += np.outer(np.fromiter(ends.values(), float, len(ends)), shares / shares.sum())
        i, j = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(sums[i, j])], names=["i", "j", "n"])

    return run


def _trained(classes: Classes, weights: dict[str, np.ndarray] | None, rate: float, passes: int):
    """Trains on the task's documents; returns the weights times the tokens they come from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network({k: v.copy() for k, v in weights.items()} if weights else None)
        optimiser, tokens = Adam(network, rate), 0
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_DOCS):
                docs = [classes.of(tokenise(t)) for t in batch.column(0).slice(at, CHUNK_DOCS).to_pylist()]
                tokens += sum(map(len, docs))
                for _ in range(passes):
                    train(network, optimiser, docs)
        if tokens:
            flat = np.concatenate([network.w[k].ravel() for k in sorted(network.w)]).astype(float)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat * tokens), pa.array(np.full(len(flat), tokens))], names=["i", "v", "n"])

    return run


def _unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at, shapes = {}, 0, Network().w
    for k in sorted(shapes):
        out[k] = flat[at : at + shapes[k].size].reshape(shapes[k].shape).astype(np.float32)
        at += shapes[k].size
    return out


def _averaged(docs: DataFrame, classes: Classes, weights: dict[str, np.ndarray] | None, rate: float, passes: int = 1) -> dict[str, np.ndarray]:
    made = docs.select("text").mapInArrow(_trained(classes, weights, rate, passes), "i int, v double, n long")
    rows = made.groupBy("i").agg((F.sum("v") / F.sum("n")).alias("v")).collect()  # one row for each weight of the network
    if not rows:
        return weights or Network().w
    flat = np.zeros(len(rows))
    for r in rows:
        flat[r["i"]] = r["v"]
    return _unpack(flat)


_SCORED = "doc_id long, held_out boolean, n_tokens long, known long, count_logs double, class_logs double, rare array<struct<word:binary,n:int>>"


def _scored(classes: Classes, network: Network, table: dict[bytes, float], class_sizes: np.ndarray):
    """One row for each document; words beyond the table are passed on with their numbers."""
    names = [x.split()[0] for x in "doc_id held_out n_tokens known count_logs class_logs rare".split()]
    rare_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())]))
    types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), rare_type]
    share = np.log10(class_sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_DOCS):
                part, rows, docs = batch.slice(at, CHUNK_DOCS), [], []
                for doc_id, text, held_out in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    tokens = tokenise(text)
                    ids = classes.of(tokens)
                    docs.append(ids)
                    known, logs, rare = 0, 0.0, []
                    for w, n in Counter(tokens).items():
                        c = table.get(w)
                        if c is None:
                            rare.append({"word": w, "n": n})
                        else:
                            known += n
                            logs += n * c
                    rows.append([doc_id, held_out, len(tokens), known, logs, -float(share[ids].sum()), rare])
                for row, s in zip(rows, score(network, docs, class_sizes / class_sizes.sum()), strict=True):
                    row[5] += float(s)
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return run


def score_documents(docs: DataFrame, held_out: Column) -> DataFrame:
    """Scores of all whole texts: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    docs: doc_id, text; held_out: boolean column of docs, true for rows that are not learned from (null counts as true).
    n_known: tokens seen in training; base_score: log10 probability under smoothed word shares; score: under the network.
    A null or empty text is the end token alone; repeated rows stay repeated and count as often in training; without
    training rows all words are unknown and the network is as it starts; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(held_out, F.lit(True)).alias("held_out"))
    training = docs.where("not held_out").select("doc_id", "text")
    counts = written(training.select("text").mapInArrow(_count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")), "lm-counts")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    frequent = counts.where(F.octet_length("word") > 0).orderBy(F.desc("c"), "word").limit(TABLE_WORDS).collect()
    own = {bytes(r["word"]): i + 1 for i, r in enumerate(frequent[:OWN_CLASS])}
    ending = F.substring("word", -2, 2)
    ends = counts.where(F.octet_length("word") > 0).groupBy(ending.alias("e")).agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "e").limit(ENDINGS)
    ends = {bytes(r["e"]): i for i, r in enumerate(ends.collect())}
    together = training.select("text").mapInArrow(_together(own, ends), "i int, j int, n double")
    sums = np.zeros((max(1, len(ends)), OWN_CLASS + 1))
    for r in together.groupBy("i", "j").agg(F.sum("n").alias("n")).collect():  # ENDINGS * OWN_CLASS at most
        sums[r["i"], r["j"]] = r["n"]
    labels = cluster(sums[:, 1:], CLUSTERS - 1)
    classes = Classes(own, {e: int(labels[i]) for e, i in ends.items()})

    start = training.orderBy(F.xxhash64("doc_id"), "doc_id").limit(START_DOCS).coalesce(1)
    weights = _averaged(start, classes, None, rate=0.01, passes=2)
    weights = _averaged(training, classes, weights, rate=0.003)

    def class_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = np.zeros(CLASSES)
        for batch in batches:
            ids = classes.of(batch.column(0).to_pylist())
            size += np.bincount(ids, batch.column(1).to_numpy() + 0.1, minlength=CLASSES)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES, dtype=np.int32)), pa.array(size)], names=["i", "n"])

    sizes = np.full(CLASSES, 0.1)  # what each class keeps for words that training has not seen
    for r in counts.mapInArrow(class_of, "i int, n double").groupBy("i").agg(F.sum("n").alias("n")).collect():
        sizes[r["i"]] += r["n"]
    table = {bytes(r["word"]): math.log10(r["c"] + 0.1) for r in frequent}
    for r in counts.where(F.octet_length("word") == 0).collect():  # the end token
        table[END] = math.log10(r["c"] + 0.1)
    if END not in table:
        table[END] = math.log10(0.1)

    scored = docs.mapInArrow(_scored(classes, Network(weights), table, sizes), _SCORED)
    scored = written(scored.select(F.monotonically_increasing_id().alias("row"), "*"), "lm-scores")
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", F.col("r.word").alias("word"), F.col("r.n").alias("n"))
    rare = rare.join(counts, "word", "left").groupBy("row")
    logs = F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.1))
    rare = rare.agg(logs.alias("rare_logs"), F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("rare_known"))
    n, v = total["n"], total["v"]
    count_logs = F.col("count_logs") + F.coalesce("rare_logs", F.lit(0.0))
    # the end token is in the table also where training has none
    known = F.col("known") + F.coalesce("rare_known", F.lit(0)) - (0 if n else 1)
    return scored.drop("rare").join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        known.cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (count_logs - F.col("n_tokens") * math.log10(n + 0.1 * (v + 1))).alias("base_score"),
        (count_logs + F.col("class_logs")).alias("score"),
    )
