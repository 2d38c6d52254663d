import math
import random
import tracemalloc
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from sourcetrail.llm import gru_lm
from tests.llm import helpers


def test_gradients_equal_differences():
    net, rng = gru_lm.Network(seed=1), np.random.default_rng(0)
    for k in net.w:
        net.w[k] = net.w[k].astype(float) + 0.1 * rng.standard_normal(net.w[k].shape)
    before, target = rng.integers(0, gru_lm.CLASSES, (5, 3)), rng.integers(0, gru_lm.CLASSES, (5, 3))
    fresh, used = np.zeros((5, 3), bool), np.ones((5, 3), bool)
    fresh[0], fresh[3, 1], used[4, 2] = True, True, False
    state = np.zeros((3, gru_lm.HIDDEN))

    def loss():
        logs = net.logs(net.forward(before, fresh, state)["new"])[np.arange(15), target.ravel()]
        return -(logs * used.ravel()).sum() / used.sum()

    g, _ = net.gradients(before, fresh, target, used, state)
    for k in net.w:
        at = (before[1, 0], 3) if k == "read" else tuple(int(rng.integers(0, s)) for s in net.w[k].shape)
        old, step = net.w[k][at], 1e-2
        net.w[k][at] = old + step
        high = loss()
        net.w[k][at] = old - step
        low = loss()
        net.w[k][at] = old
        assert abs((high - low) / (2 * step) - g[k][at]) < 1e-5


def test_state_is_carried_over_windows_and_streams_do_not_mix():
    net, rng = gru_lm.Network(seed=2), np.random.default_rng(1)
    docs = [rng.integers(0, gru_lm.CLASSES, n) for n in (1, 5, 200, 33, 700)]
    shares = np.full(gru_lm.CLASSES, 1 / gru_lm.CLASSES)
    together = gru_lm.score(net, docs, shares)
    for doc, s in zip(docs, together, strict=True):
        h, total = np.zeros((1, gru_lm.HIDDEN), np.float32), 0.0
        for t, c in enumerate(doc):
            f = net.forward(np.array([[doc[t - 1] if t else 0]]), np.array([[t == 0]]), h)
            h, total = f["last"], total + math.log((1 - gru_lm.PLAIN) * math.exp(net.logs(f["new"])[0, c]) + gru_lm.PLAIN * shares[c])
        assert abs(total / math.log(10) - s) < 1e-3 * len(doc)


def test_scores_on_a_small_corpus(spark):
    r = random.Random(0)
    one, two = [f"a{i}x" for i in range(60)], [f"b{i}y" for i in range(60)]
    texts = [" ".join(r.choice(lang) for _ in range(r.randint(5, 80))) for lang in [one, two] * 300] + [None, "", "Never seen A1X", "a2x b2y", "a2x b2y", "a1x " * 3000]
    rows = gru_lm.score_documents(helpers.documents(spark, texts), F.col("doc_id") % 10 == 0).collect()
    tokens = [[*(t or "").encode().lower().split(), b""] for t in texts]
    counts = Counter(w for i, ws in enumerate(tokens) if i % 10 for w in ws)
    n, v = sum(counts.values()), len(counts)
    for x in rows:
        ws = tokens[x.doc_id]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert abs(x.base_score - base) < 1e-6 * len(ws) and x.n_tokens == len(ws) and x.train_tokens == n
        assert x.n_known == sum(counts[w] > 0 for w in ws) and x.held_out == (x.doc_id % 10 == 0) and x.score < 0
    held = [x for x in rows if x.held_out and x.doc_id < 600]
    assert sum(x.score for x in held) > sum(x.base_score for x in held)
    assert len(rows) == len(texts)


def test_without_training_rows(spark):
    rows = gru_lm.score_documents(helpers.documents(spark, ["a b", None]), F.lit(True)).collect()
    assert sorted((x.n_tokens, x.n_known, x.train_tokens, x.base_score) for x in rows) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]
    assert gru_lm.score_documents(helpers.documents(spark, []), F.lit(False)).collect() == []


def test_memory_follows_the_window_not_the_longest_text():
    net, rng = gru_lm.Network(seed=3), np.random.default_rng(2)
    docs = [rng.integers(0, gru_lm.CLASSES, n) for n in (40_000, *[20] * 300)]
    shares = np.full(gru_lm.CLASSES, 1 / gru_lm.CLASSES)
    tracemalloc.start()
    try:
        scores = gru_lm.score(net, docs, shares)
        gru_lm.train(net, gru_lm.Adam(net, 0.001), docs[:200])
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (scores < 0).all() and most < 60e6
