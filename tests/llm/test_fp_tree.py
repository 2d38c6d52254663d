"""Ranked search against counting everything."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from sourcetrail.llm import fp_tree
from sourcetrail.llm.queries import LLM_ORACLES, op12_ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCUMENTS = "doc_id long, text string, n string, terms string, item string, score string, rank string"
ITEMS = "item_id string, text string, item long, doc_id string, part string"


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranking(docs, items, k):
    """Rows (item_id, rank, doc_id, score) for lists of (id, text)."""
    counts = [(i, Counter(words(t))) for i, t in docs if words(t)]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counts:
            m = 10 + 90 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(words(text)) if c[t])
            scores += [(-score, i is None, i or 0, i)] * (score > 0)
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, k, **options):
    docs = spark.createDataFrame([(*d, *"vwxyz") for d in docs], DOCUMENTS).repartition(3)
    items = spark.createDataFrame([(*i, 7, "x", "y") for i in items], ITEMS)
    rows = fp_tree.ranked_documents(docs, items, k, **options)
    assert rows.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in rows.collect()), key=repr)


@pytest.mark.parametrize("leaf", [1, 3, 64])
def test_trees_are_exact(leaf):
    rng = np.random.default_rng(leaf)
    n_terms, n = 30, 400
    vectors = [np.unique(rng.zipf(1.3, rng.integers(1, 15)) % n_terms) for _ in range(n)]
    vectors[50:120] = [vectors[50]] * 70  # more of one vector than a leaf takes
    sizes = np.array([len(v) for v in vectors])
    tf, m = rng.integers(1, 9, sizes.sum()), rng.integers(10, 300, n)
    flat = np.concatenate([rng.permutation(v) for v in vectors]).astype(np.int64)
    ids = [None if i % 50 == 49 else int(x) for i, x in enumerate(rng.integers(0, 300, n))]
    tree = fp_tree.Tree(ids, m, sizes, flat, tf, n_terms, leaf)
    doc, impact = np.repeat(np.arange(n), sizes), fp_tree.impacts(tf, np.repeat(m, sizes))
    for _ in range(40):
        asked = rng.choice(n_terms, rng.integers(1, 12), replace=False)
        weights = rng.integers(0, 5, len(asked))
        weight_of = np.zeros(n_terms, np.int64)
        weight_of[asked] = weights
        scores = np.bincount(doc, weight_of[flat] * impact, n).astype(int)
        best = []
        tree.search(asked, weights, weight_of, best, 10)
        assert best == sorted((-int(s), i is None, i or 0) for s, i in zip(scores, ids) if s > 0)[:10]


def test_ranks_of_edge_cases(spark):
    docs = [
        (0, None), (1, ""), (2, " .,;"), (3, "alpha beta"), (4, "ALPHA beta"), (4, "alpha, beta!"), (None, "alpha beta"),
        (5, "alpha " * 5000 + "gamma"), (6, "Ärger ärger alpha2 日本 日本"), (7, "beta\x00gamma\tdelta"), (8, "nothing of it"),
        *((i, "beta beta beta") for i in range(9, 15)),
    ]
    items = [
        ("a", "Alpha alpha BETA"), ("a", "alpha"), (None, "gamma"), ("b", None), ("c", ""), ("d", "unseen words"), ("e", "ärger 日本"),
        ("f", "beta " * 3000),
    ]
    for k, block_terms in ((10, 16_384), (2, 2)):
        assert found(spark, docs, items, k, block_terms=block_terms) == ranking(docs, items, k)
    assert found(spark, [], items, 3) == [] == found(spark, docs, [], 3) == found(spark, docs[:3], items, 3)


def test_query_equals_sql_and_counting(spark):
    folder = "/root/testdata/sf0.001"
    rows = sorted((tuple(r) for r in op12_ranked_search(spark, folder).select("item_id", "rank", "doc_id", "score").collect()), key=repr)
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    assert rows == sorted(con.execute(LLM_ORACLES["op12_ranked_search"]).fetchall(), key=repr)
    given = [[tuple(r) for r in con.execute(f"SELECT {c}, text FROM {t}").fetchall()] for c, t in (("doc_id", "documents"), ("item_id", "benchmark"))]
    assert rows == ranking(*given, 10)
