"""Hard negatives against all pairs."""

import duckdb
import numpy as np
import pytest

from sourcetrail.llm import cover_tree
from sourcetrail.llm.queries import LLM_ORACLES, op11_hard_negatives

SCHEMA = "vec_id long, label long, components array<long>, row string, ids string, anchor string, window string, score string, tree string"


def product(a, b):
    return sum(x * y for x, y in zip(a, b))


def mined(rows, every, positives=5, negatives=10, low=30, high=90):
    """rows: (vec_id, label, vector)."""
    rows = [r for r in rows if None not in r and None not in r[2]]
    out = []
    for n, (a, label, v) in enumerate(rows):
        if a % every:
            continue
        scored = [(-product(v, w), i, other == label) for m, (i, other, w) in enumerate(rows) if m != n]
        for score, i, _ in sorted(s for s in scored if s[2])[:positives]:
            fit = sorted(s[:2] for s in scored if not s[2] and low * -score <= 100 * -s[0] <= high * -score)
            out += [(a, i, rank, j, -score, -s) for rank, (s, j) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def found(spark, rows, every, **options):
    df = spark.createDataFrame([(*r, *"abcdef") for r in rows], SCHEMA).repartition(3)
    got = cover_tree.mine(df, lambda i: i % every == 0, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def clustered(rng, n, wide, spread):
    centers = rng.integers(-200, 201, (6, wide))
    return centers[rng.integers(0, 6, n)] + rng.integers(-spread, spread + 1, (n, wide))


@pytest.mark.parametrize("spread,copies", [(3, 0), (40, 300), (400, 0), (0, 0)])
def test_trees_are_exact(spread, copies):
    rng = np.random.default_rng(spread)
    vectors = clustered(rng, 1200, 12, spread)
    vectors[:copies] = vectors[0]
    labels, ids, rows = rng.integers(0, 4, 1200), rng.integers(0, 900, 1200), np.arange(1200)
    tree = cover_tree.CoverTree.grown(rows, ids, labels, vectors)
    assert sorted(tree.rows.tolist()) == rows.tolist()
    most, least = tree.bounds(vectors[:50])
    for a in range(50):
        scores = tree.vectors @ vectors[a]
        for v, (first, last) in enumerate(zip(tree.first, tree.last)):
            assert first == last or (most[a, v] >= scores[first:last].max() and least[a, v] <= scores[first:last].min())
        top = int(scores.max())
        windows = [(-np.inf, np.inf), (top * 3 // 10, top * 9 // 10), (0, 0), (top + 1, np.inf)]
        wanted = tree.labels == labels[a]
        for several in (windows, *([w] for w in windows)):
            best = [[] for _ in several]
            tree.search(vectors[a], most[a], least[a], several, wanted, best, 10)
            for (low, high), found in zip(several, best):
                fit = wanted & (scores >= low) & (scores <= high)
                assert found == sorted((-int(s), int(i), int(r)) for s, i, r in zip(scores[fit], tree.ids[fit], tree.rows[fit]))[:10]


def test_shards_and_blocks(spark):
    rng = np.random.default_rng(9)
    vectors = clustered(rng, 300, 6, 30).tolist()
    vectors[40:90] = [vectors[40]] * 50  # ties
    rows = [(int(i), int(c), v) for i, c, v in zip(rng.integers(0, 250, 300), rng.integers(0, 3, 300), vectors)]  # ids repeat
    expected = mined(rows, 10)
    assert expected and found(spark, rows, 10) == expected
    assert found(spark, rows, 10, shard_rows=64, anchor_bytes=400) == expected


def test_edge_cases(spark):
    rows = [
        (0, 1, [10, 0]), (1, 1, [10, 5]), (2, 2, [5, 5]), (3, 2, [9]), (4, 2, []), (5, None, [1, 1]), (None, 1, [1, 1]), (6, 1, None),
        (7, 1, [1, None]), (10, 3, [0, 0, 0]), (10, 3, [0, 0]), (20, 1, [-10, 0]), (30, 4, [2**31, 1]), (31, 4, [2**31, 2]), (32, 5, [2**30, 2]),
    ]
    expected = mined(rows, 10)
    assert {r[0] for r in expected} == {0, 10, 30}
    assert found(spark, rows, 10) == expected
    assert found(spark, [], 10) == [] == found(spark, rows, 1000, positives=0) == found(spark, rows[:2], 10)


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    rows = op11_hard_negatives(spark, folder)
    expected = con.execute(LLM_ORACLES["op11_hard_negatives"])
    assert [c[0] for c in expected.description] == rows.columns
    assert sorted(tuple(r) for r in rows.collect()) == sorted(expected.fetchall())
