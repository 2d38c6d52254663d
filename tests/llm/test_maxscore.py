import numpy as np

from sourcetrail.llm import maxscore


def test_shard_search_is_exact():
    rng = np.random.default_rng(2)
    for spread, zero in ((40, 0.0), (3, 0.5), (300, 0.9)):
        v = rng.integers(-spread, spread + 1, (500, 16)) * (rng.random((500, 16)) >= zero)
        ids = rng.permutation(500)
        shard = maxscore.Shard(ids, v)
        for q in range(0, 500, 25):
            scores = v @ v[q]
            order = [i for i in np.lexsort((ids, -scores)) if i != q][:10]
            assert shard.search(v[q], 10, int(ids[q]), None) == [(int(scores[i]), int(ids[i])) for i in order]


def test_shards_and_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "SHARD_ROWS", 7)
    monkeypatch.setattr(maxscore, "BLOCK_ROWS", 3)
    rng = np.random.default_rng(5)
    rows = [(i, [int(x) for x in rng.integers(-2, 3, 4)]) for i in range(60)]  # many ties
    more = [(60, None), (61, [1, None, 2, 3]), (None, [1, 1, 1, 1])]
    schema = "vec_id long, components array<int>, block int, ids int"
    df = spark.createDataFrame([(*r, 1, 2) for r in rows + more], schema)
    got = {}
    for x in maxscore.search(df, df.where("vec_id % 10 = 0"), 5).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append((x.score, x.vec_id))
    for q in range(0, 60, 10):
        scores = sorted((-int(np.dot(v, rows[q][1])), i) for i, v in rows if i != q)
        assert got[q] == [(-s, i) for s, i in scores[:5]]
    assert set(got) == set(range(0, 60, 10))
    two = spark.createDataFrame([(0, [1, 2], 1, 2), (1, [3, 4], 1, 2)], schema)
    assert [(x.query_id, x.rank, x.vec_id, x.score) for x in maxscore.search(two, two.where("vec_id = 0"), 5).collect()] == [(0, 1, 1, 11)]
    assert maxscore.search(two.where("false"), two, 5).collect() == [] == maxscore.search(two, two.where("false"), 5).collect()


def test_components_beyond_32_bits(spark):
    df = spark.createDataFrame([(0, [1, 2]), (1, [2**31, 3]), (2, [-(2**33), 5])], "vec_id long, components array<long>")
    got = [(x.vec_id, x.score) for x in maxscore.search(df, df.where("vec_id = 0"), 2).orderBy("rank").collect()]
    assert got == [(1, 2**31 + 6), (2, -(2**33) + 10)]
