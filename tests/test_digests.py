"""Tree digests against a plain version."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sourcetrail.operators import digest, observed


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(items, digits):
    leaves = defaultdict(list)
    for h in map(sha, items):
        leaves[h[:digits]].append(h)
    return sha("".join(leaf + sha("".join(sorted(hs))) for leaf, hs in sorted(leaves.items()))), len(items)


@pytest.mark.parametrize("digits", [1, 4])
def test_tree_digest_of_any_partitioning(spark, digits):
    rng = random.Random(digits)
    rows = [("hot", f"item {rng.randrange(3000)}") for _ in range(5000)] + [("k", "a"), ("k", "a"), ("k", ""), (None, "é"), ("nothing", None)]
    expected = {
        k: plain([i for key, i in rows if key == k], digits) for k in ("hot", "k", None)
    }
    for parts in (1, 13):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "k string, v string").repartition(parts)
        got = {r.k: (r.digest, r.n_items) for r in digest.tree_digest(df, ["k"], F.col("v"), digits).collect()}
        assert got == expected
    # one item more or less, or one changed, is another digest
    df = spark.createDataFrame([("x", "a"), ("x", "b"), ("y", "a"), ("y", "b"), ("y", "b"), ("z", "a"), ("z", "c")], "k string, v string")
    assert len({r.digest for r in digest.tree_digest(df, ["k"], F.col("v"), digits).collect()}) == 3


def test_a_hot_group_is_spread(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("k"), F.col("id").cast("string").alias("v"))
    leaves = df.groupBy("k", F.substring(F.sha2("v", 256), 1, 4).alias("leaf")).count()
    assert leaves.agg(F.max("count")).first()[0] < 20 and digest.tree_digest(df, ["k"], F.col("v")).first().n_items == 20_000


def test_outcomes_of_rules_that_abort(spark):
    df = spark.createDataFrame([(1,), (None,)], "n int")
    assert observed.fail_outcome(df.where("n = 1"), {"positive": "n > 0"}) == "passed"
    assert observed.fail_outcome(df, {"positive": "n > 0", "small": "n < 5"}) == "expectation failed: positive, small"
    with pytest.raises(Exception, match="nowhere"):
        observed.fail_outcome(df, {"wrong": "nowhere > 0"})
