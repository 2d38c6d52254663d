"""Connected components by alternating stars, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sourcetrail.llm.tables import discard, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them; edges run from large to small."""
    down = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (columns u, v); component is the smallest node reachable.

    Loops, repeated edges and rows with a null are allowed; an empty input gives no rows.  Each round is written to
    the shared folder; the loop ends when a round leaves the edges as they were (every node then points at its
    smallest node).
    """
    edges = edges.select("u", "v").where("u is not null and v is not null")
    nodes = edges.select(F.col("u").alias("node")).union(edges.select(F.col("v").alias("node"))).distinct()
    seen, star, last = None, edges.where("u <> v"), None
    while True:
        star = written(_small_star(_large_star(star)), "components")
        if last is not None:
            discard(last)
        last = star
        state = star.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    lower = star.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return nodes.join(lower, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
