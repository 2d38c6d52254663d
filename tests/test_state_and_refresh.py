"""State by key whose storage follows the keys; tables refreshed for the cases that changed."""

import os
import random

import pytest
from pyspark.sql import functions as F

from sourcetrail import session
from sourcetrail.operators import cdc
from sourcetrail.plans import driver_feeds as D
from sourcetrail.plans import registry
from sourcetrail.streaming import case_tables, latest_state
from sourcetrail.streaming.run_folders import RunFolders

EVENTS = "k string, s double, v string, more struct<a:int,b:array<int>>"


def runs(folder):
    return sorted(n for n in os.listdir(folder) if n.startswith("run="))


def test_fifty_batches_leave_few_runs(spark, tmp_path):
    source, state, check = (str(tmp_path / n) for n in ("in", "state", "check"))
    rng = random.Random(4)
    keys = ["a", "b", None, *map(str, range(30))]
    rows = [
        (rng.choice(keys), rng.choice([None, float("nan"), 1.0, 2.0, 3.5]), rng.choice([None, "x", "é", "y"]), rng.choice([None, (1, [2, None]), (1, None), (None, [])]))
        for _ in range(2000)
    ]
    spark.createDataFrame(rows, EVENTS).repartition(50).write.parquet(source)
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(source)
    seen = []
    latest_state.start_latest_state(
        stream, ["k"], "s", state, check, merge_after=4, on_change=lambda rows, n: seen.append((n, rows.count()))
    ).awaitTermination()
    assert [n for n, _ in seen] == list(range(50)) and seen[0][1] > 10
    table = RunFolders(spark, state, spark.read.parquet(source).schema, ["k"], "s")
    assert len(table.current()) <= 6 and len(runs(state)) < 20
    batch = cdc.latest_by(spark.read.parquet(source), ["k"], "s")
    assert sorted(map(str, table.read().collect())) == sorted(map(str, batch.collect()))
    # what repeats or comes late changes nothing: no run gets rows
    spark.read.parquet(source).where("s < 3 or k = 'a'").coalesce(1).write.mode("append").parquet(source)
    changed = sum(n for _, n in seen)
    latest_state.start_latest_state(
        spark.readStream.schema(EVENTS).parquet(source), ["k"], "s", state, check, on_change=lambda rows, n: seen.append((n, rows.count()))
    ).awaitTermination()
    assert len(seen) == 51 and sum(n for _, n in seen) == changed


def test_state_has_a_store_per_core_at_most_and_runs_no_python(spark, tmp_path):
    source, state, check = (str(tmp_path / n) for n in ("in", "state", "check"))
    rows = [("a", 1.0, "x", None), ("a", 2.0, "y", (1, [2])), (None, None, None, None), (None, float("nan"), "z", None)]
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(source)
    events = spark.readStream.schema(EVENTS).parquet(source)
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        latest_state.start_latest_state(events, ["k"], "s", state, check).awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    stores = [n for n in os.listdir(f"{check}/state/0") if n.isdigit()]
    assert 0 < len(stores) <= spark.sparkContext.defaultParallelism
    plan = latest_state.changed_rows(events, ["k"], "s")._jdf.queryExecution().analyzed().toString()
    assert "MapInArrow" not in plan and "TransformWithState" not in plan
    got = latest_state.read_latest_state(spark, state, spark.read.parquet(source).schema, ["k"], "s").collect()
    assert sorted((str(r.k), r.v) for r in got) == [("None", "z"), ("a", "y")]


def test_runs_are_replaced_whole(spark, tmp_path):
    schema = "k int, s int"
    table = RunFolders(spark, str(tmp_path / "t"), schema, ["k"], "s")
    assert table.read().collect() == []

    def rows(*pairs):
        return spark.createDataFrame(pairs, schema).coalesce(1)

    for n in range(4):
        table.add(rows((1, n), (n, 9)), n)
    table.add(rows((1, 2), (3, 10)), 3)  # the batch is run again
    table.merge(after=2)
    assert table.current() == [(0, 3)] and len(table.complete()) == 5  # kept for readers that have listed them
    assert sorted(map(tuple, table.read().collect())) == [(0, 9), (1, 9), (2, 9), (3, 10)]
    for n in range(4, 8):
        table.add(rows((7, n)), n)
    os.remove(tmp_path / "t" / "run=7-7" / "_SUCCESS")  # as a writer that was lost leaves it
    table.merge(after=2)
    assert table.current()[-1][1] == 6 and not (tmp_path / "t" / "run=1-1").exists()
    assert (7, 6) in set(map(tuple, table.read().collect()))


VIEWS = {
    "totals": lambda read: read("rows").groupBy("case_id").agg(F.sum("n").alias("total"), F.count("*").alias("rows")),
    "large": lambda read: read("totals").where("total > 5").select("case_id"),
}


@pytest.mark.parametrize("buckets", [1, 7])
def test_refresh_gives_what_a_full_build_gives(spark, tmp_path, buckets):
    schema = "case_id string, id int, n int"
    batches = [
        [("a", 1, 2), ("b", 2, 9), (None, 3, 4), ("c", 4, 1)],
        [("a", 1, 8), ("a", 5, 1), (None, 6, 4)],  # a replaced row, new rows
        [("b", 2, 0), ("d", 7, 6), ("d", 7, 6)],  # no longer large; a row twice
        [],
    ]
    tables = case_tables.CaseTables(spark, str(tmp_path / "tables"), buckets)
    source, check = str(tmp_path / "in"), str(tmp_path / "check")
    case_tables.create(tables, "rows", spark.createDataFrame([], schema).schema, VIEWS)
    assert tables.read("large").collect() == [] and tables.read("totals").columns == ["case_id", "total", "rows"]
    current = {}
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        untouched = {f: os.stat(f).st_mtime_ns for f in map(str, (tmp_path / "tables" / "totals").rglob("*.parquet"))}
        stream = spark.readStream.schema(schema).parquet(source)
        case_tables.start_refresh(stream, tables, "rows", ["id"], VIEWS, check).awaitTermination()
        current.update({i: (c, i, n) for c, i, n in batch})
        full = spark.createDataFrame(list(current.values()), schema)
        assert sorted(map(str, tables.read("rows").collect())) == sorted(map(str, full.collect()))
        for name, expected in (("totals", VIEWS["totals"](lambda _: full)),):
            assert sorted(map(str, tables.read(name).collect())) == sorted(map(str, expected.collect()))
        if not batch:
            assert untouched == {f: os.stat(f).st_mtime_ns for f in map(str, (tmp_path / "tables" / "totals").rglob("*.parquet"))}
    assert sorted(r.case_id or "" for r in tables.read("large").collect()) == ["", "a", "d"]
    assert [tuple(r) for r in tables.read("totals", case="a").collect()] == [("a", 9, 2)]


def test_one_case_reads_one_bucket(spark, tmp_path):
    tables = case_tables.CaseTables(spark, str(tmp_path), buckets=8)
    tables.replace("t", spark.range(100).select(F.concat(F.lit("c"), F.col("id") % 20).alias("case_id"), "id"))
    one = tables.read("t", case="c7")
    assert sorted(r.id for r in one.collect()) == [7, 27, 47, 67, 87]
    assert {f.split("case_bucket=")[1].split("/")[0] for f in one.inputFiles()} != set()
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "case_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    some = tables.read("t", cases=spark.createDataFrame([("c1",), ("c2",)], "case_id string"))
    assert some.count() == 10


def test_a_batch_of_a_refresh_is_dealt_out(spark, tmp_path, monkeypatch):
    """However large a batch is, its files and with them its tasks stay of one size."""
    monkeypatch.setattr(session, "DEALT_BYTES", 2 << 10)
    events = spark.range(6000).selectExpr(
        "id % 5900 AS event_id", "timestamp_seconds(id % 5900 * 1000) AS ts", "id % 5900 % 7 AS user_id", "'click' AS event_type",
        "rand(1) AS value", "concat('{\"k\": ', id % 5900, '}') AS props",
    )
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    tables = registry.refreshed_tables(spark, str(tmp_path), ["comparison"])
    changes = tables.path("measurements") + "_changes"
    read = spark.read.parquet(changes)
    assert read.select("batch").distinct().count() == 3
    landed = spark.read.parquet(os.path.dirname(tables.root.removeprefix("file://")) + "/events")
    files = landed.groupBy(F.input_file_name().alias("f")).count().collect()
    assert len(files) > 3 * 4 and max(r["count"] for r in files) < 1000
    ids = D.measurements(spark, str(tmp_path)).select("measurement_id").distinct()
    assert tables.read("measurements").select("measurement_id").exceptAll(ids).count() == 0
    assert tables.read("measurements").count() == ids.count() == 5900
