"""The five feeds from JSON lines to current state; what rules count on the way."""

import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sourcetrail.operators import quality
from sourcetrail.operators.observed import BatchCounts, StreamCounts, stream_expect
from sourcetrail.sources import feeds
from sourcetrail.streaming import feed_run, ingest

HASHES = {"input_hash": "a" * 64, "analysis_hash": "b" * 64, "reviewed_hash": "c" * 64}


def land(folder, feed, name, *rows):
    os.makedirs(folder / feed, exist_ok=True)
    text = "\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows)
    (folder / feed / name).write_text(text, encoding="utf-8")


def case(case_id, day, **more):
    return {"case_id": case_id, "review_id": "R1", "data_classification": "SYNTHETIC", "created_at": f"2026-01-0{day}T00:00:00Z", **more}


def test_five_feeds_over_two_runs(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "tables")
    land(landing, "cases", "1.json", case("C1", 1, scenario="a"), case("C2", 1, data_classification="REAL"), case(None, 1), "{broken", "  ")
    land(landing, "classifier_decisions", "1.json",
         {"finding_id": "f", "decided_at": "2026-01-01T00:00:00Z", "priority": "ALTA", "needs_review": True, "is_clear": False, "classifier_response_valid": True},
         {"finding_id": "g", "decided_at": "2026-01-01T00:00:00Z", "priority": "Alta", "needs_review": True, "classifier_response_valid": True})
    land(landing, "review_decisions", "1.json",
         {"review_id": "R", "scope": "review", "action": "signoff", "reviewer_tech_id": "t", "decided_at": "2026-01-01T00:00:00Z"},
         {"review_id": "R", "scope": "finding", "finding_id": "f", "action": "correct", "reviewer_tech_id": "t", "decided_at": "2026-01-01T00:00:00Z"})
    attested = {"review_id": "R", "submitted_at": "2026-01-02T00:00:00Z", "tx_signature": "x", "pda_address": "p", "cluster": "devnet", **HASHES}
    land(landing, "attestations", "1.json", attested, {**attested, "review_id": "S", "cluster": "mainnet"}, {**attested, "review_id": "T", "input_hash": "0x"})
    land(landing, "attestation_verifications", "1.json", {"review_id": "R", "verified_at": "2026-01-02T00:00:00Z", "slot": 7}, {"review_id": "S"})
    land(landing, "elsewhere", "1.json", {"case_id": "X"})
    run = feed_run.FeedRun(spark, str(landing), root)
    run.run()
    # late, newer, repeated and new events; one feed alone
    land(landing, "cases", "2.json", case("C1", 3, scenario="b"), case("C2", 1, data_classification="REAL"), case("C3", 2, manual_review_seconds_baseline="5"))
    run = feed_run.FeedRun(spark, str(landing), root)
    run.run()
    run.run()  # nothing new

    cases = {r.case_id: r for r in run.current("cases").collect()}
    assert set(cases) == {"C1", "C2", "C3"} and cases["C1"].scenario == "b" and cases["C3"].manual_review_seconds_baseline is None
    assert {(r.finding_id, r.priority, r.classifier_response_valid) for r in run.current("classifier_decisions").collect()} == {("f", "alta", True), ("g", "alta", False)}
    assert [(r.scope, r.finding_id) for r in run.current("review_decisions").collect()] == [("REVIEW", "__REVIEW__")]
    assert [r.review_id for r in run.current("attestations").collect()] == ["R"]
    assert [(r.review_id, r.slot) for r in run.current("attestation_verifications").collect()] == [("R", 7)]
    assert sorted(r.broken_rules for r in run.quarantined("cases").collect()) == [["has_keys"], ["has_keys", "has_ts"]]
    assert {(r.review_id, *r.broken_rules) for r in run.quarantined("attestations").collect()} == {("S", "devnet_only"), ("T", "hashes_are_sha256")}
    assert [r.broken_rules for r in run.quarantined("review_decisions").collect()] == [["correction_has_value"]]
    raw = spark.read.parquet(f"{run.path('raw', 'cases')}/batch=*")
    rescued = sorted(json.loads(r._rescued_data).popitem() for r in raw.where("_rescued_data is not null").collect())
    assert rescued == [("_corrupt_record", "{broken"), ("manual_review_seconds_baseline", "5")]
    counts = {(r.source, r.rule): (r.action, r.n_rows, r.n_failed) for r in run.counts().collect()}
    assert counts["cases", "has_keys"] == ("drop", 7, 2) and counts["cases", "declared_synthetic"] == ("warn", 7, 3)
    assert counts["classifier_decisions", "schema_ok"] == ("warn", 2, 1) and not os.path.exists(f"{root}/lines/batch=0")


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    run = feed_run.FeedRun(spark, str(tmp_path / "landing"), str(tmp_path / "tables"))
    lines = spark.createDataFrame([(json.dumps(case("C1", 1)), "file", "cases"), ("{}", "file", "cases")], "value string, _source_file string, feed string")
    run._take(lines, 0)
    run._take(lines, 0)
    assert run.quarantined("cases").count() == 1 and run.counts().where("rule = 'has_ts'").first().n_rows == 2
    assert run.quarantined("attestations").collect() == []


@pytest.mark.parametrize("given,kept", [("5", 5), ('"5"', None), ("5.5", None), ("true", None), ("null", None), ("99999999999", None), ("[5]", None)])
def test_tokens_decide_what_fits(spark, given, kept):
    lines = spark.createDataFrame([(f'{{"n": {given}, "s": {given}, "d": {given}, "b": {given}}}',)], "value string")
    row = feeds.parse_feed(lines, "n INT, s STRING, d DOUBLE, b BOOLEAN").first()
    rescued = json.loads(row._rescued_data or "{}")
    assert row.n == kept and ("n" in rescued) == (kept is None and given != "null")
    assert row.s == (None if given == "null" else given.strip('"'))
    assert row.d == (float(given) if given in ("5", "5.5", "99999999999") else None)
    assert row.b == (True if given == "true" else None) and "s" not in rescued


def test_streams_and_batches_count_alike(spark, tmp_path):
    rules = {"positive": F.col("n") > 0, "named": F.col("k").isNotNull()}
    df = spark.createDataFrame([("a", 1), (None, 2), (None, -3), ("b", None)], "k string, n int")
    source, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    df.write.parquet(source)
    batch = BatchCounts()
    batch.observe(batch.observe(df, "t", rules), "u", {}).write.format("noop").mode("overwrite").save()
    seen = StreamCounts()
    spark.streams.addListener(seen)
    try:
        stream = spark.readStream.schema(df.schema).parquet(source)
        ingest.append_table(stream_expect(stream_expect(stream, "t", rules), "u", {}), out, check).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        expected = {("t", "positive", "warn", 4, 2), ("t", "named", "warn", 4, 2)}
        for counts in (batch, seen):
            rows = counts.table(spark).drop("batch").distinct().collect()
            assert {tuple(r) for r in rows if r.n_rows} == expected
    finally:
        spark.streams.removeListener(seen)
    with pytest.raises(PySparkException, match="expectation failed: positive"):
        quality.expect(df.where("k is not null and n is null"), rules, "fail").count()


def test_landed_lines_and_tables_of_a_run_are_compressed(spark):
    from sourcetrail.plans import registry

    run = registry.feed_run_of(spark, "/root/testdata/sf0.001", ["cases"])
    run.ingest("*.txt.snappy")
    root = run.root.removeprefix("file://")
    landed = [n for n in os.listdir(f"{root}/landing/cases") if n.startswith("part-")]
    assert landed and all(n.endswith(".txt.snappy") for n in landed)
    tables = [n for table in ("raw", "checked") for _, _, names in os.walk(f"{root}/{table}/cases") for n in names if n.endswith(".parquet")]
    assert tables and all(n.endswith(".zstd.parquet") for n in tables)
    seen = {r.rule: r.n_rows for r in run.counts().collect()}
    assert set(seen.values()) == {spark.read.text(f"{run.landing}/cases").count()}
