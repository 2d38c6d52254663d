"""Rows that are heavy work are dealt out by input bytes; the short ways through a text give what the long ones give."""

from __future__ import annotations

import hashlib
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from sourcetrail import contract as K
from sourcetrail import session
from sourcetrail.functions import text as X
from sourcetrail.operators import classify, digest, findings, queue
from sourcetrail.plans import driver_feeds as D


@pytest.mark.parametrize("rows_of", [D.result_pages, D.measurements])
def test_tasks_are_bounded_by_input_bytes(spark, tmp_path, monkeypatch, rows_of):
    monkeypatch.setattr(session, "DEALT_BYTES", 4 << 10, raising=False)
    monkeypatch.setattr(session, "SPREAD_BYTES", 1 << 10)
    events = spark.range(20_000).selectExpr(
        "id AS event_id", "timestamp_seconds(id) AS ts", "id % 7 AS user_id", "'click' AS event_type",
        "rand(1) AS value", "concat('{\"k\": ', id, '}') AS props",
    )
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    rows = rows_of(spark, str(tmp_path))
    parts = rows.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(parts) > 2 * spark.sparkContext.defaultParallelism
    assert sum(p["count"] for p in parts) == 20_000 and max(p["count"] for p in parts) < 2_000


TEXTS = [
    "Documento sintético.", "DOCUMENTO  SINTETICO", "documento sintetico", "Ｄｏｃｕｍｅｎｔｏ sintético", "docúmento sîntetico",
    "\x01Documento sintético", "documento sintetic", "ďõčümênto šîňtętīço", "ﬁm: documento ſintetico", "", None,
]


def folded(text: str | None) -> str:
    plain = unicodedata.normalize("NFKD", text or "")
    return "".join(c for c in plain if not unicodedata.category(c).startswith("M")).lower()


def test_a_marker_is_seen_however_it_is_written(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    seen = rows.select("i", X.declares(F.col("t")).alias("d"), X.declares(F.col("t"), "Sint").alias("upper")).collect()
    assert {r.i: r.d for r in seen} == {i: K.DECLARATION_MARKER in folded(t) for i, t in enumerate(TEXTS)}
    assert not any(r.upper for r in seen)


def test_a_text_with_the_mark_is_split_like_any_other(spark):
    texts = ["a\r\nb\rc\n\nd", "a\x01b\r\nc\x01", "\x01", "", "CPF: 1\nx\x01 123.456.789-01 e 12345678901", "fone (11) 91234-5678", "7 1234-567"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select("t", X.split_lines(F.col("t")).alias("lines"), X.mask_identifiers(F.col("t")).alias("masked")).collect()
    for r in got:
        assert "".join(r.lines) == r.t
        assert r.lines == [line for line in re.split(r"(?<=[\n\x0b\f])|(?<=\r)(?!\n)", r.t) if line]
    masked = [r.masked for r in got]
    assert masked[4] == "CPF: 1\nx\x01 ***.***.***-** e ***********"
    assert masked[5] == "fone (**) *****-****" and masked[6] == texts[6] and masked[:4] == texts[:4]


def test_tree_digest_sends_bytes_and_is_the_digest_of_the_definition(spark):
    items = [("a", str(i % 700)) for i in range(1500)] + [(None, "ã"), (None, "ã"), ("b", None), ("c", "")]
    rows = spark.createDataFrame(items, "k string, v string")
    for digits in (1, 3, 4):
        tree = digest.tree_digest(rows, ["k"], F.col("v"), digits)
        leaves: dict = {}
        for key, value in items:
            if value is not None:
                h = hashlib.sha256(value.encode()).hexdigest()
                leaves.setdefault(key, {}).setdefault(h[:digits], []).append(h)
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        wanted = {
            key: (sha("".join(leaf + sha("".join(sorted(own[leaf]))) for leaf in sorted(own))), sum(map(len, own.values())))
            for key, own in leaves.items()
        }
        assert {r.k: (r.digest, r.n_items) for r in tree.collect()} == wanted
    plan = tree._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("RepartitionByExpression") == 2  # rows of bytes, no aggregates of text


def test_tasks_behind_an_exchange_are_small(spark):
    session.adapt(spark)
    wide = spark.range(3_000_000).select(F.sha2(F.col("id").cast("string"), 256).alias("h"))
    parts = wide.groupBy("h").agg(F.count("*").alias("n")).groupBy(F.spark_partition_id().alias("p")).count()
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "32m"
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        assert parts.count() > 8  # one task per core before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_one_exchange_of_findings_serves_answers_and_actions(spark):
    heads = spark.createDataFrame(
        [(f, r, "GAP") for f, r in (("f1", "R1"), ("f1", "R2"), ("f2", None), ("f3", "R1"), (None, "R1"))],
        "finding_id string, review_id string, finding_type string",
    )
    answers = spark.createDataFrame(
        [("f1", True, "alta", True, "m", "p", True), ("f3", False, "baixa", True, "m", "p", True)],
        "finding_id string, needs_review boolean, priority string, is_clear boolean, classifier_model string,"
        " classifier_prompt_version string, classifier_response_valid boolean",
    ).withColumn("decided_at", F.lit(None).cast("timestamp"))
    actions = spark.createDataFrame(
        [("R1", "f1", "CONFIRM"), ("R1", "f1", "REJECT"), ("R3", "f3", "CONFIRM"), (None, "f2", "CORRECT")],
        "review_id string, finding_id string, action string",
    ).select("*", F.lit("FINDING").alias("scope"), F.lit(1.0).alias("corrected_value"), F.lit("ms").alias("corrected_unit"),
             F.lit("x").alias("reviewer_tech_id"), F.lit(None).cast("timestamp").alias("decided_at"))
    usual = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = queue.enrich(heads, answers, actions)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        rows = [(r.finding_id, r.review_id, r.has_classifier, r.reviewer_action) for r in joined.collect()]
    finally:
        for k, v in usual.items():
            spark.conf.set(k, v)
    assert plan.count("Exchange hashpartitioning") == 3
    assert sorted(map(str, rows)) == sorted(map(str, [
        ("f1", "R1", True, "CONFIRM"), ("f1", "R1", True, "REJECT"), ("f1", "R2", True, None), ("f2", None, False, None),
        ("f3", "R1", True, None), (None, "R1", False, None),
    ]))


def test_only_texts_with_a_brace_are_parsed_and_all_are_read(spark):
    replies = ["talvez", "sim", ' {"output": "Sim"}', '\t{"output": {"choice": "nao"}}', '{"output": null}', "{sim", "[]", "", None, '"yes"']
    rows = spark.createDataFrame([(t,) for t in replies], "t string").select("t", classify.yes_no(F.col("t")).alias("y"))
    assert [r.y for r in rows.collect()] == [None, True, True, False, None, None, None, None, None, True]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == plan.count("THEN from_json")


def test_the_id_of_one_entry_is_that_of_a_list(spark):
    entry = "struct<document_id string, page_num int, char_start int>"
    lists = [[("D1", 2, 3)], [("D1", None, None)], [(None, None, 3)], [("b", 1, 1), ("a", 1, 1)], [("a", 1, 1)] * 2, [], [None], None]
    rows = spark.createDataFrame([("GAP", "s", "C", None, None, x) for x in lists], f"{', '.join(f'{k} string' for k in findings.KEY)}, evidence array<{entry}>")

    def written(x):
        return ":".join(str(v) for v in (x or (None,) * 3) if v is not None)

    got = [r.finding_id for r in findings.with_finding_ids(rows).collect()]
    expected = [None if x is None else hashlib.sha256(("GAP|s|C|||" + ",".join(sorted(map(written, x)))).encode()).hexdigest() for x in lists]
    assert got == expected
