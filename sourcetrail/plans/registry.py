"""One entry per operator: what runs on the benchmark tables, always over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sourcetrail import contract as K
from sourcetrail import session
from sourcetrail.functions import text as X
from sourcetrail.operators import (
    cdc,
    classify,
    evaluate,
    evidence,
    extract,
    findings,
    integrity,
    ledger,
    observed,
    policy,
    quality,
    queue,
    scans,
)
from sourcetrail.plans import driver_feeds as D
from sourcetrail.plans import serve
from sourcetrail.plans.review_tables import case_tables as laid_out
from sourcetrail.plans.review_tables import kept
from sourcetrail.session import adapt, materialize, run_folder, spread
from sourcetrail.sources import feeds
from sourcetrail.streaming import case_tables, feed_run, latest_state

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(run: Query) -> Query:
    def adapted(spark: SparkSession, folder: str) -> DataFrame:
        return run(adapt(spark), folder)

    REGISTRY[run.__name__] = adapted
    return run


def listed(column: str) -> Column:
    return F.array_join(column, ",").alias(column)


def pointers(column: str = "evidence") -> Column:
    return F.array_join(F.sort_array(F.transform(column, findings.pointer)), ",").alias(column)


# --- evidence ----------------------------------------------------------------------------------------


@query
def timeline(spark, folder):
    return evidence.timeline(D.measurements(spark, folder))


@query
def temporal_comparison(spark, folder):
    return evidence.temporal_comparison(evidence.per_date(D.measurements(spark, folder)))


def conflict_groups(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Conflicts, and their evidence."""
    measured = D.measurements(spark, folder)
    groups = evidence.conflicts(evidence.per_date(measured))
    return groups, evidence.evidence_of(groups, evidence.GROUP, F.array("exam_date"), measured)


@query
def conflicts(spark, folder):
    groups, entries = conflict_groups(spark, folder)
    entries = materialize(entries, "conflict-evidence")
    stated = lambda: F.concat_ws("/", "value_raw", F.coalesce("unit", F.lit("")), "document_id", "page_num")
    versions = evidence.joined_versions(entries, evidence.GROUP, stated, ",")
    pointed = findings.joined_pointers(entries, evidence.GROUP)
    return groups.withColumn("chunk_no", F.lit(0)).join(versions, evidence.GROUP).join(pointed, evidence.GROUP)


@query
def conflict_evidence(spark, folder):
    return conflict_groups(spark, folder)[1]


@query
def comparison_evidence(spark, folder):
    measured = D.measurements(spark, folder)
    compared = evidence.temporal_comparison(evidence.per_date(measured))
    return evidence.comparison_evidence(compared, measured)


@query
def measurement_gaps(spark, folder):
    return evidence.measurement_gaps(D.measurements(spark, folder)).withColumn("evidence", pointers())


@query
def document_gaps(spark, folder):
    documents = D.text_documents(spark, folder)
    pages = extract.document_pages(
        documents,
        F.split("text", "\n", -1),
        error=F.when(F.col("n_chars") < 100, F.lit("too short")),
        marker="ment",
        mask=None,
    )
    return evidence.document_gaps(pages).withColumn("evidence", pointers())


@query
def out_of_range(spark, folder):
    found = findings.with_finding_ids(findings.range_findings(D.measurements(spark, folder)))
    return found.select("finding_id", *findings.KEY, "summary", pointers())


@query
def findings_all(spark, folder):
    found = D.written_findings(spark, folder)
    rows = findings.with_pointers(found.heads, found.sources).withColumn("chunk_no", F.lit(0))
    return rows.select("finding_id", "review_id", *findings.KEY, "summary", "n_evidence", "chunk_no", "evidence")


@query
def finding_evidence(spark, folder):
    return D.written_findings(spark, folder).sources.select("finding_id", *K.EVIDENCE_FIELDS)


# --- change data capture and quality -----------------------------------------------------------------


@query
def latest_state_events(spark, folder):
    return cdc.latest_by(D.table(spark, folder, "events"), ["user_id", "event_type"], "ts")


@query
def latest_state_conversations(spark, folder):
    return cdc.latest_by(D.table(spark, folder, "conversations"), ["conv_id", "role"], "turn")


@query
def latest_state_stream(spark, folder):
    keys, sequence_by = ["user_id", "event_type"], "ts"
    schema = D.table(spark, folder, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{folder}/event[s].parquet")
    root = run_folder(spark, "latest-state")
    latest_state.start_latest_state(stream, keys, sequence_by, f"{root}/state", f"{root}/checkpoint").awaitTermination()
    return latest_state.read_latest_state(spark, f"{root}/state", schema, keys, sequence_by)


@query
def latest_state_many_batches(spark, folder):
    """Fifty batches, most of whose events come late or change keys again; a few merged runs are left."""
    keys, sequence_by = ["user_id", "event_type"], "ts"
    events = D.table(spark, folder, "events")
    root = run_folder(spark, "latest-state")
    events.repartition(50, "event_id").write.parquet(f"{root}/events")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/events")
    latest_state.start_latest_state(stream, keys, sequence_by, f"{root}/state", f"{root}/checkpoint").awaitTermination()
    return latest_state.read_latest_state(spark, f"{root}/state", events.schema, keys, sequence_by)


CASE_VIEWS = {
    "timeline": lambda read: evidence.timeline(read("measurements")),
    "comparison": lambda read: evidence.temporal_comparison(evidence.per_date(read("measurements"))),
    "gaps": lambda read: D.gaps(read("measurements")),
}


def refreshed_tables(spark, folder, names: list[str], batches: int = 3) -> case_tables.CaseTables:
    """Tables by case, filled by a stream of events in several batches that all touch most cases."""
    views = {name: CASE_VIEWS[name] for name in names}
    events = D.table(spark, folder, "events")
    root = run_folder(spark, "case-tables")
    # a batch is several files of a bounded size, so that the tasks of a batch grow in number and not in length
    files = session.dealt_parts(events, batches)
    events.repartition(batches * files, "event_id").write.parquet(f"{root}/events")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/events")
    measured = D.measurements_of(stream)
    tables = case_tables.CaseTables(spark, f"{root}/tables", buckets=16)
    case_tables.create(tables, "measurements", measured.schema, views)
    case_tables.start_refresh(measured, tables, "measurements", ["case_id", "measurement_id"], views, f"{root}/checkpoint").awaitTermination()
    return tables


@query
def refreshed_timeline(spark, folder):
    return refreshed_tables(spark, folder, ["timeline"]).read("timeline").select(*timeline(spark, folder).columns)


@query
def refreshed_comparison(spark, folder):
    return refreshed_tables(spark, folder, ["comparison"]).read("comparison").select(*temporal_comparison(spark, folder).columns)


def reviewer_events(spark, folder) -> DataFrame:
    """Raw reviewer events in mixed case, some of them incomplete."""
    kind = F.col("event_type")
    return D.table(spark, folder, "events").select(
        D.review_of(F.col("user_id")).alias("review_id"),
        F.when(kind == "signup", "Review").when(kind == "error", "page").otherwise("finding").alias("scope"),
        F.when(F.col("value") > 5, F.concat(F.lit("f"), F.get_json_object("props", "$.k"))).alias("finding_id"),
        F.when(kind == "signup", "signoff").when(kind == "view", "correct").otherwise("Confirm").alias("action"),
        F.when(F.col("value") > 50, F.col("value")).alias("corrected_value"),
        F.lit(None).cast("string").alias("corrected_unit"),
        F.lit("reviewer-1").alias("reviewer_tech_id"),
        F.col("ts").alias("decided_at"),
    )


@query
def review_decisions_latest(spark, folder):
    normal = cdc.normalize_review_decisions(reviewer_events(spark, folder))
    kept = quality.expect(normal, quality.review_decision_rules(), "drop")
    return cdc.latest_by(kept, ["review_id", "finding_id"], "decided_at")


@query
def review_decision_expectations(spark, folder):
    normal = cdc.normalize_review_decisions(reviewer_events(spark, folder))
    return quality.expectation_report(normal, quality.review_decision_rules())


@query
def expectation_report(spark, folder):
    return quality.expectation_report(
        D.table(spark, folder, "lineitem"),
        {
            "positive_quantity": "l_quantity > 0",
            "small_discount": F.col("l_discount") <= 0.05,
            "returned_is_closed": "l_returnflag <> 'R' OR l_linestatus = 'F'",
        },
    )


@query
def expect_or_fail(spark, folder):
    orders = D.table(spark, folder, "orders")
    kept = quality.expect(orders, {"known_status": F.col("o_orderstatus").isin("F", "O", "P")}, "fail")
    return kept.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"))


@query
def aborted_runs(spark, folder):
    """Runs that end at the first row that breaks a rule, beside one that passes."""
    watched = {
        "orders": {"known_status": F.col("o_orderstatus").isin("F", "O", "P")},
        "lineitem": {"small_discount": F.col("l_discount") <= 0.05},
        "documents": {"has_words": F.col("n_chars") > 0},
        "events": {"few_seconds": F.col("value") < 50},
    }
    outcomes = [(name, observed.fail_outcome(D.table(spark, folder, name), rules)) for name, rules in watched.items()]
    return spark.createDataFrame(outcomes, "source string, outcome string")


@query
def contract_validation(spark, folder):
    """Case registrations taken from pages: their address gives the ids."""
    records = D.table(spark, folder, "pages").select(
        "page_id",
        F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("case_id"),
        F.regexp_extract("url", r"^https?://[^/]+/(.*)$", 1).alias("review_id"),
        F.when(F.length("html") % 2 == 0, "SYNTHETIC").otherwise("REAL").alias("data_classification"),
        F.regexp_extract("url", r"\.com/([a-z]*)", 1).alias("scenario"),
        (F.length("html") - 2000).alias("manual_review_seconds_baseline"),
    )
    checked = quality.validate(records, quality.case_contract())
    return checked.select("page_id", "case_id", listed("violations"))


@query
def decision_contract(spark, folder):
    """Reviewer actions as they come in, with the rules of the contract that each breaks."""
    k = F.get_json_object("props", "$.k").cast("int")
    records = D.table(spark, folder, "events").select(
        "event_id",
        F.when(k % 29 == 0, "../R").otherwise(D.review_of(F.col("user_id"))).alias("review_id"),
        F.when(k % 3 == 0, "REVIEW").when(k % 31 == 0, "PAGE").otherwise("FINDING").alias("scope"),
        F.when(k % 4 != 0, F.concat(F.lit("f"), k.cast("string"))).alias("finding_id"),
        F.element_at(F.array(*map(F.lit, ("CONFIRM", "CORRECT", "REJECT", "SIGNOFF", "HOLD"))), k % 5 + 1).alias("action"),
        F.when(F.col("value") > 20, F.col("value")).alias("corrected_value"),
        F.when(k % 7 == 0, "mg/dL").when(k % 7 == 1, "free text").alias("corrected_unit"),
        F.when(k % 37 != 0, "reviewer-1").otherwise("").alias("reviewer_tech_id"),
    )
    return quality.validate(records, quality.review_decision_contract()).select("event_id", listed("violations"))


@query
def attestation_contract(spark, folder):
    """Receipts as they come in, with the rules of the contract that each breaks."""
    k, key = F.get_json_object("props", "$.k").cast("int"), F.translate(F.sha2(F.col("event_id").cast("string"), 256), "0", "z")
    digest = F.sha2(F.col("event_id").cast("string"), 256)
    records = D.table(spark, folder, "events").select(
        "event_id", D.review_of(F.col("user_id")).alias("review_id"),
        F.when(k % 11 == 0, "mainnet").otherwise("devnet").alias("cluster"),
        F.when(k % 13 == 0, F.lit("0" * 40)).otherwise(F.substring(key, 1, 40)).alias("program_id"),
        F.when(k % 17 == 0, F.substring(key, 1, 20)).otherwise(F.substring(key, 1, 32)).alias("pda_address"),
        F.when(k % 19 == 0, F.substring(key, 1, 63)).otherwise(key).alias("tx_signature"),
        F.when(k % 23 == 0, F.upper(digest)).otherwise(digest).alias("input_hash"), digest.alias("analysis_hash"),
        F.when(k % 29 != 0, digest).alias("reviewed_hash"), F.lit(D.WORKFLOW).alias("workflow_version"),
        F.when(k % 7 == 0, F.lit("x" * 33)).otherwise("extract+m1").alias("model_version"),
        F.when(k % 5 == 0, "ATTESTED").otherwise("SUBMITTED").alias("status"), F.lit("reviewer-1").alias("reviewer_tech_id"),
    )
    return quality.validate(records, quality.attestation_contract()).select("event_id", listed("violations"))


@query
def upload_gate(spark, folder):
    documents = D.table(spark, folder, "documents")
    uploads = documents.select(
        "doc_id",
        F.octet_length("text").cast("long").alias("size_bytes"),
        X.declares(F.col("text"), "tion").alias("declared"),
        F.col("lang"),
    )
    known = D.table(spark, folder, "labels").select("doc_id")
    gated = quality.upload_gate(uploads, known, ["doc_id"], magic_ok=F.col("lang") != "de", max_bytes=8000)
    return gated.select("doc_id", "size_bytes", "outcome")


# --- feeds -------------------------------------------------------------------------------------------


@query
def rescued_feed(spark, folder):
    """Events as JSON lines: some with an unknown field, some with a text or a number in quotes for a number."""
    events = D.table(spark, folder, "events")
    number = F.col("value").cast("string")
    value = F.when(F.col("event_type") == "error", '"n/a"').when(F.col("event_type") == "click", F.concat(F.lit('"'), number, F.lit('"')))
    extra = F.when(F.col("event_type") == "view", F.lit("x"))
    line = F.to_json(F.struct(F.col("event_id"), F.col("user_id"), F.col("event_type"), extra.alias("extra")))
    line = F.concat(F.substr(line, F.lit(1), F.length(line) - 1), F.lit(',"value":'), value.otherwise(number), F.lit("}"))
    broken = F.when(F.col("event_type") == "signup", F.concat(F.lit("#"), line)).otherwise(line)
    lines = events.select(broken.alias("value"), F.col("event_id").alias("source_id"))
    return feeds.parse_feed(lines, "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE")


def feed_run_of(spark, folder, names: list[str]) -> feed_run.FeedRun:
    """The named feeds, landed as JSON lines.  Compressed files cannot be split, so each holds a bounded number of lines."""
    root = run_folder(spark, "feeds")
    for name in names:
        lines = D.feed_lines(spark, folder, name)
        lines.write.option("compression", "snappy").option("maxRecordsPerFile", 100_000).text(f"{root}/landing/{name}")
    return feed_run.FeedRun(spark, f"{root}/landing", root)


def current_feed(spark, folder, name: str) -> DataFrame:
    run = feed_run_of(spark, folder, [name])
    run.ingest("*.txt.snappy")
    run.update(name)
    return run.current(name)


@query
def feed_cases(spark, folder):
    return current_feed(spark, folder, "cases")


@query
def feed_classifier_decisions(spark, folder):
    return current_feed(spark, folder, "classifier_decisions")


@query
def feed_review_decisions(spark, folder):
    return current_feed(spark, folder, "review_decisions")


@query
def feed_attestations(spark, folder):
    return current_feed(spark, folder, "attestations")


@query
def feed_attestation_verifications(spark, folder):
    return current_feed(spark, folder, "attestation_verifications")


@query
def feed_expectations(spark, folder):
    """Rows seen and failed for every rule and warning of all feeds, counted while they were taken in."""
    run = feed_run_of(spark, folder, list(feed_run.review_feeds()))
    run.ingest("*.txt.snappy")
    return run.counts()


@query
def feed_quarantine(spark, folder):
    """How many rows of each feed were kept out, by the rules they break."""
    run = feed_run_of(spark, folder, list(feed_run.review_feeds()))
    run.ingest("*.txt.snappy")
    kept_out = None
    for name in run.feeds:
        rows = run.quarantined(name).select(F.lit(name).alias("feed"), listed("broken_rules"))
        kept_out = rows if kept_out is None else kept_out.union(rows)
    return kept_out.groupBy("feed", "broken_rules").agg(F.count("*").alias("n_rows"))


@query
def table_export(spark, folder):
    joined = D.table(spark, folder, "region").join(
        D.table(spark, folder, "nation"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    padded = joined.select("r_name", "n_nationkey", "n_name", F.lit(None).cast("string").alias("note"))
    return feeds.export_json(padded, ["n_nationkey"])


@query
def unseen_contents(spark, folder):
    documents = D.table(spark, folder, "documents").select(F.sha2("text", 256).alias("content_hash"), "doc_id")
    labelled = D.table(spark, folder, "labels").join(documents, "doc_id")
    return feeds.unseen(documents, labelled).select("content_hash")


# --- text --------------------------------------------------------------------------------------------


@query
def line_offsets(spark, folder):
    lines = extract.page_lines(D.texts(spark, folder).select("doc_id", "text"), "text")
    return lines.select("doc_id", "line_no", "char_start", "char_end", F.md5("line").alias("line_md5"))


@query
def mask_identifiers(spark, folder):
    patterns = {**K.INLINE_IDENTIFIERS, "us_phone": D.US_PHONE}
    documents = D.texts(spark, folder)
    masked = documents.select(
        "doc_id",
        F.length("text").alias("n_before"),
        X.fixed(X.mask_identifiers(F.col("text"), None, patterns)).alias("masked"),
    )
    same = quality.expect(masked, {"length_kept": F.length("masked") == F.col("n_before")}, "fail")
    return same.select("doc_id", F.md5("masked").alias("masked_md5"))


@query
def mask_labelled_identifiers(spark, folder):
    """Chat turns behind an identifier label, or behind a label that is none."""
    label = F.when(F.col("role") == "user", "  Médico solicitante : ").otherwise("Observação: ")
    turns = D.table(spark, folder, "conversations").select(
        "conv_id", "turn", F.concat(F.lit("Data\n"), label, F.col("text")).alias("text")
    )
    return turns.select("conv_id", "turn", F.md5(X.mask_identifiers(F.col("text"), inline={})).alias("masked_md5"))


@query
def declaration_gate(spark, folder):
    pages = extract.document_pages(D.text_documents(spark, folder), F.split("text", "\n", -1), marker="tion", mask=None)
    return pages.select(
        "case_id", "document_id", "page_num", "synthetic_declared", "is_textual", F.md5("page_text").alias("page_md5")
    )


@query
def declared_documents(spark, folder):
    pages = D.table(spark, folder, "conversations").select("conv_id", "text")
    return extract.declared_documents(pages, ["conv_id"], "text", "tion")


@query
def test_codes(spark, folder):
    names = D.table(spark, folder, "part").select("p_partkey", F.concat("p_name", F.lit("  Á "), "p_type").alias("name"))
    code, known = extract.test_code_of(F.col("name"), {**K.TEST_SYNONYMS, "red widget a economy": "RWE"})
    return names.select("p_partkey", code.alias("test_code"), known.alias("test_known"))


@query
def extract_measurements(spark, folder):
    documents = D.result_pages(spark, folder)
    pages = extract.document_pages(documents, F.array("text"))
    return extract.extract_measurements(pages).drop("processed_at")


@query
def evidence_check(spark, folder):
    """Per case: how many measurements were extracted, and how many do not lead back to their text."""
    documents = D.result_pages(spark, folder)
    pages = materialize(extract.document_pages(documents, F.array("text")), "pages")
    measured = materialize(extract.extract_measurements(pages), "extracted")
    bad = extract.misplaced_evidence(measured, pages).select("case_id", F.lit(1).alias("misplaced"))
    every = measured.select("case_id", F.lit(0).alias("misplaced"))
    # each misplaced row appears in both branches
    return every.unionByName(bad).groupBy("case_id").agg(
        F.count_if(F.col("misplaced") == 0).alias("n_measurements"), F.sum("misplaced").alias("n_misplaced")
    )


@query
def misplaced_evidence(spark, folder):
    """Measurements of which some state another place than the one they came from, and those that are found out."""
    pages = materialize(extract.document_pages(D.result_pages(spark, folder), F.array("text")), "pages")
    measured = extract.extract_measurements(pages)
    event = F.substring("document_id", 2, 20).cast("long")
    moved = measured.withColumns(
        {"char_start": F.col("char_start") + F.when(event % 5 == 0, 1).otherwise(0), "page_num": F.when(event % 7 == 0, 2).otherwise(F.col("page_num"))}
    )
    return extract.misplaced_evidence(moved, pages).select("document_id", "page_num", "char_start", "source_text")


@query
def test_codes_from_table(spark, folder):
    """Names coded by a dictionary table: the parts' own names, folded, as many as there are."""
    names = D.table(spark, folder, "part").select("p_partkey", F.concat("p_name", F.lit("  Á "), "p_type").alias("name"))
    table = D.table(spark, folder, "part").where("p_partkey % 3 > 0").select(
        F.upper(F.concat("p_name", F.lit(" a "), "p_type")).alias("name"), F.concat(F.lit("T"), "p_size").alias("test_code")
    )
    return extract.with_test_codes(names, table, "name").select("p_partkey", "test_code", "test_known")


# --- review ------------------------------------------------------------------------------------------


def with_queue(spark, folder) -> SimpleNamespace:
    """The tables of a review up to its queue."""
    r = D.written_findings(spark, folder)
    r.cases = D.cases(spark, folder)
    r.reviewed = D.review_decisions(r.heads, r.cases)
    build = lambda: {"queue": queue.review_queue(r.heads, D.classifier_decisions(r.heads), r.reviewed)}
    (r.queue,) = kept(spark, folder, build, "queue")
    return r


def with_payload(spark, folder) -> SimpleNamespace:
    r = with_queue(spark, folder)

    def build() -> dict[str, DataFrame]:
        documents = D.case_documents(spark, folder)
        return {"payload": integrity.attestation_payload(r.cases, documents, r.queue, r.measured, r.reviewed)}

    (r.payload,) = kept(spark, folder, build, "payload")
    return r


def with_status(spark, folder) -> SimpleNamespace:
    r = with_payload(spark, folder)
    build = lambda: {"status": integrity.review_status(r.cases, r.payload, *D.receipts(spark, folder, r.payload))}
    (r.status,) = kept(spark, folder, build, "status")
    return r


def outcomes_of(r: SimpleNamespace) -> DataFrame:
    return evaluate.expected_vs_found(D.expected_list(r.measured), r.sources, r.heads)


@query
def review_queue(spark, folder):
    return with_queue(spark, folder).queue.drop("summary", "n_evidence").withColumns(
        {"review_reasons": listed("review_reasons"), "safety_flags": listed("safety_flags")}
    )


@query
def classify_findings(spark, folder):
    return D.classifier_decisions(D.written_findings(spark, folder).heads).select(
        "finding_id", "needs_review", "priority", "is_clear", "classifier_request_hash", "classifier_raw_answers",
        "classifier_response_valid",
    )


@query
def due_for_classification(spark, folder):
    r = with_status(spark, folder)
    return classify.due_for_classification(r.queue, r.status, "questions-v2").select("finding_id", "review_id")


@query
def due_without_answer(spark, folder):
    """Findings of open reviews that the current questions were not answered for."""
    r = with_status(spark, folder)
    return classify.due_for_classification(r.queue, r.status, D.QUESTIONS).select("finding_id", "review_id")


@query
def answer_normalisation(spark, folder):
    """Replies in all shapes the classifier is known to use, read back."""
    k = F.get_json_object("props", "$.k").cast("int")
    words = F.element_at(
        F.array(*[F.lit(w) for w in ("yes", " Sim ", "true", "No", "nao", "NÃO", "false", "talvez", "Média", "alta")]),
        k % 10 + 1,
    )
    quoted = F.concat(F.lit('"'), words, F.lit('"'))
    reply = (
        F.when(F.col("event_type") == "click", F.concat(F.lit('{"output": '), quoted, F.lit("}")))
        .when(F.col("event_type") == "view", F.concat(F.lit('{"output": {"answer": '), quoted, F.lit("}}")))
        .when(F.col("event_type") == "error", F.concat(F.lit('{"output": {"choice": '), quoted, F.lit("}}")))
        .when(F.col("event_type") == "signup", F.concat(F.lit('{"value": '), quoted, F.lit("}")))
        .otherwise(quoted)
    )
    replies = D.table(spark, folder, "events").select("event_id", reply.alias("reply"))
    return replies.select(
        "event_id", classify.yes_no(F.col("reply")).alias("flag"), classify.choice(F.col("reply")).alias("priority")
    )


@query
def document_set(spark, folder):
    return integrity.document_set(D.case_documents(spark, folder))


@query
def attestation_payload(spark, folder):
    return with_payload(spark, folder).payload


@query
def case_trees(spark, folder):
    return integrity.case_trees(D.case_documents(spark, folder), with_queue(spark, folder).queue)


@query
def warning_counts(spark, folder):
    """What the warnings on measurements, findings and payloads count in one run; the rows stay."""
    r = with_payload(spark, folder)
    counts = observed.BatchCounts()
    watched = [
        ("measurements", r.measured, quality.measurement_warnings()),
        ("findings", r.heads, quality.finding_warnings()),
        ("payload", r.payload, quality.payload_warnings()),
    ]
    for source, rows, rules in watched:
        counts.observe(rows, source, rules).write.format("noop").mode("overwrite").save()
    return counts.table(spark).drop("batch")


@query
def review_status(spark, folder):
    return with_status(spark, folder).status


@query
def expected_vs_found(spark, folder):
    return outcomes_of(D.written_findings(spark, folder))


@query
def outcome_histogram(spark, folder):
    return evaluate.outcome_histogram(outcomes_of(D.written_findings(spark, folder)))


@query
def found_ids(spark, folder):
    return evaluate.found_ids(D.written_findings(spark, folder).heads)


@query
def outcome_ids(spark, folder):
    r = D.written_findings(spark, folder)
    return evaluate.outcome_ids(outcomes_of(r), r.heads)


@query
def review_metrics(spark, folder):
    r = with_status(spark, folder)
    pages = r.measured.select("case_id", "document_id", "page_num").distinct()
    return evaluate.review_metrics(r.status, r.cases, pages, r.measured, r.queue, outcomes_of(r))


# --- ledger ------------------------------------------------------------------------------------------


def ledger_accounts(spark, folder) -> DataFrame:
    """A fixed-width record per order, some of them cut short or not there at all."""

    def packed_text(text: Column) -> Column:
        return F.rpad(text, 32, "\0").cast("binary")

    def little_endian(number: Column) -> Column:
        digits = F.lpad(F.hex(number), 16, "0")
        return F.unhex(F.concat(*[F.substring(digits, at, 2) for at in range(15, 0, -2)]))

    key = F.col("o_orderkey").cast("string")
    status = F.length("o_orderpriority").cast("int")
    record = F.concat(
        F.unhex(F.lit("00" * 8)),
        *[F.unhex(F.sha2(F.concat(F.lit(p), key), 256)) for p in ("rev-", "in", "an", "rv")],
        packed_text(F.lit("review-wf-1.0.0")),
        packed_text(F.concat(F.lit("extract+"), F.col("o_orderpriority"))),
        F.unhex(F.lpad(F.hex(status), 2, "0")),
        F.unhex(F.lit("01" * 32)),
        little_endian(F.unix_seconds(F.col("o_orderdate").cast("timestamp"))),
        F.unhex(F.lit("FF")),
    )
    cut = F.when(F.col("o_totalprice") < 20000, F.substring(record, 1, 100)).otherwise(record)
    return spread(D.table(spark, folder, "orders")).select(
        F.concat(F.lit("rev-"), key).alias("review_id"),
        F.concat(F.lit("pda-"), key).alias("pda_address"),
        F.concat(F.lit("tx-"), key).alias("tx_signature"),
        F.when(F.col("o_orderstatus") == "P", "other").otherwise("program").alias("owner"),
        X.fixed(F.when(F.col("o_orderpriority") != "5-LOW", cut)).alias("data"),
        F.lit(7).cast("long").alias("slot"),
        (F.col("o_orderstatus") == "F").alias("tx_confirmed"),
        "o_orderkey",
    )


@query
def decode_records(spark, folder):
    accounts = ledger_accounts(spark, folder)
    return accounts.select("o_orderkey", X.fixed(ledger.decode_record(F.col("data"))).alias("r")).select("o_orderkey", "r.*")


@query
def verify_accounts(spark, folder):
    accounts = ledger_accounts(spark, folder)
    due = accounts.select("review_id", "pda_address", "tx_signature", "tx_confirmed")
    read = ledger.verify(due, accounts, "program", F.lit("2024-01-01").cast("timestamp"))
    return read.drop("verified_at")


@query
def due_for_verification(spark, folder):
    accounts = ledger_accounts(spark, folder)
    read = ledger.verify(
        accounts.select("review_id", "pda_address", "tx_signature", "tx_confirmed"), accounts, "program"
    )
    return ledger.due_for_verification(accounts, read)


@query
def test_cluster_hosts(spark, folder):
    url = F.replace("url", F.lit("example"), F.when(F.col("page_id") % 2 == 0, "api.DEVNET").otherwise("mainnet"))
    return D.table(spark, folder, "pages").select("page_id", ledger.on_test_cluster(url).alias("accepted"))


# --- policy and scans --------------------------------------------------------------------------------


@query
def policy_masked_findings(spark, folder):
    found = findings.with_finding_ids(findings.range_findings(D.measurements(spark, folder)))
    seen = policy.apply_policy(found, set())
    return seen.select("finding_id", F.inline("evidence"))


@query
def policy_restricted_documents(spark, folder):
    """What a viewer without any group sees."""
    documents = D.table(spark, folder, "documents").select(
        "doc_id", F.col("text").cast("binary").alias("content"), F.col("text").alias("page_text")
    )
    seen = policy.apply_policy(documents, set())
    return seen.select("doc_id", F.col("content").isNull().alias("content_hidden"), "page_text")


@query
def mask_functions(spark, folder):
    """The masks as SQL functions, for viewers with and without each group."""
    policy.register_mask_functions(spark)
    return spark.sql(
        """SELECT doc_id, mask_document_text(text, array()) AS hidden, md5(mask_document_text(text, array(:texts))) AS shown_md5,
          mask_raw_document(CAST(text AS BINARY), array(:texts)) IS NULL AS raw_hidden,
          md5(mask_raw_document(CAST(text AS BINARY), array(:raw))) AS raw_md5 FROM {documents}""",
        args={"texts": policy.TEXT_READERS, "raw": policy.RAW_READERS},
        documents=D.table(spark, folder, "documents"),
    )


@query
def policy_masked_documents(spark, folder):
    documents = D.table(spark, folder, "documents").select(
        "doc_id", F.col("text").cast("binary").alias("content"), F.col("text").alias("page_text")
    )
    return policy.apply_policy(documents, {policy.RAW_READERS}).select(
        "doc_id", F.md5("content").alias("content_md5"), "page_text"
    )


SECRETS = {
    "signing_key_block": r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----",
    "cloud_access_key": r"\b(?:AKIA|ASIA)[A-Z2-7]{16}\b",
    "web_token": r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    "token_literal": r"token\s*=\s*\"[0-9a-f]{16,}",
}


@query
def secret_scan(spark, folder):
    return scans.secret_scan(D.texts(spark, folder), ["doc_id"], "text", SECRETS)


@query
def secret_scan_notes(spark, folder):
    """Notes of events, many of which hold a key or a token."""
    return scans.secret_scan(D.planted_texts(spark, folder), ["event_id"], "text", SECRETS)


@query
def mask_notes(spark, folder):
    """Notes of events, many of which hold a personal number or a telephone number, with these hidden."""
    return D.planted_texts(spark, folder).select("event_id", X.fixed(X.mask_identifiers(F.col("text"))).alias("masked"))


@query
def claim_scan(spark, folder):
    return scans.claim_scan(
        D.texts(spark, folder), ["doc_id"], "text", claim=r"(?i)tionment|mention|ention ", negation=r" (?:non|un|the) "
    )


@query
def residual_notes(spark, folder):
    """Notes that show an identifier, before and after masking."""
    notes = D.planted_texts(spark, folder).select("text", X.fixed(X.mask_identifiers(F.col("text"))).alias("masked"))
    return scans.residual_identifiers(notes, ["text", "masked"], K.INLINE_IDENTIFIERS)


@query
def residual_identifiers(spark, folder):
    patterns = {"cpf": K.INLINE_IDENTIFIERS["cpf"], "email": K.INLINE_IDENTIFIERS["email"], "us_phone": D.US_PHONE}
    return scans.residual_identifiers(D.texts(spark, folder), ["text"], patterns)


# --- serving -----------------------------------------------------------------------------------------


@query
def serve_case_list(spark, folder):
    return serve.case_list(with_status(spark, folder).status)


@query
def serve_queue(spark, folder):
    shown = serve.case_queue(with_queue(spark, folder).queue)
    return shown.withColumns(
        {"review_reasons": listed("review_reasons"), "safety_flags": listed("safety_flags")}
    )


@query
def serve_sources(spark, folder):
    found = findings.with_finding_ids(findings.range_findings(D.measurements(spark, folder)))
    return serve.finding_sources(findings.sources_of(found))


@query
def serve_pages(spark, folder):
    pages = extract.document_pages(D.text_documents(spark, folder), F.split("text", "\n", -1), marker="tion", mask=None)
    return serve.page_text(pages)


@query
def serve_timeline(spark, folder):
    return serve.case_timeline(timeline(spark, folder))


@query
def serve_comparison(spark, folder):
    return serve.case_comparison(temporal_comparison(spark, folder))


@query
def serve_payload(spark, folder):
    return serve.review_payload(with_payload(spark, folder).payload)


@query
def serve_metrics(spark, folder):
    return serve.metrics_list(review_metrics(spark, folder))


# --- one case: tables laid out by the key a portal asks with, the value bound as a parameter -------------


def asked(df: DataFrame, key: str) -> str:
    """The value these queries ask for: the smallest there is."""
    return df.agg(F.min(key)).first()[0]


def portal(spark, folder, key: str, name: str, rows: Callable[[], DataFrame], show: Callable[..., DataFrame]) -> DataFrame:
    tables = laid_out(spark, folder, key, {name: rows})
    value = asked(tables.read(name), key)
    return show(tables.read(name, case=value), **{key: value})


@query
def portal_queue(spark, folder):
    shown = portal(spark, folder, "case_id", "queue", lambda: with_queue(spark, folder).queue, serve.case_queue)
    return shown.withColumns({"review_reasons": listed("review_reasons"), "safety_flags": listed("safety_flags")})


@query
def portal_timeline(spark, folder):
    return portal(spark, folder, "case_id", "timeline", lambda: timeline(spark, folder), serve.case_timeline)


@query
def portal_comparison(spark, folder):
    return portal(spark, folder, "case_id", "comparison", lambda: temporal_comparison(spark, folder), serve.case_comparison)


@query
def portal_sources(spark, folder):
    return portal(spark, folder, "finding_id", "sources", lambda: D.written_findings(spark, folder).sources, serve.finding_sources)


@query
def portal_payload(spark, folder):
    return portal(spark, folder, "review_id", "payload", lambda: with_payload(spark, folder).payload, serve.review_payload)


@query
def portal_pages(spark, folder):
    def pages() -> DataFrame:
        documents = D.text_documents(spark, folder)
        return extract.document_pages(documents, F.split("text", "\n", -1), marker="tion", mask=None)

    return portal(spark, folder, "document_id", "pages", pages, serve.page_text)
