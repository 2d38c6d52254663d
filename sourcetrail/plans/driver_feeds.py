"""Feeds derived from the benchmark tables, so the operators run on tables of any size.

``events`` plays the measurements (a user is a case, an event type is a test), ``documents`` the page
texts, ``orders`` the transaction receipts.  All of it is plain projection of whole tables."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sourcetrail import contract as K
from sourcetrail.functions import text as X
from sourcetrail.operators import classify, evidence, findings
from sourcetrail.plans.review_tables import kept
from sourcetrail.session import dealt, spread

MODEL = "stand-in"
QUESTIONS = "questions-v1"
WORKFLOW = "review-wf-1.0.0"
# a phone form the benchmark texts use
US_PHONE = r"(?:\+1 )?\(\d{3}\) \d{3}-\d{4}"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    """A table of long texts, spread over the cores where it has few splits."""
    return spread(table(spark, folder, name))


def case_of(user: Column) -> Column:
    return F.concat(F.lit("C"), user.cast("string"))


def review_of(user: Column) -> Column:
    return F.concat(F.lit("R"), user.cast("string"))


def measurements(spark: SparkSession, folder: str) -> DataFrame:
    return measurements_of(dealt(table(spark, folder, "events")))


def measurements_of(events: DataFrame) -> DataFrame:
    """A measurement per event; also on a stream of events."""
    events = events.select(
        "event_id", "ts", "user_id", "event_type", "value",
        X.fixed(F.get_json_object("props", "$.k").cast("int")).alias("k"),
    )
    k, event = F.col("k"), F.col("event_id")
    status = (
        F.when(k % 23 == 0, "ILLEGIBLE").when(k % 23 == 1, "MISSING").when(k % 23 == 2, "AMBIGUOUS").otherwise("OK")
    )
    raw = (
        F.when(k % 23 == 0, "ilegível")
        .when(k % 23 == 1, "N/D")
        .when(k % 23 == 2, "aprox.")
        .otherwise(F.replace(F.col("value").cast("string"), F.lit("."), F.lit(",")))
    )
    unit = F.when(k % 11 == 0, None).when(k % 5 == 0, "s").when(k % 2 == 0, "ms").otherwise("MS")
    stated_range = k % 13 != 0
    base = events.select(
        case_of(F.col("user_id")).alias("case_id"),
        F.concat(F.lit("D"), F.floor(event / 25).cast("string")).alias("document_id"),
        (F.floor(event / 5) % 5 + 1).cast("int").alias("page_num"),
        (event % 5 + 1).cast("int").alias("line_no"),
        (event % 5 * 40).cast("int").alias("char_start"),
        F.concat_ws(": ", "event_type", raw).alias("source_text"),
        F.when(k % 17 != 0, F.to_date("ts")).alias("exam_date"),
        F.concat(F.lit("Exame "), "event_type").alias("test_name_raw"),
        F.col("event_type").alias("test_code"),
        (F.col("event_type") != "error").alias("test_known"),
        raw.alias("value_raw"),
        F.when(status == "OK", F.col("value")).alias("value"),
        status.alias("value_status"),
        unit.alias("unit"),
        F.when(stated_range, F.lit(1.0)).alias("ref_low"),
        F.when(stated_range, F.lit(100.0)).alias("ref_high"),
        F.lit(K.EXTRACTOR_VERSION).alias("extractor_version"),
        F.col("ts").alias("ingested_at"),
        F.timestamp_add("SECOND", k, F.col("ts")).alias("processed_at"),
    )
    return base.withColumns(
        {
            "char_end": F.col("char_start") + F.length("source_text"),
            "date_source_text": F.date_format("exam_date", "dd/MM/yyyy"),
            "measurement_id": F.sha2(F.concat_ws("|", "document_id", "page_num", "char_start"), 256),
        }
    )


def cases(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "events")
        .groupBy("user_id")
        .agg(F.min("ts").alias("created_at"), F.max("ts").alias("last_seen"))
        .select(
            case_of(F.col("user_id")).alias("case_id"),
            review_of(F.col("user_id")).alias("review_id"),
            F.lit("benchmark").alias("scenario"),
            "created_at",
            F.lit(600).alias("manual_review_seconds_baseline"),
            "last_seen",
            "user_id",
        )
    )


def case_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One received document per event; equal contents repeat within a case."""
    return table(spark, folder, "events").select(
        case_of(F.col("user_id")).alias("case_id"),
        F.sha2(F.concat_ws("|", "event_type", F.get_json_object("props", "$.k")), 256).alias("input_hash"),
    )


def text_documents(spark: SparkSession, folder: str) -> DataFrame:
    return texts(spark, folder).select(
        F.col("source").alias("case_id"),
        F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("document_id"),
        "lang",
        "n_chars",
        "text",
    )


def result_pages(spark: SparkSession, folder: str) -> DataFrame:
    """A page of text per event, laid out like a result sheet."""
    k = F.get_json_object("props", "$.k").cast("int")
    names = F.create_map(
        *[
            F.lit(x)
            for pair in {
                "click": "Creatinina", "view": "Potássio", "purchase": "GLICOSE", "signup": "Ferritina",
                "error": "Paciente",
            }.items()
            for x in pair
        ]
    )
    number = F.replace(F.col("value").cast("string"), F.lit("."), F.lit(","))
    value = F.when(k % 23 == 0, "ilegível").when(k % 23 == 1, "N/D").when(k % 23 == 2, F.concat(F.lit("< "), number))
    result = F.concat(
        names[F.col("event_type")],
        F.lit(": "),
        value.otherwise(number),
        F.when(k % 11 == 0, "").otherwise(" mg/dL"),
        F.when(k % 13 == 0, "").otherwise(" (VR: 1,0 - 100,0)"),
    )
    day = F.when(k % 17 == 0, "31/02/2024").otherwise(F.date_format("ts", "dd/MM/yyyy"))
    text = F.concat(
        F.lit("LAUDO "), F.col("event_id").cast("string"),
        F.lit("\nMédico solicitante: Dr. "), F.col("user_id").cast("string"),
        F.lit("\r\n  Data da coleta: "), day,
        F.lit("\n\n "), result,
        F.lit("\nObservação: sem jejum\nDocumento sintético.\n"),
    )
    return dealt(table(spark, folder, "events")).select(
        case_of(F.col("user_id")).alias("case_id"),
        F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("document_id"),
        F.col("ts").alias("ingested_at"),
        text.alias("text"),
    )


def gaps(measured: DataFrame) -> DataFrame:
    return evidence.measurement_gaps(measured)


def written_measurements(spark: SparkSession, folder: str) -> DataFrame:
    """Measurements as a table: several steps read it, each only the columns it needs."""
    return kept(spark, folder, lambda: {"measurements": measurements(spark, folder)}, "measurements")[0]


def written_findings(spark: SparkSession, folder: str) -> SimpleNamespace:
    """Measurements, finding heads and their sources as tables."""
    measured = written_measurements(spark, folder)

    def build() -> dict[str, DataFrame]:
        found = findings.findings(measured, gaps(measured), cases(spark, folder))
        return {"findings": found.heads, "sources": found.sources}

    heads, sources = kept(spark, folder, build, "findings", "sources")
    return SimpleNamespace(measured=measured, heads=heads, sources=sources)


def classifier_decisions(heads: DataFrame) -> DataFrame:
    """Answers of the stand-in.  Undated findings were not sent yet; findings of one test came back
    without a clarity answer; conflicts on one test were rated low."""
    context = F.col("__text")
    sent = heads.where(F.col("exam_date").isNotNull()).withColumn("__text", classify.context_text())
    replies = classify.stand_in_answers(context)
    replies["is_clear"] = F.when(F.col("test_code") == "error", "talvez").otherwise(replies["is_clear"])
    low = (F.col("test_code") == "view") & (F.col("finding_type") == "CONFLICT")
    replies["priority"] = F.when(low, '{"output": {"choice": "BAIXA"}}').otherwise(replies["priority"])
    replies["needs_review"] = F.when(F.col("finding_type") == "TEMPORAL_VARIATION", '{"output": "não"}').otherwise(
        replies["needs_review"]
    )
    decided_at = F.timestamp_add("HOUR", F.lit(30), F.col("exam_date").cast("timestamp"))
    return classify.decision_records(sent, replies, MODEL, QUESTIONS, WORKFLOW, decided_at)


def review_decisions(heads: DataFrame, known_cases: DataFrame) -> DataFrame:
    """Reviewer actions per finding and the sign-off of reviews opened on the first day."""
    action = (
        F.when(F.col("test_code") == "click", "CONFIRM")
        .when(F.col("test_code") == "view", "CORRECT")
        .when(F.col("test_code") == "signup", "REJECT")
    )
    corrected = action == "CORRECT"
    on_findings = heads.where(action.isNotNull()).select(
        "review_id",
        F.lit("FINDING").alias("scope"),
        "finding_id",
        action.alias("action"),
        F.when(corrected, F.lit(1.5)).alias("corrected_value"),
        F.when(corrected & F.col("exam_date").isNotNull(), F.lit("ms")).alias("corrected_unit"),
        F.lit("reviewer-1").alias("reviewer_tech_id"),
        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("decided_at"),
    )
    signoffs = known_cases.where(F.col("created_at") < F.lit("2024-01-02").cast("timestamp")).select(
        "review_id",
        F.lit("REVIEW").alias("scope"),
        F.lit(K.REVIEW_LEVEL_KEY).alias("finding_id"),
        F.lit("SIGNOFF").alias("action"),
        F.lit(None).cast("double").alias("corrected_value"),
        F.lit(None).cast("string").alias("corrected_unit"),
        F.lit("reviewer-2").alias("reviewer_tech_id"),
        F.timestamp_add("HOUR", F.lit(72), F.col("last_seen")).alias("decided_at"),
    )
    return on_findings.unionByName(signoffs)


def receipts(spark: SparkSession, folder: str, payload: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Attestations of signed reviews and what reading the ledger gave for each of them.

    The order with the user's number decides how the reading went, by its priority."""
    known = cases(spark, folder).select("case_id", "user_id")
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("user_id"), "o_orderpriority")
    signed = (
        payload.where(F.col("signoff_at").isNotNull())
        .join(known, "case_id")
        .join(orders, "user_id", "left")
        .withColumn("o_orderpriority", F.coalesce("o_orderpriority", F.lit("5-LOW")))
        .withColumn("tx_signature", F.concat(F.lit("tx-"), "review_id"))
    )
    attestations = signed.select(
        "review_id",
        F.lit("devnet").alias("cluster"),
        "tx_signature",
        F.concat(F.lit("pda-"), "review_id").alias("pda_address"),
        F.timestamp_add("MINUTE", F.lit(5), F.col("signoff_at")).alias("submitted_at"),
    )
    priority = F.col("o_orderpriority")
    verifications = signed.where(priority != "5-LOW").select(
        "review_id",
        F.when(priority == "4-NOT SPECIFIED", "tx-older").otherwise(F.col("tx_signature")).alias("tx_signature"),
        F.lit(True).alias("account_found"),
        (priority != "3-MEDIUM").alias("tx_confirmed"),
        F.col("input_hash").alias("onchain_input_hash"),
        F.when(priority == "2-HIGH", F.sha2("review_id", 256)).otherwise(F.col("analysis_hash")).alias(
            "onchain_analysis_hash"
        ),
        F.col("reviewed_hash").alias("onchain_reviewed_hash"),
        F.lit("ATTESTED").alias("onchain_status"),
        F.timestamp_add("MINUTE", F.lit(9), F.col("signoff_at")).alias("verified_at"),
        F.lit(7).cast("long").alias("slot"),
        F.lit(None).cast("string").alias("error"),
    )
    return attestations, verifications


def expected_list(measured: DataFrame) -> DataFrame:
    """Keys an annotator would list: a high reading on a day, with the last page it is on."""
    high = (F.col("value") > 90) & F.col("exam_date").isNotNull()
    return (
        measured.where(high)
        .groupBy("case_id", "test_code", "exam_date")
        .agg(F.max("page_num").alias("expected_page"))
        .select(
            "case_id",
            F.lit("OUT_OF_DOCUMENT_RANGE").alias("finding_type"),
            F.lit("ABOVE_DOCUMENT_RANGE").alias("finding_subtype"),
            "test_code",
            "exam_date",
            "expected_page",
        )
    )


def moment(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def feed_lines(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The lines of one feed, one per event: some are cut off, some lack a key, some hold a number in quotes."""
    events = table(spark, folder, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    k, user = F.col("k"), F.col("user_id").cast("string")
    keyed = F.when(k % 31 != 0, moment("ts"))
    review = review_of(F.col("user_id")).alias("review_id")

    def digest(kind: str) -> Column:
        return F.sha2(F.concat(F.lit(kind), user), 256)

    fields = {
        "cases": [
            F.when(k % 31 != 0, case_of(F.col("user_id"))).alias("case_id"), review,
            F.when(k % 7 == 0, "REAL").otherwise("SYNTHETIC").alias("data_classification"),
            F.col("event_type").alias("scenario"), moment("ts").alias("created_at"),
            k.alias("manual_review_seconds_baseline"),
        ],
        "classifier_decisions": [
            F.concat_ws("-", F.lit("f"), user, "event_type").alias("finding_id"), review,
            F.when(k % 13 != 0, F.col("value") > 20).alias("needs_review"),
            F.element_at(F.array(*map(F.lit, ("Alta", "MEDIA", "baixa", "urgente"))), k % 4 + 1).alias("priority"),
            (F.col("value") < 50).alias("is_clear"), F.lit("m1").alias("classifier_model"),
            F.lit("q1").alias("classifier_prompt_version"), digest("request").alias("classifier_request_hash"),
            F.lit("{}").alias("classifier_raw_answers"), F.when(k % 17 != 0, k % 5 != 0).alias("classifier_response_valid"),
            F.lit(WORKFLOW).alias("workflow_version"), keyed.alias("decided_at"),
        ],
        "review_decisions": [
            review, F.when(F.col("event_type") == "signup", "Review").when(F.col("event_type") == "error", "page").otherwise("finding").alias("scope"),
            F.when(F.col("value") > 5, F.concat(F.lit("f"), k.cast("string"))).alias("finding_id"),
            F.when(F.col("event_type") == "signup", "signoff").when(F.col("event_type") == "view", "correct").otherwise("Confirm").alias("action"),
            F.when(F.col("value") > 50, F.col("value")).alias("corrected_value"), F.lit(None).cast("string").alias("corrected_unit"),
            F.lit("reviewer-1").alias("reviewer_tech_id"), keyed.alias("decided_at"),
        ],
        "attestations": [
            review, F.when(k % 11 == 0, "mainnet").otherwise("devnet").alias("cluster"), F.lit("program").alias("program_id"),
            F.concat(F.lit("pda-"), user).alias("pda_address"), F.when(k % 23 != 0, F.concat(F.lit("tx-"), k.cast("string"))).alias("tx_signature"),
            F.when(k % 41 == 0, "0x").otherwise(digest("in")).alias("input_hash"), digest("an").alias("analysis_hash"),
            digest("rv").alias("reviewed_hash"), F.lit(WORKFLOW).alias("workflow_version"), F.lit("m1").alias("model_version"),
            F.lit("SUBMITTED").alias("status"), F.lit("reviewer-1").alias("reviewer_tech_id"), keyed.alias("submitted_at"),
        ],
        "attestation_verifications": [
            review, F.concat(F.lit("pda-"), user).alias("pda_address"), F.concat(F.lit("tx-"), k.cast("string")).alias("tx_signature"),
            (k % 3 == 0).alias("account_found"), (k % 2 == 0).alias("tx_confirmed"), digest("in").alias("onchain_input_hash"), digest("an").alias("onchain_analysis_hash"), digest("rv").alias("onchain_reviewed_hash"),
            F.lit("ATTESTED").alias("onchain_status"), k.cast("long").alias("slot"), F.when(k % 5 == 0, "slow").alias("error"),
            keyed.alias("verified_at"),
        ],
    }
    line = F.to_json(F.struct(*fields[name]))
    for number in ("manual_review_seconds_baseline", "slot"):
        bare = F.concat(F.lit(f'"{number}":'), k.cast("string"))
        quoted = F.concat(F.lit(f'"{number}":"'), k.cast("string"), F.lit('"'))
        line = F.when(k % 19 == 0, F.replace(line, bare, quoted)).otherwise(line)
    return events.select(F.when(F.col("event_id") % 29 == 0, F.concat(F.lit("#"), line)).otherwise(line).alias("value"))


def planted_texts(spark: SparkSession, folder: str) -> DataFrame:
    """A note per event, each with one identifier or secret of a kind that its type decides."""
    number = F.lpad(F.col("event_id").cast("string"), 9, "0")
    digits = F.concat(F.lit("4"), number, F.lit("7"))
    key = F.upper(F.substring(F.translate(F.sha2(number, 256), "0189", "ABCD"), 1, 16))
    text = (
        F.when(F.col("event_type") == "click", F.concat(F.lit("CPF "), F.regexp_replace(digits, r"^(\d{3})(\d{3})(\d{3})(\d{2})$", "$1.$2.$3-$4"), F.lit(" ok")))
        .when(F.col("event_type") == "view", F.concat(F.lit("cns 7"), F.substring(digits, 1, 2), F.lit(" 1234 5678 "), F.substring(number, 6, 4)))
        .when(F.col("event_type") == "purchase", F.concat(F.lit("fone (11) 9"), F.substring(number, 6, 4), F.lit("-4321, id "), key))
        .when(F.col("event_type") == "signup", F.concat(F.lit("-----BEGIN RSA PRIVATE KEY----- "), number))
        .otherwise(F.concat(F.lit("AKIA"), key, F.lit(" eyJ"), key, F.lit(".eyJ"), key, F.lit("."), key))
    )
    return table(spark, folder, "events").select("event_id", "event_type", text.alias("text"))
