"""Operators on small frames, against plain Python or hand-made answers."""

import datetime as dt
import hashlib
import itertools

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sourcetrail import contract as K
from sourcetrail.functions import text as X
from sourcetrail.operators import cdc, classify, evaluate, evidence, findings, integrity, ledger, policy, quality, queue, scans
from sourcetrail.operators.digest import ordered_digest
from sourcetrail.plans import serve
from sourcetrail.sources import feeds

STAMP = dt.datetime(2026, 1, 1)


def column(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


# --- text --------------------------------------------------------------------------------------------


def test_lines_and_offsets_agree_with_python(spark):
    texts = ["", "a", "a\n", "a\r\nb\rc\n\n", "x\x0by\x0cz\x1ca\x85b c ", "\r\r\n\n\r", "línea\nç\n" * 300]
    got = column(spark, texts, lambda v: X.line_table(v))
    for text, rows in zip(texts, got):
        lines, at = text.splitlines(keepends=True), 0
        assert [r.line for r in rows] == lines
        for row, line in zip(rows, lines):
            assert (row.start, row.end) == (at, at + len(line))
            at += len(line)


def test_running_fold_sums(spark):
    df = spark.createDataFrame([([i % 7 for i in range(n)],) for n in (0, 1, 63, 64, 65, 500)], "xs array<int>")
    for xs, sums in df.select("xs", X.running_fold(F.col("xs"), F.lit(0), lambda a, b: a + b)).collect():
        assert sums == list(itertools.accumulate(xs))


@pytest.mark.parametrize(
    "line,secret",
    [
        ("Paciente: Maria da Silva", "Maria"),
        ("Nome da mãe : Ana", "Ana"),
        ("RG: 12.345", "345"),
        ("Telefone: (11) 91234-5678", "91234"),
        ("MÉDICO RESPONSÁVEL: Dr. Fulano", "Fulano"),
        ("fone (11) 91234-5678 hoje", "91234"),
        ("cns 700 0000 0000 0000", "700 0000"),
        ("contato ana.b+c@exa-mple.com.br!", "ana"),
        ("doc 123.456.789-09 e 98765432100", "987654"),
    ],
)
def test_identifiers_are_hidden_in_place(spark, line, secret):
    (masked,) = column(spark, ["x\n" + line + "\ny"], X.mask_identifiers)
    assert secret not in masked and len(masked) == len(line) + 4
    assert masked.startswith("x\n") and masked.endswith("\ny")


def test_masking_leaves_other_lines_alone(spark):
    lines = "Hemoglobina: 10,9 g/dL (VR: 12,0 - 16,0)\nData da coleta: 12/03/2026\n"
    assert column(spark, [lines, None], X.mask_identifiers) == [lines, ""]


def test_names_to_codes(spark):
    from sourcetrail.operators.extract import test_code_of as code_of

    names = ["Potássio", "GLICOSE", " Hb", "Proteína  C\tReativa", "Ferritina", "Vit. D (25-OH)"]
    codes = column(spark, names, lambda v: code_of(v, K.TEST_SYNONYMS)[0])
    assert codes == ["K", "GLU", "HGB", "CRP", "UNK_FERRITINA", "UNK_VIT_D_25_OH"]


def test_dates_and_numbers(spark):
    assert column(spark, ["29/02/2024", "31/02/2026", "01/01/0000", ""], X.calendar_date) == [
        dt.date(2024, 2, 29), None, None, None]
    assert column(spark, ["1,5", "7", "x", None], X.decimal_comma) == [1.5, 7.0, None, None]


def measured(spark, *texts):
    pages = [(f"C{i}", f"D{i}", 1, STAMP, t, True, True) for i, t in enumerate(texts)]
    from sourcetrail.operators.extract import extract_measurements

    frame = spark.createDataFrame(
        pages,
        "case_id string, document_id string, page_num int, ingested_at timestamp, page_text string, "
        "is_textual boolean, synthetic_declared boolean",
    )
    return extract_measurements(frame).orderBy("case_id", "line_no").collect()


def test_result_lines(spark):
    rows = measured(
        spark,
        "Potássio: 4,5 (VR: 3,5 - 5,1)\n",
        "Creatinina: 1,0 ou 1,3 mg/dL (VR: 0,6 - 1,2)",
        "Data da coleta: 12/03/2026\n\tUreia: N/D\r\nSódio: ilegível mEq/L (VR: 135 a 145)\nDATA: 31/02/2026\nTSH: 2",
        "Observação: paciente em jejum\nPaciente: 12\nMédico: 3\nLeucócitos: 7 10^3/uL\nFerritina: 7 10^3/uL\nFerritina: 7 ng/mL",
        "Hb: 1\x01 x",
    )
    shown = [(r.case_id, r.line_no, r.test_code, r.value_status, r.value, r.unit, r.ref_low, r.ref_high) for r in rows]
    assert shown == [
        ("C0", 1, "K", "OK", 4.5, None, 3.5, 5.1),
        ("C1", 1, "CREA", "AMBIGUOUS", None, None, None, None),
        ("C2", 2, "UREA", "MISSING", None, None, None, None),
        ("C2", 3, "NA", "ILLEGIBLE", None, "mEq/L", 135.0, 145.0),
        ("C2", 5, "TSH", "OK", 2.0, None, None, None),
        ("C3", 4, "WBC", "AMBIGUOUS", None, None, None, None),
        ("C3", 6, "UNK_FERRITINA", "OK", 7.0, "ng/mL", None, None),
        ("C4", 1, "HGB", "AMBIGUOUS", None, None, None, None),
    ]
    dates = [(r.exam_date, r.date_source_text) for r in rows[2:5]]
    good = (dt.date(2026, 3, 12), "Data da coleta: 12/03/2026")
    assert dates == [good, good, (None, "DATA: 31/02/2026")]
    assert rows[2].char_start == len("Data da coleta: 12/03/2026\n\t") and rows[7].value_raw == "1\x01 x"


# --- digests -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [0, 100, 10**6])
def test_ordered_digest_is_exact_on_both_ways(spark, limit):
    """One key holds most items; every limit must give the digest of the sorted, joined items."""
    rows = [("hot", f"item-{(i * 7919) % 20011}") for i in range(30000)] + [("a", "ü"), ("a", "z"), ("a", "z")]
    items = spark.createDataFrame(rows, "key string, v string").repartition(7)
    frame = spark.createDataFrame(
        [("hot", 30000, "p|", "|s"), ("a", 3, "", ""), ("none", 0, "only", "!")],
        "key string, n_items long, prefix string, suffix string",
    )
    got = dict(ordered_digest(items, ["key"], F.col("v"), "\n", frame, limit).select("key", "digest").collect())

    def want(key, prefix, suffix):
        joined = "\n".join(sorted((v for k, v in rows if k == key), key=lambda s: s.encode()))
        return hashlib.sha256((prefix + joined + suffix).encode()).hexdigest()

    assert got == {"hot": want("hot", "p|", "|s"), "a": want("a", "", ""), "none": want("none", "only", "!")}


# --- evidence ----------------------------------------------------------------------------------------

MEASURED = (
    "case_id string, test_code string, exam_date date, value double, unit string, value_status string, "
    "document_id string, page_num int, line_no int, char_start int, char_end int, source_text string, "
    "test_name_raw string, value_raw string, ref_low double, ref_high double, test_known boolean"
)


def feed(spark, rows):
    full = [
        ("C", code, dt.date(2026, 1, day), value, unit, "OK", f"D{i}", 1, 1, i, i + 1, "t", code, str(value), None, None, True)
        for i, (code, day, value, unit) in enumerate(rows)
    ]
    return spark.createDataFrame(full, MEASURED)


def test_directions(spark):
    m = feed(spark, [
        ("UPS", 1, 10.0, "g"), ("UPS", 2, 13.0, "G"), ("DOWNS", 1, 10.0, None), ("DOWNS", 2, 5.0, ""),
        ("SAME", 1, 100.0, "g"), ("SAME", 2, 104.9, "g"), ("ZERO", 1, 0.0, "g"), ("ZERO", 2, 1.0, "g"),
        ("UNIT", 1, 1.0, None), ("UNIT", 2, 1.0, "g"), ("NEG", 1, -10.0, "g"), ("NEG", 2, -5.0, "g"),
        ("TWICE", 1, 1.0, "g"), ("TWICE", 2, 1.0, "g"), ("TWICE", 2, 2.0, "g"), ("TWICE", 3, 3.0, "g"),
    ])
    rows = {r.test_code: r for r in evidence.temporal_comparison(evidence.per_date(m)).collect()}
    assert {k: r.direction for k, r in rows.items()} == {
        "UPS": "UP", "DOWNS": "DOWN", "SAME": "STABLE", "ZERO": "NOT_COMPARABLE", "UNIT": "UNIT_CHANGED",
        "NEG": "UP", "TWICE": "UP"}
    assert (rows["ZERO"].delta_abs, rows["ZERO"].delta_pct) == (1.0, None)
    assert (rows["NEG"].delta_abs, rows["NEG"].delta_pct) == (5.0, 50.0)
    # the conflicting day is left out of the series
    assert rows["TWICE"].previous_date == dt.date(2026, 1, 1)


def test_large_groups_are_whole_and_never_arrays(spark):
    rows = [("HOT", 1, float(i % 3), "g") for i in range(2500)] + [("K", 1, 1.0, "g"), ("K", 1, 2.0, None)] + [("V", 1, 1.0, "g"), ("V", 2, 3.0, "g")]
    m = feed(spark, rows)
    gaps = evidence.measurement_gaps(m).where("false")
    seen = {}
    for limit in (100, 10**6):
        found = findings.findings(m, gaps, limit=limit)
        assert not {f.dataType.typeName() for df in found for f in df.schema} & {"array", "map", "struct"}
        seen[limit] = {(r.test_code, r.finding_id, r.summary, r.n_evidence) for r in found.heads.collect()}
        assert found.sources.count() == 2504 and found.sources.where("test_code = 'HOT'").select("document_id").distinct().count() == 2500
        assert found.sources.join(found.heads, "finding_id", "left_anti").count() == 0
    assert seen[100] == seen[10**6] and sorted((t, n) for t, _, _, n in seen[100]) == [("HOT", 2500), ("K", 2), ("V", 2)]
    text = {t: summary for t, _, summary, _ in seen[100]}
    # one sentence of all versions, documents in order
    order = sorted(f"D{i}" for i in range(2500))
    assert text["HOT"].split(": ", 1)[1].startswith("; ".join(f"{float(int(d[1:]) % 3)} g ({d} p.1)" for d in order) + ". ")
    assert "1.0 g (D2500 p.1); 2.0  (D2501 p.1)." in text["K"] and len({t for t in text}) == 3


def test_heads_point_to_all_their_evidence(spark):
    rows = [("HOT", 1, float(i % 3), "g") for i in range(1200)] + [("V", 1, 1.0, "g"), ("V", 2, 300.0, "g")]
    m = feed(spark, rows)
    found = findings.findings(m.union(m.where("test_code = 'V' and value = 300")), evidence.measurement_gaps(m).where("false"))
    got = findings.with_pointers(found.heads, found.sources).collect()
    assert len(got) == found.heads.count()
    for r in got:
        places = r.evidence.split(",")
        assert places == sorted(places) and len(places) == r.n_evidence
    assert max(r.n_evidence for r in got) == 1200


def test_conflicts_and_findings_show_their_evidence(spark):
    from sourcetrail.plans.registry import REGISTRY

    for name in ("conflicts", "findings_all"):
        rows = REGISTRY[name](spark, "/root/testdata/sf0.001").select("n_evidence", "evidence").collect()
        assert rows and all(len(r.evidence.split(",")) == r.n_evidence for r in rows)


def test_versions_are_told_once(spark):
    rows = [("d2", 1, 5, 50, "1", "g"), ("d2", 1, 2, 20, "1", "g"), ("d2", 1, 3, 30, "2", None), ("d10", 2, 1, 0, "9", "x"), ("d10", 1, 9, 90, "8", "x"), ("d10", 1, 9, 90, "8", "x")]
    df = spark.createDataFrame([("K", *r) for r in rows], "k string, document_id string, page_num int, line_no int, char_start int, value_raw string, unit string")
    got = evidence.joined_versions(df.repartition(4), ["k"], lambda: F.concat_ws("/", "value_raw", "document_id"), ",").first()
    assert got.versions == "8/d10,9/d10,1/d2,2/d2"


def test_unmapped_missing_and_unreadable(spark):
    m = feed(spark, [("K", 1, 1.0, "g")]).withColumns({"test_known": F.lit(False), "value_status": F.lit("MISSING")})
    assert sorted(r.gap_type for r in evidence.measurement_gaps(m).collect()) == ["MISSING_VALUE", "UNMAPPED_TEST"]
    pages = spark.createDataFrame(
        [("C", "D1", None, "bad", False, False), ("C", "D2", 1, None, False, False), ("C", "D2", 2, None, False, False),
         ("C", "D3", 2, None, True, False)],
        "case_id string, document_id string, page_num int, parse_error string, synthetic_declared boolean, is_textual boolean",
    )
    got = sorted((r.document_id, r.gap_type) for r in evidence.document_gaps(pages).collect())
    assert got == [("D1", "DOCUMENT_UNREADABLE"), ("D2", "NOT_SYNTHETIC_DOCUMENT"), ("D3", "NON_TEXTUAL_PAGE")]


# --- queue: every combination ------------------------------------------------------------------------


def three(a, b):
    """SQL OR."""
    return True if a is True or b is True else (None if a is None or b is None else False)


def test_safety_rules_over_all_combinations(spark):
    flags = [True, False, None]
    combos = list(itertools.product(
        K.FINDING_TYPES, [True, False], [True, False], flags, flags, [*K.PRIORITIES, None], ["CONFIRM", "CORRECT", "REJECT", None]))
    rows = [(i, *c) for i, c in enumerate(combos) if c[1] or not (c[2] or c[3] is not None or c[4] is not None or c[5])]
    df = spark.createDataFrame(
        rows,
        "i int, finding_type string, has_classifier boolean, classifier_valid boolean, classifier_needs_review boolean, "
        "classifier_is_clear boolean, classifier_priority string, reviewer_action string",
    )
    got = {r.i: r for r in queue.apply_safety(df).collect()}
    for i, kind, has, valid, wants, clear, priority, action in rows:
        r, forced = got[i], kind in ("CONFLICT", "GAP")
        need = three(forced or not has or not valid, three(wants, None if clear is None else not clear))
        assert r.needs_review_final == (True if need is None else need)
        status = "PENDING" if not has else "OK" if valid else "INVALID"
        low = kind == "CONFLICT" and priority == "baixa"
        final = "alta" if status != "OK" else "media" if low else priority
        assert (r.classifier_status, r.priority_final) == (status, final)
        assert r.priority_rank == {"alta": 1, "media": 2}.get(final, 3)
        assert r.review_reasons == [n for n, on in [
            ("CONFLICT_ALWAYS_REVIEWED", kind == "CONFLICT"), ("GAP_ALWAYS_REVIEWED", kind == "GAP"),
            ("CLASSIFIER_PENDING", not has), ("CLASSIFIER_INVALID_RESPONSE", has and not valid),
            ("CLASSIFIER_REQUESTED_REVIEW", valid and wants), ("CLASSIFIER_LOW_CLARITY", valid and clear is False)] if on]
        assert ("CLASSIFIER_OVERRIDDEN" in r.safety_flags) == bool(valid and wants is False and forced)
        state = {"CONFIRM": "CONFIRMED", "CORRECT": "CORRECTED", "REJECT": "REJECTED"}.get(action) or (
            "AWAITING_CLASSIFIER" if not has else "HUMAN_REVIEW_REQUIRED" if r.needs_review_final else "AI_REVIEW_READY")
        assert r.finding_state == state


def test_review_states(spark):
    cases = spark.createDataFrame([(f"C{i}", f"R{i}", "s", STAMP) for i in range(9)],
                                  "case_id string, review_id string, scenario string, created_at timestamp")
    base = dict(input_hash="i", analysis_hash="a", reviewed_hash="r", target_status="CONFIRMED", signoff_at=STAMP,
                ready_for_attestation=True, n_documents=1, n_findings=1, n_classifier_pending=0, n_pending_human=0)
    changed = [{}, {}, {}, {}, {"n_classifier_pending": 1}, {"n_pending_human": 2}, {"signoff_at": None}, None,
               {"reviewed_hash": None}]
    kind = ("case_id string, input_hash string, analysis_hash string, reviewed_hash string, target_status string, "
            "signoff_at timestamp, ready_for_attestation boolean, n_documents long, n_findings long, "
            "n_classifier_pending long, n_pending_human long")
    payload = spark.createDataFrame(
        [tuple({"case_id": f"C{i}", **base, **c}.values()) for i, c in enumerate(changed) if c is not None], kind)
    sent = spark.createDataFrame([(f"R{i}", f"tx{i}", "pda", "devnet", STAMP) for i in (1, 2, 3, 4, 5, 6, 8)],
                                 "review_id string, tx_signature string, pda_address string, cluster string, submitted_at timestamp")
    def reading(i, tx=None, found=True, confirmed=True, error=None, status="ATTESTED", h="a"):
        return (f"R{i}", tx or f"tx{i}", found, confirmed, "i", h, "r", status, 1, error, STAMP)
    read = spark.createDataFrame(
        [reading(2, tx="other"), reading(3, error="x"), reading(4), reading(5, h="zz"), reading(6, confirmed=None), reading(8)],
        "review_id string, tx_signature string, account_found boolean, tx_confirmed boolean, onchain_input_hash string, "
        "onchain_analysis_hash string, onchain_reviewed_hash string, onchain_status string, slot long, error string, verified_at timestamp")
    rows = {r.case_id: r for r in integrity.review_status(cases, payload, sent, read).collect()}
    assert [rows[f"C{i}"].onchain_status for i in range(9)] == [
        "NOT_SUBMITTED", "SUBMITTED", "SUBMITTED", "VERIFICATION_FAILED", "VERIFIED", "HASH_MISMATCH",
        "VERIFICATION_FAILED", "NOT_SUBMITTED", "HASH_MISMATCH"]
    assert [rows[f"C{i}"].review_state for i in range(9)] == [
        "CONFIRMED", "CONFIRMED", "CONFIRMED", "CONFIRMED", "ATTESTED", "HUMAN_REVIEW_REQUIRED", "AI_REVIEW_READY",
        "CREATED", "CONFIRMED"]
    assert rows["C7"].n_documents == 0 and rows["C4"].is_finalized


# --- quality and change data --------------------------------------------------------------------------


def test_expectations(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x int")
    rules = {"positive": "x > 0", "small": F.col("x") < 10}
    seen = Observation("seen")
    assert quality.expect(df, rules, "warn", seen).count() == 3
    assert seen.get == {"n_rows": 3, "positive": 2, "small": 1}
    assert quality.expect(df, rules, "drop").collect() == [(1,)]
    with pytest.raises(PySparkException, match="positive"):
        quality.expect(df, rules, "fail").select(F.lit(1)).count()
    assert quality.expectation_report(df, rules).collect() == [("positive", 3, 1, 2), ("small", 3, 2, 1)]


def test_decision_contract(spark):
    good = ("R-1", "FINDING", "f1", "CORRECT", 1.0, None, "rev.1")
    rows = [good, ("R-1", "FINDING", None, "CONFIRM", None, None, "r"), ("R-1", "FINDING", "f", "SIGNOFF", None, None, "r"),
            ("R-1", "FINDING", "f", "CORRECT", None, None, "r"), ("R-1", "REVIEW", "f", "SIGNOFF", None, None, "r"),
            ("R-1", "REVIEW", None, "CONFIRM", None, None, "r"), ("../x", "REVIEW", None, "SIGNOFF", None, "free text", "r")]
    df = spark.createDataFrame(rows, "review_id string, scope string, finding_id string, action string, corrected_value double, corrected_unit string, reviewer_tech_id string")
    got = [r.violations for r in quality.validate(df, quality.review_decision_contract()).collect()]
    assert got == [[], ["finding_scope_names_finding"], ["finding_scope_no_signoff"], ["correction_has_value"],
                   ["review_scope_signoff_only"], ["review_scope_signoff_only"], ["review_id", "corrected_unit"]]


def test_attestation_contract(spark):
    sha = "a" * 64
    base = dict(review_id="rev-1", cluster="devnet", program_id="1" * 32, pda_address="9xQeWvG816bUx9EPjHmaT23yvVM2ZWbrrpZb9PusVFin",
                tx_signature="5" * 88, input_hash=sha, analysis_hash=sha, reviewed_hash=sha, workflow_version="wf-1",
                model_version="a+b", status="SUBMITTED", reviewer_tech_id="r")
    bad = [{}, {"cluster": "mainnet"}, {"status": "ATTESTED"}, {"input_hash": "A" * 64}, {"program_id": "0" * 32}, {"model_version": "x" * 33}]
    df = spark.createDataFrame([tuple({**base, **b}.values()) for b in bad], ", ".join(f"{k} string" for k in base))
    got = [r.violations for r in quality.validate(df, quality.attestation_contract()).collect()]
    assert got == [[]] + [[k] for b in bad[1:] for k in b]


def test_latest_by_ignores_arrival_order(spark):
    rows = [("a", 2, "x"), ("a", 3, "y"), ("a", 1, "z"), ("b", 5, "p"), ("b", 5, "q")]
    for order in itertools.permutations(rows, 5):
        df = spark.createDataFrame(list(order), "k string, s int, v string")
        break
    assert sorted(cdc.latest_by(df, ["k"], "s").collect()) == [("a", 3, "y"), ("b", 5, "q")]
    flipped = spark.createDataFrame(rows[::-1], "k string, s int, v string")
    assert sorted(cdc.latest_by(flipped, ["k"], "s").collect()) == [("a", 3, "y"), ("b", 5, "q")]


def test_classifier_events_are_downgraded_not_dropped(spark):
    terms = K.Terms()
    rows = [("f1", "r", True, "ALTA", True, "m", "v", "h", "{}", True, "w", STAMP), ("f2", "r", None, "alta", True, "m", "v", "h", "{}", True, "w", STAMP),
            ("f3", "r", True, "urgente", True, "m", "v", "h", "{}", True, "w", STAMP), ("f4", "r", True, "baixa", True, "m", "v", "h", "{}", None, "w", STAMP)]
    df = cdc.normalize_classifier_decisions(spark.createDataFrame(rows, terms.decisions_feed), terms)
    assert [(r.priority, r.classifier_response_valid) for r in df.orderBy("finding_id").collect()] == [
        ("alta", True), ("alta", False), ("urgente", False), ("baixa", False)]


def test_feed_rescue(spark):
    lines = ['{"a": 1, "b": "x"}', '{"a": "no", "b": "y", "z": [1]}', "broken", '{"b": null}']
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    got = [tuple(r) for r in feeds.parse_feed(df, "a INT, b STRING").collect()]
    assert got == [(1, "x", None), (None, "y", '{"a":"no","z":"[1]"}'), (None, None, '{"_corrupt_record":"broken"}'), (None, None, None)]


# --- classifier, ledger, policy, scans, serving --------------------------------------------------------


def test_answers(spark):
    flags = ['{"output": true}', '{"output": "Sim"}', '{"output": {"answer": "no"}}', '{"output": "talvez"}', "false", '"yes"', None,
             '{"output": {"answer": null, "value": "yes"}}', '{"output": null, "value": "yes"}', '{"output": {"value": "no"}}']
    assert column(spark, flags, classify.yes_no) == [True, True, False, None, False, True, None, None, None, False]
    choices = ['{"output": "Média"}', '{"output": {"choice": "alta"}}', '{"output": "urgente"}', '"baixa"', "baixa"]
    assert column(spark, choices, classify.choice) == ["media", "alta", None, "baixa", "baixa"]
    version = classify.question_version({"a": ["yes_no", "?"]}, K.PRIORITIES, "q")
    assert version.startswith("q-") and len(version) == 14


def record(status=6, workflow=b"wf-1", review="rev-1", at=-5):
    h = lambda s: hashlib.sha256(s.encode()).digest()
    body = b"\0" * 8 + h(review) + h("in") + h("an") + h("rv") + workflow.ljust(32, b"\0") + b"m+1".ljust(32, b"\0")
    return body + bytes([status]) + b"\1" * 32 + at.to_bytes(8, "little", signed=True) + b"\xff"


def test_record_decoding(spark):
    assert ledger.RECORD_BYTES == 242 == len(record())
    good, odd, short, broken = column(spark, [record(), record(9), record()[:100], record(workflow=b"\xff\xfe")], ledger.decode_record, "binary")
    assert (good.status, good.attested_at, good.workflow_version, good.error) == ("ATTESTED", -5, "wf-1", None)
    assert good.input_hash == hashlib.sha256(b"in").hexdigest() and odd.status == "UNKNOWN_9"
    assert short.error and short.status is None and broken.error and broken.model_version is None


def test_account_verification(spark):
    due = spark.createDataFrame([(f"rev-{i}", f"p{i}", f"t{i}", True) for i in range(4)], "review_id string, pda_address string, tx_signature string, tx_confirmed boolean")
    accounts = spark.createDataFrame([("p0", "prog", record(review="rev-0"), 1), ("p1", "other", record(review="rev-1"), 1), ("p2", "prog", record(review="zzz"), 1)],
                                     "pda_address string, owner string, data binary, slot long")
    rows = {r.review_id: r for r in ledger.verify(due, accounts, "prog").collect()}
    assert rows["rev-0"].account_found and rows["rev-0"].onchain_status == "ATTESTED" and rows["rev-0"].error is None
    assert "owner" in rows["rev-1"].error and "review_id_hash" in rows["rev-2"].error and rows["rev-3"].error
    assert not any(rows[f"rev-{i}"].account_found for i in (1, 2, 3))
    hosts = ["https://api.devnet.example.com", "https://api.mainnet.example.com", "http://localhost:8899", "devnet", None]
    assert column(spark, hosts, ledger.on_test_cluster) == [True, False, False, False, False]


def test_policy_at_any_depth(spark):
    df = spark.createDataFrame(
        [(bytearray(b"x"), "text", [("d", 1, "secret"), ("d", 2, ""), ("d", 3, None)], (("deep",),)), (None, None, None, None)],
        "content binary, page_text string, evidence array<struct<document_id:string,page_num:int,source_text:string>>, "
        "nested struct<a:struct<source_text:string>>")
    assert policy.sensitive_paths(df.schema) == ["content", "page_text", "evidence.source_text", "nested.a.source_text"]
    row, nothing = policy.apply_policy(df, set()).collect()
    assert row.content is None and row.page_text == K.RESTRICTED and row.nested.a.source_text == K.RESTRICTED
    assert [e.source_text for e in row.evidence] == [K.RESTRICTED, "", None] and [e.page_num for e in row.evidence] == [1, 2, 3]
    assert tuple(nothing) == (None, None, None, None)
    seen = policy.apply_policy(df, {policy.TEXT_READERS, policy.RAW_READERS})
    assert seen.collect() == df.collect()
    policy.register_mask_functions(spark)
    sql = "SELECT mask_document_text('t', array()), mask_document_text('', array()), mask_document_text('t', array('text_readers')), mask_raw_document(X'00', array())"
    assert tuple(spark.sql(sql).first()) == (K.RESTRICTED, "", "t", None)


def test_claims_and_negations(spark):
    df = spark.createDataFrame([(1, "O sistema diagnostica.\nO sistema não diagnostica, mas o sistema prescreve\nreduz erros médicos e garante segurança")], "id int, t string")
    got = sorted((r.line_no, r.claim) for r in scans.claim_scan(df, ["id"], "t", r"(?i)sistema (?:diagnostica|prescreve)|garante \S+|reduz erros \S+", r"(?i) (?:não|sem) ").collect())
    assert got == [(1, "sistema diagnostica"), (3, "garante segurança"), (3, "reduz erros médicos")]


def test_expected_against_found(spark):
    kind = "case_id string, finding_type string, finding_subtype string, test_code string, exam_date date"
    expected = spark.createDataFrame([("C", "GAP", "A", "K", None, 2), ("C", "GAP", "B", None, None, None), ("C", "GAP", "U", None, None, 1)], kind + ", expected_page int")
    found = spark.createDataFrame(
        [("C", "GAP", "A", "K", None, "f1", [(1,), (2,)]), ("C", "GAP", "A", "K", None, "f2", [(1,)]), ("C", "GAP", "X", "K", None, "f3", [(1,)]),
         ("Z", "GAP", "X", "K", None, "f4", [(1,)]), ("C", "GAP", "U", None, None, "f5", [(None,)])],
        kind + ", finding_id string, evidence array<struct<page_num:int>>")
    rows = {r.finding_subtype: r for r in evaluate.expected_vs_found(expected, found.select("*", F.inline("evidence")), found).collect()}
    assert {k: (r.outcome, r.source_page_matches, r.n_findings) for k, r in rows.items()} == {
        "A": ("MATCHED", True, 2), "B": ("MISSED", None, None), "X": ("EXTRA", None, 1), "U": ("MATCHED", None, 1)}
    ids = {(r.finding_subtype, r.finding_id, r.n_findings) for r in evaluate.found_ids(found.where("case_id = 'C'")).collect()}
    assert ids == {("A", "f1", 2), ("A", "f2", 2), ("X", "f3", 1), ("U", "f5", 1)}
    outcomes = evaluate.expected_vs_found(expected, found.select("*", F.inline("evidence")), found)
    assert {(r.outcome, r.finding_id) for r in evaluate.outcome_ids(outcomes, found).collect()} == {
        ("MATCHED", "f1"), ("MATCHED", "f2"), ("EXTRA", "f3"), ("MATCHED", "f5")}


def test_parameters_are_bound_by_name(spark):
    df = spark.createDataFrame([("C1", 1), ("C2", 2), ("C' OR 1=1", 3)], "case_id string, n int")
    assert serve.bound(df, case_id="C2").collect() == [("C2", 2)]
    assert serve.bound(df, case_id="C' OR 1=1").collect() == [("C' OR 1=1", 3)]
    assert serve.bound(df, case_id=None).count() == 3


def test_portal_queries_on_the_cases(review, cases):
    shown = serve.case_queue(review["queue"], "CASE-C", cases.terms).collect()
    assert len(shown) == 8 and [r.priority_final for r in shown] == sorted((r.priority_final for r in shown))
    some = shown[0].finding_id
    assert serve.finding_sources(review["found"].sources, some).count() >= 1
    assert serve.page_text(review["pages"], "A_lab_20260310", 1).count() == 1
    dated = [r.exam_date for r in serve.case_timeline(evidence.timeline(review["measured"]), "CASE-C").collect()]
    assert dated[-1] is None and None not in dated[:-1]
    assert serve.review_payload(review["payload"], "rev-a-0001").count() == 1
    none = policy.apply_policy(review["found"].sources, set())
    assert {r.source_text for r in none.collect()} <= {K.RESTRICTED, ""}
