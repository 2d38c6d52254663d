"""The four worked cases: every measurement, finding id and hash."""

from sourcetrail.operators import evidence, extract, findings


def test_measurements(review, cases):
    rows = review["measured"].collect()
    got = {(r.document_id, r.page_num, r.char_start): r for r in rows}
    assert set(got) == set(cases.measurements) and len(rows) == 27
    for key, want in cases.measurements.items():
        r = got[key]
        low, high = (None if x == "NULL" else float(x) for x in want["Range"].split(" – "))
        assert r.case_id == want["Case"] and r.line_no == int(want["Line"]) and r.char_end == want["end"]
        assert str(r.exam_date) == want["Date"].replace("NULL", "None")
        assert (r.test_code, r.value_status) == (want["Test"], want["Status"])
        assert r.value == (None if want["Value"] == "NULL" else float(want["Value"]))
        assert r.unit == (None if want["Unit"] == "NULL" else want["Unit"])
        assert (r.ref_low, r.ref_high) == (low, high)


def test_timeline_positions(review, cases):
    for r in evidence.timeline(review["measured"]).collect():
        want = cases.measurements[(r.document_id, r.page_num, r.char_start)]["Position"]
        assert str(r.timeline_position) == want.replace("NULL", "None")


def test_offsets_lead_back_to_the_text(review):
    assert extract.misplaced_evidence(review["measured"], review["pages"]).count() == 0


def test_finding_ids(review, cases):
    rows = review["heads"].collect()
    got = {r.finding_id: r for r in rows}
    assert len(rows) == len(cases.findings) == 20
    for want in cases.findings:
        r = got[want["finding_id"]]
        assert (r.case_id, r.finding_type, r.finding_subtype) == (
            want["case_id"], want["finding_type"], want["finding_subtype"])
        assert r.test_code == want["test_code"]


def test_long_evidence(review, cases):
    rows = review["found"].sources.collect()
    places = {}
    for r in rows:
        parts = [r.document_id, str(r.page_num)] + ([str(r.char_start)] if r.char_start is not None else [])
        places.setdefault(r.finding_id, []).append(":".join(parts))
    assert {k: sorted(v) for k, v in places.items()} == {f["finding_id"]: f["places"] for f in cases.findings}


def test_ids_do_not_depend_on_how_pointers_meet(review, cases):
    """Pointers of every finding sorted over the cluster instead of in one task: ids must not change."""
    split = findings.findings(review["measured"], review["gaps"], review["cases"], cases.terms, limit=1)
    assert sorted(r.finding_id for r in split.heads.collect()) == sorted(f["finding_id"] for f in cases.findings)


def test_hash_chain(review, cases):
    rows = {r.case_id: r for r in review["payload"].collect()}
    assert set(rows) == set(cases.hashes)
    for case, want in cases.hashes.items():
        r = rows[case]
        assert r.input_hash == want["input_hash"]
        assert r.analysis_hash == want["analysis_hash"]
        assert r.reviewed_hash == want["reviewed_hash"]
        assert r.model_version == want["model_version"]
        counts = " / ".join(str(x) for x in (r.n_documents, r.n_findings, r.n_pending_human))
        assert counts == want["Counts"]
