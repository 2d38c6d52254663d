"""The four worked cases of FIXTURES.md, read from that file."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import functions as F

from sourcetrail import contract as K
from sourcetrail.session import materialize
from sourcetrail.operators import classify, evidence, extract, findings, integrity, queue

FIXTURES = Path(__file__).resolve().parents[1] / "FIXTURES.md"


@dataclass
class CaseFiles:
    terms: K.Terms
    model: str
    version: str
    pages: list[tuple]
    documents: list[tuple]
    measurements: dict[tuple, dict]
    findings: list[dict]
    hashes: dict[str, dict]
    expected: list[tuple] = field(default_factory=list)


def _tables(text: str) -> list[list[list[str]]]:
    out, current = [], []
    for line in text.splitlines():
        if line.startswith("|"):
            cells = [c.strip() for c in line.strip().strip("|").split("|")]
            if not set("".join(cells)) <= set("-: "):
                current.append(cells)
        elif current:
            out.append(current)
            current = []
    return out + ([current] if current else [])


def _bare(cell: str) -> str:
    return cell.strip("`")


def load_cases() -> CaseFiles:
    text = FIXTURES.read_text(encoding="utf-8")
    prefix = re.search(r"\| (\w+)_decisions \(classifier\)", text).group(1)
    model = re.search(r"stand-in classifier: model `([^`]+)`", text).group(1)
    version = re.search(r"question version `([^`]+)`", text).group(1)
    tokens = {"{H}": re.search(r"`\{H\}` = ([^;]+);", text).group(1)}
    tokens["{P}"] = re.search(r"`\{P\}` = `([^`]+)`", text).group(1)
    tokens["{C}"] = re.search(r"`\{C\}` = `([^`]+)`", text).group(1)
    tokens["{F}"] = re.search(r"`\{F\}` = ([^\n]+?)\.\n", text).group(1) + "."

    tables = {t[0][0] + "/" + t[0][1]: t[1:] for t in _tables(text) if len(t[0]) > 1}
    by_head = {tuple(t[0]): t[1:] for t in _tables(text)}
    pages = []
    for case, document, page, declared, lines in by_head[("Case", "Document", "Page", "Declared", "Lines")]:
        if lines == "NULL":
            body = None
        elif lines.startswith("''"):
            body = ""
        else:
            for token, value in tokens.items():
                lines = lines.replace(token, value)
            body = "".join(part.strip() + "\n" for part in lines.split("⏎"))
        pages.append((case, _bare(document), int(page), declared == "true", body))
    hashes = {_bare(d): _bare(h) for d, h in tables["Document/input_hash"]}
    case_of = {document: case for case, document, *_ in pages}
    documents = [(case_of[d], d, h) for d, h in hashes.items()]

    head = ("Case", "Document", "Page", "Line", "Chars", "Date", "Position", "Test", "Value", "Unit", "Range", "Status")
    measured = {}
    for row in by_head[head]:
        r = dict(zip(head, row))
        start, end = r["Chars"].split("–")
        measured[(_bare(r["Document"]), int(r["Page"]), int(start))] = {**r, "end": int(end)}

    found = []
    for case, kind, test, date, places, finding_id in by_head[
        ("Case", "Type / subtype", "Test", "Date", "Evidence (document:page:char_start)", "finding_id")
    ]:
        kind, subtype = kind.split(" / ")
        found.append(
            dict(case_id=case, finding_type=kind, finding_subtype=subtype, test_code=None if test == "NULL" else test,
                 exam_date=None if date == "NULL" else date, places=sorted(places.split(", ")),
                 finding_id=_bare(finding_id))
        )
    chain_head = ("Case", "input_hash", "analysis_hash", "reviewed_hash", "model_version", "Counts")
    chain = {r[0]: {k: _bare(v) for k, v in zip(chain_head, r)} for r in by_head[chain_head]}
    return CaseFiles(
        K.Terms(prefix=prefix, system="revisor"), model, version, pages, documents, measured, found, chain
    )


STAMP = dt.datetime(2026, 9, 20, 12, 0, 0)


def page_frame(spark, files: CaseFiles):
    rows = [
        (case, document, page, declared, text, None, bool(text and text.strip(" ")), STAMP)
        for case, document, page, declared, text in files.pages
    ]
    return spark.createDataFrame(
        rows,
        "case_id string, document_id string, page_num int, synthetic_declared boolean, page_text string, "
        "parse_error string, is_textual boolean, ingested_at timestamp",
    )


def run_review(spark, files: CaseFiles) -> dict:
    pages = page_frame(spark, files)
    documents = spark.createDataFrame(files.documents, "case_id string, document_id string, input_hash string")
    letters = "abcd"
    cases = spark.createDataFrame(
        [(f"CASE-{c.upper()}", f"rev-{c}-0001", c, STAMP, None) for c in letters],
        "case_id string, review_id string, scenario string, created_at timestamp, manual_review_seconds_baseline int",
    )
    measured = materialize(extract.extract_measurements(pages), "measured")
    gaps = evidence.all_gaps(measured, pages, files.terms)
    found = findings.findings(measured, gaps, cases, files.terms)
    heads = materialize(found.heads, "found")
    answers = classify.stand_in_answers(classify.context_text())
    decisions = classify.decision_records(
        heads, answers, files.model, files.version, integrity.WORKFLOW_VERSION, F.lit(STAMP), files.terms
    )
    reviewed = spark.createDataFrame([], K.REVIEW_DECISIONS_FEED)
    queued = materialize(queue.review_queue(heads, decisions, reviewed, files.terms), "queue")
    payload = integrity.attestation_payload(cases, documents, queued, measured, reviewed, files.terms)
    return dict(pages=pages, documents=documents, cases=cases, measured=measured, gaps=gaps, found=found,
                heads=heads, decisions=decisions, reviewed=reviewed, queue=queued, payload=payload)
