"""The SQL each registered query is checked against, written for another engine (DuckDB)."""

from __future__ import annotations

from sourcetrail import contract as K
from sourcetrail.plans import driver_feeds as D


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def with_ctes(names: list[str], body: str) -> str:
    """``body`` after the named building blocks and all blocks they need, in order."""
    needed: list[str] = []

    def add(name: str) -> None:
        if name not in needed:
            for other in BLOCKS[name][0]:
                add(other)
            needed.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({BLOCKS[n][1]})" for n in needed) + "\n" + body


def rounded(value: str, digits: int) -> str:
    """Half-up rounding of the shortest decimal text of a double."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


def folded(text: str) -> str:
    return f"lower(strip_accents({text}))"


def same(a: str, b: str, columns: list[str]) -> str:
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in columns)


KEY = ["finding_type", "finding_subtype", "case_id", "test_code", "exam_date"]
KEYS = ", ".join(KEY)

GAP_TEXT = " ".join(
    f"WHEN {q(gap)} THEN {q(a)} || test_name_raw || {q(b.format(system='sistema'))}"
    for gap, (a, b) in K.MEASUREMENT_GAP_TEXT.items()
)
DOC_GAP_TEXT = " ".join(f"WHEN {q(gap)} THEN {q(text)}" for gap, text in K.DOCUMENT_GAP_TEXT.items())
RISKY = " OR ".join(f"contains(context, {q(mark)})" for mark in K.RISKY_MARKS)


def json_pair(name: str, value: str, quoted: bool) -> str:
    shown = f"'\"' || {value} || '\"'" if quoted else f"CAST({value} AS VARCHAR)"
    return f"CASE WHEN {value} IS NULL THEN NULL ELSE '\"{name}\":' || {shown} END"


def json_text(pairs: list[tuple[str, str, bool]]) -> str:
    return "'{' || concat_ws(',', " + ", ".join(json_pair(*p) for p in pairs) + ") || '}'"


ANALYSIS = json_text(
    [("finding_id", "finding_id", True), ("type", "finding_type", True), ("subtype", "finding_subtype", True)]
    + [(f"classifier_{n}", f"classifier_{n}", s) for n, s in
       [("model", True), ("prompt_version", True), ("needs_review", False), ("priority", True), ("is_clear", False)]]
    + [("needs_review_final", "needs_review_final", False), ("priority_final", "priority_final", True)]
)
DECISION = json_text(
    [("finding_id", "finding_id", True), ("action", "reviewer_action", True),
     ("corrected_value", "corrected_value", False), ("corrected_unit", "corrected_unit", True),
     ("reviewer", "reviewer_tech_id", True)]
)


def name_list(pairs: list[tuple[str, str]]) -> str:
    """Names whose condition holds, joined by commas; no name gives an empty text."""
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN {q(n)} END" for n, c in pairs) + ")"


BLOCKS: dict[str, tuple[list[str], str]] = {
    "e": ([], r"""SELECT *, CAST(regexp_extract(props, ':\s*(\d+)', 1) AS INTEGER) AS k FROM events"""),
    "m": (
        ["e"],
        f"""SELECT case_id, document_id, page_num, line_no, char_start,
          CAST(char_start + length(event_type || ': ' || value_raw) AS INTEGER) AS char_end,
          event_type || ': ' || value_raw AS source_text, exam_date, strftime(exam_date, '%d/%m/%Y') AS date_source_text,
          'Exame ' || event_type AS test_name_raw, event_type AS test_code, event_type <> 'error' AS test_known,
          value_raw, CASE WHEN value_status = 'OK' THEN value END AS value, value_status, unit,
          CASE WHEN k % 13 <> 0 THEN CAST(1 AS DOUBLE) END AS ref_low,
          CASE WHEN k % 13 <> 0 THEN CAST(100 AS DOUBLE) END AS ref_high,
          sha256(concat_ws('|', document_id, page_num, char_start)) AS measurement_id,
          ts AS ingested_at, ts + to_seconds(k) AS processed_at
        FROM (SELECT *, 'C' || user_id AS case_id, 'D' || (event_id // 25) AS document_id,
          CAST((event_id // 5) % 5 + 1 AS INTEGER) AS page_num, CAST(event_id % 5 + 1 AS INTEGER) AS line_no,
          CAST(event_id % 5 * 40 AS INTEGER) AS char_start,
          CASE WHEN k % 17 <> 0 THEN CAST(ts AS DATE) END AS exam_date,
          CASE k % 23 WHEN 0 THEN 'ILLEGIBLE' WHEN 1 THEN 'MISSING' WHEN 2 THEN 'AMBIGUOUS' ELSE 'OK' END AS value_status,
          CASE k % 23 WHEN 0 THEN 'ilegível' WHEN 1 THEN 'N/D' WHEN 2 THEN 'aprox.'
            ELSE replace(CAST(value AS VARCHAR), '.', ',') END AS value_raw,
          CASE WHEN k % 11 = 0 THEN NULL WHEN k % 5 = 0 THEN 's' WHEN k % 2 = 0 THEN 'ms' ELSE 'MS' END AS unit
          FROM e)""",
    ),
    "usable": (["m"], "SELECT * FROM m WHERE value_status = 'OK' AND exam_date IS NOT NULL"),
    "days": (
        ["usable"],
        """SELECT case_id, test_code, exam_date, min(test_name_raw) AS test_name_raw,
          count(DISTINCT CAST(value AS VARCHAR) || '|' || lower(coalesce(unit, ''))) AS n_versions,
          min(value) AS value, min(unit) AS unit, count(*) AS n
        FROM usable GROUP BY ALL""",
    ),
    "steps": (
        ["days"],
        """SELECT *, lag(exam_date) OVER w AS previous_date, lag(value) OVER w AS previous_value,
          lag(unit) OVER w AS previous_unit, lag(n) OVER w AS previous_n
        FROM days WHERE n_versions = 1 WINDOW w AS (PARTITION BY case_id, test_code ORDER BY exam_date)""",
    ),
    "compared": (
        ["steps"],
        f"""SELECT *, CASE WHEN NOT comparable THEN 'UNIT_CHANGED' WHEN delta_pct IS NULL THEN 'NOT_COMPARABLE'
            WHEN abs(delta_pct) < 5 THEN 'STABLE' WHEN delta_pct > 0 THEN 'UP' ELSE 'DOWN' END AS direction
        FROM (SELECT *, CASE WHEN comparable THEN {rounded('value - previous_value', 4)} END AS delta_abs,
            CASE WHEN comparable AND previous_value <> 0
              THEN {rounded('100 * (value - previous_value) / abs(previous_value)', 2)} END AS delta_pct
          FROM (SELECT *, lower(coalesce(unit, '')) = lower(coalesce(previous_unit, '')) AS comparable
            FROM steps WHERE previous_date IS NOT NULL))""",
    ),
    "gap_rows": (
        ["m"],
        f"""SELECT *, CASE gap_type {GAP_TEXT} END AS description
        FROM (SELECT m.*, unnest(list_filter([
            CASE WHEN exam_date IS NULL THEN 'MISSING_DATE' END,
            CASE value_status WHEN 'ILLEGIBLE' THEN 'ILLEGIBLE_VALUE' WHEN 'MISSING' THEN 'MISSING_VALUE'
              WHEN 'AMBIGUOUS' THEN 'AMBIGUOUS_VALUE' END,
            CASE WHEN value_status = 'OK' AND unit IS NULL THEN 'MISSING_UNIT' END,
            CASE WHEN value_status = 'OK' AND (ref_low IS NULL OR ref_high IS NULL) THEN 'MISSING_REFERENCE_RANGE' END,
            CASE WHEN NOT test_known THEN 'UNMAPPED_TEST' END], lambda x: x IS NOT NULL)) AS gap_type FROM m)""",
    ),
    "ranged": (
        ["m"],
        """SELECT *, CASE WHEN value < ref_low THEN 'BELOW_DOCUMENT_RANGE' ELSE 'ABOVE_DOCUMENT_RANGE' END AS side,
          test_name_raw || ' = ' || value_raw || ' ' || coalesce(unit, '')
            || ' fora da faixa de referência informada no documento (' || CAST(ref_low AS VARCHAR) || '–'
            || CAST(ref_high AS VARCHAR) || ').' AS summary
        FROM m WHERE value_status = 'OK' AND ref_low IS NOT NULL AND ref_high IS NOT NULL AND NOT (value BETWEEN ref_low AND ref_high)""",
    ),
    "stated": (
        ["usable", "days"],
        """SELECT u.case_id, u.test_code, u.exam_date, value_raw, u.unit, document_id, page_num,
            min(line_no) AS first_line
        FROM usable u JOIN days d ON d.case_id = u.case_id AND d.test_code = u.test_code AND d.exam_date = u.exam_date
        WHERE n_versions > 1 GROUP BY ALL""",
    ),
    "stated_text": (
        ["stated"],
        """SELECT case_id, test_code, exam_date,
            string_agg(value_raw || ' ' || coalesce(unit, '') || ' (' || document_id || ' p.' || page_num || ')', '; '
              ORDER BY document_id, page_num, first_line) AS texts,
            string_agg(value_raw || '/' || coalesce(unit, '') || '/' || document_id || '/' || page_num, ','
              ORDER BY document_id, page_num, first_line) AS versions
        FROM stated GROUP BY ALL""",
    ),
    "sources": (
        ["compared", "days", "usable", "gap_rows", "ranged", "stated_text"],
        f"""SELECT g.*, u.document_id, u.page_num, u.line_no, u.char_start, u.char_end, u.source_text FROM (
            SELECT 'TEMPORAL_VARIATION' AS finding_type, direction AS finding_subtype, case_id, test_code, exam_date,
              CASE WHEN direction = 'UNIT_CHANGED'
                THEN test_name_raw || ' mudou de unidade entre ' || strftime(previous_date, '%d/%m/%Y') || ' ('
                  || coalesce(previous_unit, 'sem unidade') || ') e ' || strftime(exam_date, '%d/%m/%Y') || ' ('
                  || coalesce(unit, 'sem unidade') || '); comparação direta não realizada.'
                ELSE test_name_raw || ' variou ' || CAST(delta_pct AS VARCHAR) || '% entre '
                  || strftime(previous_date, '%d/%m/%Y') || ' (' || CAST(previous_value AS VARCHAR) || ' '
                  || coalesce(previous_unit, '') || ') e ' || strftime(exam_date, '%d/%m/%Y') || ' ('
                  || CAST(value AS VARCHAR) || ' ' || coalesce(unit, '') || ').' END AS summary,
              unnest([previous_date, exam_date]) AS source_date
            FROM compared WHERE direction = 'UNIT_CHANGED' OR abs(delta_pct) >= 20
            UNION ALL
            SELECT 'CONFLICT', 'DIVERGENT_VALUES', d.case_id, d.test_code, d.exam_date,
              test_name_raw || ' em ' || strftime(d.exam_date, '%d/%m/%Y') || ' aparece com ' || n_versions
                || ' versões diferentes: ' || texts || '. O sistema não escolhe a versão correta.', d.exam_date
            FROM days d JOIN stated_text s
              ON d.case_id = s.case_id AND d.test_code = s.test_code AND d.exam_date = s.exam_date
          ) g JOIN usable u ON u.case_id = g.case_id AND u.test_code = g.test_code AND u.exam_date = g.source_date
          UNION ALL
          SELECT 'OUT_OF_DOCUMENT_RANGE', side, case_id, test_code, exam_date, summary, exam_date,
            document_id, page_num, line_no, char_start, char_end, source_text FROM ranged
          UNION ALL
          SELECT 'GAP', gap_type, case_id, test_code, exam_date, description, exam_date,
            document_id, page_num, line_no, char_start, char_end, source_text FROM gap_rows""",
    ),
    "placed": (
        ["sources"],
        """SELECT *, concat_ws(':', document_id, page_num, char_start) AS place,
          CASE WHEN finding_type IN ('GAP', 'OUT_OF_DOCUMENT_RANGE')
            THEN concat_ws(':', document_id, page_num, char_start) ELSE '' END AS own
        FROM sources""",
    ),
    "known": (
        ["e"],
        """SELECT 'C' || user_id AS case_id, 'R' || user_id AS review_id, user_id, min(ts) AS created_at, max(ts) AS last_seen
        FROM e GROUP BY user_id""",
    ),
    "found": (
        ["placed", "known"],
        f"""SELECT sha256(concat_ws('|', finding_type, finding_subtype, f.case_id, test_code,
            coalesce(CAST(exam_date AS VARCHAR), ''), evidence)) AS finding_id, review_id, f.*
        FROM (SELECT {KEYS}, summary, string_agg(place, ',' ORDER BY place) AS evidence, count(*) AS n_evidence
          FROM placed GROUP BY {KEYS}, summary, own) f JOIN known USING (case_id)""",
    ),
    "answers": (
        ["found"],
        f"""SELECT finding_id, needs_review, priority, is_clear, context,
            is_clear IS NOT NULL AS valid, exam_date + INTERVAL 30 HOUR AS decided_at,
            '{{"is_clear":' || to_json(raw_clear) || ',"needs_review":' || to_json(raw_review)
              || ',"priority":' || to_json(raw_priority) || '}}' AS raw_answers
        FROM (SELECT *, finding_type <> 'TEMPORAL_VARIATION' AS needs_review,
            CASE WHEN low THEN 'baixa' WHEN risky THEN 'alta' ELSE 'media' END AS priority,
            CASE WHEN test_code = 'error' THEN NULL ELSE NOT risky END AS is_clear,
            CASE WHEN test_code = 'error' THEN 'talvez' WHEN risky THEN '{{"output": false}}' ELSE '{{"output": true}}' END AS raw_clear,
            CASE WHEN finding_type = 'TEMPORAL_VARIATION' THEN '{{"output": "não"}}' ELSE '{{"output": true}}' END AS raw_review,
            CASE WHEN low THEN '{{"output": {{"choice": "BAIXA"}}}}' WHEN risky THEN '{{"output": "alta"}}' ELSE '{{"output": "media"}}' END AS raw_priority
          FROM (SELECT *, test_code = 'view' AND finding_type = 'CONFLICT' AS low, {RISKY} AS risky
            FROM (SELECT *, 'Tipo: ' || finding_type || '. Subtipo: ' || finding_subtype || '. Resumo: ' || summary AS context
              FROM found WHERE exam_date IS NOT NULL)))""",
    ),
    "queued": (
        ["found", "answers"],
        f"""SELECT *, CASE WHEN NOT has_classifier THEN 'PENDING' WHEN NOT classifier_valid THEN 'INVALID' ELSE 'OK' END AS classifier_status,
            (forced OR NOT has_classifier OR NOT classifier_valid OR coalesce(classifier_needs_review, true)
              OR coalesce(NOT classifier_is_clear, true)) AS needs_review_final,
            CASE WHEN NOT classifier_valid THEN 'alta' WHEN lifted THEN 'media' ELSE classifier_priority END AS priority_final,
            CASE WHEN NOT has_classifier THEN 'DEFAULT_HIGH_CLASSIFIER_PENDING' WHEN NOT classifier_valid THEN 'DEFAULT_HIGH_CLASSIFIER_INVALID'
              WHEN lifted THEN 'CONFLICT_MIN_MEDIUM' ELSE 'CLASSIFIER_PRIORITY' END AS priority_reason,
            {name_list([("CONFLICT_ALWAYS_REVIEWED", "finding_type = 'CONFLICT'"), ("GAP_ALWAYS_REVIEWED", "finding_type = 'GAP'"),
                        ("CLASSIFIER_PENDING", "NOT has_classifier"), ("CLASSIFIER_INVALID_RESPONSE", "has_classifier AND NOT classifier_valid"),
                        ("CLASSIFIER_REQUESTED_REVIEW", "classifier_valid AND classifier_needs_review"),
                        ("CLASSIFIER_LOW_CLARITY", "classifier_valid AND NOT classifier_is_clear")])} AS review_reasons,
            {name_list([("FORCED_REVIEW_CONFLICT", "finding_type = 'CONFLICT'"), ("FORCED_REVIEW_GAP", "finding_type = 'GAP'"),
                        ("CLASSIFIER_PENDING", "NOT has_classifier"), ("CLASSIFIER_INVALID_SCHEMA", "has_classifier AND NOT classifier_valid"),
                        ("LOW_CLARITY", "classifier_valid AND NOT classifier_is_clear"),
                        ("CLASSIFIER_OVERRIDDEN", "classifier_valid AND NOT classifier_needs_review AND forced")])} AS safety_flags
        FROM (SELECT *, finding_type IN ('CONFLICT', 'GAP') AS forced,
            coalesce(finding_type = 'CONFLICT' AND classifier_priority = 'baixa', false) AS lifted
          FROM (SELECT f.*, a.finding_id IS NOT NULL AS has_classifier, coalesce(a.valid, false) AS classifier_valid,
              a.needs_review AS classifier_needs_review, a.priority AS classifier_priority, a.is_clear AS classifier_is_clear,
              CASE WHEN a.finding_id IS NOT NULL THEN {q(D.MODEL)} END AS classifier_model,
              CASE WHEN a.finding_id IS NOT NULL THEN {q(D.QUESTIONS)} END AS classifier_prompt_version,
              a.decided_at AS classifier_decided_at,
              CASE test_code WHEN 'click' THEN 'CONFIRM' WHEN 'view' THEN 'CORRECT' WHEN 'signup' THEN 'REJECT' END AS reviewer_action,
              CASE WHEN test_code = 'view' THEN CAST(1.5 AS DOUBLE) END AS corrected_value,
              CASE WHEN test_code = 'view' AND exam_date IS NOT NULL THEN 'ms' END AS corrected_unit,
              CASE WHEN test_code IN ('click', 'view', 'signup') THEN 'reviewer-1' END AS reviewer_tech_id,
              CASE WHEN test_code IN ('click', 'view', 'signup') THEN TIMESTAMP '2024-02-01 00:00:00' END AS reviewer_decided_at
            FROM found f LEFT JOIN answers a ON a.finding_id = f.finding_id))""",
    ),
    "queue": (
        ["queued"],
        """SELECT *, CASE reviewer_action WHEN 'CONFIRM' THEN 'CONFIRMED' WHEN 'CORRECT' THEN 'CORRECTED' WHEN 'REJECT' THEN 'REJECTED'
            ELSE CASE WHEN NOT has_classifier THEN 'AWAITING_CLASSIFIER' WHEN needs_review_final THEN 'HUMAN_REVIEW_REQUIRED'
              ELSE 'AI_REVIEW_READY' END END AS finding_state,
          CAST(CASE priority_final WHEN 'alta' THEN 1 WHEN 'media' THEN 2 ELSE 3 END AS INTEGER) AS priority_rank
        FROM queued""",
    ),
    "docs": (
        ["e"],
        """SELECT case_id, sum(n) AS n_documents, sha256(string_agg(h, ',' ORDER BY h)) AS input_hash
        FROM (SELECT 'C' || user_id AS case_id, sha256(event_type || '|' || k) AS h, count(*) AS n FROM e GROUP BY ALL)
        GROUP BY case_id""",
    ),
    "per_case": (
        ["queue"],
        f"""SELECT case_id, count(*) AS n_findings, count(*) FILTER (NOT has_classifier) AS n_pending,
            count(*) FILTER (needs_review_final AND reviewer_action IS NULL) AS n_human,
            count(*) FILTER (reviewer_action = 'CORRECT') AS n_corrected,
            coalesce(string_agg(DISTINCT classifier_model, ','), '') AS models,
            sha256(string_agg({ANALYSIS}, chr(10) ORDER BY {ANALYSIS})) AS analysis_hash,
            coalesce(string_agg({DECISION}, chr(10) ORDER BY {DECISION}) FILTER (reviewer_action IS NOT NULL), '') AS decided
        FROM queue GROUP BY case_id""",
    ),
    "payload": (
        ["known", "docs", "per_case"],
        """SELECT review_id, case_id, input_hash, analysis_hash,
            sha256(analysis_hash || '|' || decided || '|' || coalesce(signer, '') || '|'
              || coalesce(CAST(epoch_us(signed) AS VARCHAR), '')) AS reviewed_hash,
            'review-wf-1.0.0' AS workflow_version,
            'extract-rules-1.1.0+' || CASE models WHEN '' THEN 'no-classifier' ELSE models END AS model_version,
            CASE WHEN n_corrected > 0 THEN 'CORRECTED' ELSE 'CONFIRMED' END AS target_status,
            signer AS reviewer_tech_id, signed AS signoff_at, CAST(n_documents AS BIGINT) AS n_documents, n_findings,
            n_pending AS n_classifier_pending, n_human AS n_pending_human,
            n_pending = 0 AND n_human = 0 AND signed IS NOT NULL AS ready_for_attestation
        FROM (SELECT k.*, d.* EXCLUDE (case_id), coalesce(n_findings, 0) AS n_findings, coalesce(n_pending, 0) AS n_pending,
            coalesce(n_human, 0) AS n_human, coalesce(n_corrected, 0) AS n_corrected, coalesce(models, '') AS models,
            coalesce(analysis_hash, sha256('')) AS analysis_hash, coalesce(decided, '') AS decided,
            CASE WHEN created_at < TIMESTAMP '2024-01-02' THEN 'reviewer-2' END AS signer,
            CASE WHEN created_at < TIMESTAMP '2024-01-02' THEN last_seen + INTERVAL 72 HOUR END AS signed
          FROM known k JOIN docs d USING (case_id) LEFT JOIN per_case p USING (case_id))""",
    ),
    "status": (
        ["payload", "known"],
        """SELECT *, CASE WHEN onchain_status = 'VERIFIED' THEN 'ATTESTED' WHEN n_documents = 0 THEN 'CREATED'
            WHEN n_classifier_pending > 0 THEN 'PROCESSING' WHEN n_pending_human > 0 THEN 'HUMAN_REVIEW_REQUIRED'
            WHEN signoff_at IS NULL THEN 'AI_REVIEW_READY' ELSE target_status END AS review_state,
          onchain_status = 'VERIFIED' AS is_finalized
        FROM (SELECT p.case_id, p.review_id, 'benchmark' AS scenario, created_at, input_hash, analysis_hash, reviewed_hash,
            target_status, signoff_at, ready_for_attestation, n_documents, n_findings, n_classifier_pending, n_pending_human,
            CASE WHEN sent THEN 'tx-' || p.review_id END AS tx_signature, CASE WHEN sent THEN 'pda-' || p.review_id END AS pda_address,
            CASE WHEN sent THEN 'devnet' END AS cluster, CASE WHEN sent THEN signoff_at + INTERVAL 5 MINUTE END AS submitted_at,
            CASE WHEN read THEN signoff_at + INTERVAL 9 MINUTE END AS verified_at,
            CASE WHEN read THEN CAST(7 AS BIGINT) END AS slot, CAST(NULL AS VARCHAR) AS verification_error,
            CASE WHEN NOT sent THEN 'NOT_SUBMITTED' WHEN NOT read OR o_orderpriority = '4-NOT SPECIFIED' THEN 'SUBMITTED'
              WHEN o_orderpriority = '3-MEDIUM' THEN 'VERIFICATION_FAILED'
              WHEN o_orderpriority = '2-HIGH' THEN 'HASH_MISMATCH' ELSE 'VERIFIED' END AS onchain_status
          FROM (SELECT p.*, k.created_at, o_orderpriority, signoff_at IS NOT NULL AS sent,
              signoff_at IS NOT NULL AND coalesce(o_orderpriority <> '5-LOW', false) AS read
            FROM payload p JOIN known k USING (case_id) LEFT JOIN orders ON o_orderkey = user_id) p)""",
    ),
    "wanted": (
        ["m"],
        """SELECT 'OUT_OF_DOCUMENT_RANGE' AS finding_type, 'ABOVE_DOCUMENT_RANGE' AS finding_subtype, case_id, test_code,
            exam_date, max(page_num) AS expected_page
        FROM m WHERE value > 90 AND exam_date IS NOT NULL GROUP BY ALL""",
    ),
    "outcomes": (
        ["wanted", "placed"],
        f"""SELECT {", ".join(f"coalesce(w.{c}, f.{c}) AS {c}" for c in KEY)}, f.n_findings, w.expected_page,
            CASE WHEN w.case_id IS NULL THEN 'EXTRA' WHEN f.case_id IS NULL THEN 'MISSED' ELSE 'MATCHED' END AS outcome,
            CASE WHEN f.case_id IS NOT NULL THEN list_contains(f.pages, w.expected_page) END AS source_page_matches
        FROM wanted w FULL JOIN (
            SELECT {KEYS}, count(DISTINCT own) AS n_findings, list(DISTINCT page_num) AS pages FROM placed
            WHERE case_id IN (SELECT case_id FROM wanted) GROUP BY {KEYS}) f ON {same("w", "f", KEY)}""",
    ),
    "metrics": (
        ["status", "m", "queue", "outcomes"],
        """SELECT s.case_id, s.review_id, scenario, review_state, onchain_status, 600 AS manual_review_seconds_baseline,
            n_pages, n_measurements, n_out_of_range, n_temporal_variation, n_conflicts, n_gaps, n_confirmed, n_corrected, n_rejected,
            CASE WHEN n_decided > 0 THEN round(n_confirmed / n_decided, 3) END AS confirm_rate,
            CASE WHEN n_decided > 0 THEN round(n_corrected / n_decided, 3) END AS correct_rate,
            CASE WHEN n_decided > 0 THEN round(n_rejected / n_decided, 3) END AS reject_rate,
            CASE WHEN n_expected > 0 THEN round(n_matched / n_expected, 3) END AS finding_coverage,
            n_extra AS findings_not_expected,
            CASE WHEN n_checked > 0 THEN round(n_ok / n_checked, 3) END AS source_precision,
            date_sub('second', first_in, first_out) AS first_response_latency_s,
            date_sub('second', first_in, signoff_at) AS review_seconds,
            date_sub('second', signoff_at, submitted_at) AS review_to_attestation_s,
            date_sub('second', first_in, verified_at) AS total_flow_s, onchain_status = 'VERIFIED' AS attestation_verified
        FROM status s
        LEFT JOIN (SELECT case_id, count(*) AS n_measurements, count(DISTINCT (document_id, page_num)) AS n_pages,
            min(ingested_at) AS first_in, min(processed_at) AS first_out FROM m GROUP BY 1) x USING (case_id)
        LEFT JOIN (SELECT case_id, count(*) FILTER (finding_type = 'OUT_OF_DOCUMENT_RANGE') AS n_out_of_range,
            count(*) FILTER (finding_type = 'TEMPORAL_VARIATION') AS n_temporal_variation,
            count(*) FILTER (finding_type = 'CONFLICT') AS n_conflicts, count(*) FILTER (finding_type = 'GAP') AS n_gaps,
            count(*) FILTER (reviewer_action = 'CONFIRM') AS n_confirmed, count(*) FILTER (reviewer_action = 'CORRECT') AS n_corrected,
            count(*) FILTER (reviewer_action = 'REJECT') AS n_rejected, count(reviewer_action) AS n_decided FROM queue GROUP BY 1) y USING (case_id)
        LEFT JOIN (SELECT case_id, count(*) FILTER (outcome <> 'EXTRA') AS n_expected, count(*) FILTER (outcome = 'MATCHED') AS n_matched,
            count(*) FILTER (outcome = 'EXTRA') AS n_extra, count(*) FILTER (source_page_matches) AS n_ok,
            count(source_page_matches) AS n_checked FROM outcomes GROUP BY 1) z USING (case_id)""",
    ),
    "page_rows": (
        [],
        """SELECT source AS case_id, 'doc' || doc_id AS document_id, n_chars, text,
            unnest(string_split(text, chr(10))) AS page, generate_subscripts(string_split(text, chr(10)), 1) AS page_num
        FROM documents""",
    ),
    "sheets": (
        ["e"],
        """SELECT *, '  Data da coleta: ' || day AS day_line, ' ' || result AS result_line FROM (SELECT *,
            CASE WHEN k % 17 = 0 THEN '31/02/2024' ELSE strftime(ts, '%d/%m/%Y') END AS day,
            CASE event_type WHEN 'click' THEN 'Creatinina' WHEN 'view' THEN 'Potássio' WHEN 'purchase' THEN 'GLICOSE'
              WHEN 'signup' THEN 'Ferritina' END AS name,
            replace(CAST(value AS VARCHAR), '.', ',') AS number,
            CASE k % 23 WHEN 0 THEN 'ilegível' WHEN 1 THEN 'N/D' WHEN 2 THEN '< ' || number ELSE number END AS shown,
            CASE WHEN k % 11 = 0 THEN '' ELSE ' mg/dL' END || CASE WHEN k % 13 = 0 THEN '' ELSE ' (VR: 1,0 - 100,0)' END AS tail,
            name || ': ' || shown || tail AS result
          FROM e WHERE event_type <> 'error') WHERE NOT (event_type = 'signup' AND k % 23 = 2)""",
    ),
    "records": (
        [],
        """SELECT *, 'rev-' || o_orderkey AS review_id, 'pda-' || o_orderkey AS pda_address, 'tx-' || o_orderkey AS tx_signature,
            o_totalprice < 20000 AS short, o_orderpriority = '5-LOW' AS gone FROM orders""",
    ),
    "readings": (
        ["records"],
        """SELECT *, CASE WHEN gone THEN 'PDA não encontrada' WHEN o_orderstatus = 'P' THEN 'owner inesperado: other'
            WHEN short THEN 'record has 100 bytes, expected at least 242' END AS error FROM records""",
    ),
}

FOUND_SHOWN = ["finding_id", "review_id", *KEY, "summary", "n_evidence"]
QUEUE_SHOWN = """finding_id, finding_type, finding_subtype, test_code, exam_date, {extra}classifier_status, classifier_needs_review,
  classifier_priority, classifier_is_clear, classifier_model, classifier_prompt_version, needs_review_final, review_reasons,
  priority_final, priority_reason, safety_flags, finding_state, reviewer_action, corrected_value, corrected_unit"""


def latest(table: str, keys: str, sequence: str, columns: str = "*") -> str:
    return f"SELECT {columns} FROM {table} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {sequence} DESC) = 1"


REVIEWER_EVENTS = """SELECT *, coalesce(scope = 'FINDING' AND raw_id IS NOT NULL AND action IN ('CONFIRM', 'CORRECT', 'REJECT'), false)
    OR (scope = 'REVIEW' AND action = 'SIGNOFF') AS scope_ok, action <> 'CORRECT' OR corrected_value IS NOT NULL AS value_ok
  FROM (SELECT event_id, 'R' || user_id AS review_id, CASE event_type WHEN 'signup' THEN 'REVIEW' WHEN 'error' THEN 'PAGE' ELSE 'FINDING' END AS scope,
    CASE WHEN value > 5 THEN 'f' || k END AS raw_id,
    CASE event_type WHEN 'signup' THEN '__REVIEW__' ELSE CASE WHEN value > 5 THEN 'f' || k END END AS finding_id,
    CASE event_type WHEN 'signup' THEN 'SIGNOFF' WHEN 'view' THEN 'CORRECT' ELSE 'CONFIRM' END AS action,
    CASE WHEN value > 50 THEN value END AS corrected_value, CAST(NULL AS VARCHAR) AS corrected_unit,
    'reviewer-1' AS reviewer_tech_id, ts AS decided_at FROM e)"""
BLOCKS["reviewer_events"] = (["e"], REVIEWER_EVENTS)


def report(source: str, rules: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) AS n_rows, count(*) FILTER ({rule}) AS n_passed, "
        f"count(*) - count(*) FILTER ({rule}) AS n_failed FROM {source}"
        for name, rule in rules
    )


CPF = r"\b\d{3}\.?\d{3}\.?\d{3}-?\d{2}\b"
CNS = r"\b\d{3}\s?\d{4}\s?\d{4}\s?\d{4}\b"
EMAIL = r"\b[\w.+-]+@[\w-]+\.[\w.-]+\b"
PHONE = r"(?:\(\d{2}\)\s?)?\b9?\d{4}-\d{4}\b"


def starred(text: str, pattern: str) -> str:
    """Every match with its visible characters hidden, rebuilt from pieces and matches."""
    pieces = f"string_split_regex({text}, {q(pattern)})"
    hits = f"list_transform(regexp_extract_all({text}, {q(pattern)}), lambda h: regexp_replace(h, '[^\\s.\\-/()]', '*', 'g'))"
    return (
        f"array_to_string(list_transform(list_zip({pieces}, {hits}), lambda z: z[1] || coalesce(z[2], '')), '')"
    )


def masked_sql() -> str:
    step, source = "text", "documents"
    for i, pattern in enumerate([CPF, CNS, EMAIL, PHONE, D.US_PHONE]):
        source = f"(SELECT doc_id, {starred(step, pattern)} AS t{i} FROM {source})"
        step = f"t{i}"
    return f"SELECT doc_id, md5({step}) AS masked_md5 FROM {source}"


RESULTS = with_ctes(
    ["sheets"],
    """SELECT case_id, document_id, page_num, ts AS ingested_at, line_no, char_start,
      CAST(char_start + length(result) AS INTEGER) AS char_end, result AS source_text,
      CASE WHEN k % 17 <> 0 THEN CAST(ts AS DATE) END AS exam_date, 'Data da coleta: ' || day AS date_source_text,
      name AS test_name_raw,
      CASE event_type WHEN 'click' THEN 'CREA' WHEN 'view' THEN 'K' WHEN 'purchase' THEN 'GLU' ELSE 'UNK_FERRITINA' END AS test_code,
      event_type <> 'signup' AS test_known, CASE WHEN vague THEN shown || tail ELSE shown END AS value_raw,
      CASE WHEN k % 23 > 2 THEN value END AS value,
      CASE k % 23 WHEN 0 THEN 'ILLEGIBLE' WHEN 1 THEN 'MISSING' WHEN 2 THEN 'AMBIGUOUS' ELSE 'OK' END AS value_status,
      CASE WHEN NOT vague AND k % 11 <> 0 THEN 'mg/dL' END AS unit,
      CASE WHEN NOT vague AND k % 13 <> 0 THEN CAST(1 AS DOUBLE) END AS ref_low,
      CASE WHEN NOT vague AND k % 13 <> 0 THEN CAST(100 AS DOUBLE) END AS ref_high,
      'extract-rules-1.1.0' AS extractor_version, sha256(document_id || '|1|' || char_start) AS measurement_id
    FROM (SELECT *, 'C' || user_id AS case_id, 'E' || event_id AS document_id, CAST(1 AS INTEGER) AS page_num,
      CAST(5 AS INTEGER) AS line_no, k % 23 = 2 AS vague,
      CAST(length('LAUDO ' || event_id || 'xMédico solicitante: Dr. ' || user_id || 'xx' || day_line || 'xx') + 1 AS INTEGER) AS char_start
      FROM sheets)""",
)

ORACLES: dict[str, str] = {
    "timeline": with_ctes(
        ["m"],
        """SELECT case_id, exam_date, CAST(CASE WHEN exam_date IS NOT NULL
            THEN dense_rank() OVER (PARTITION BY case_id ORDER BY exam_date NULLS FIRST) END AS INTEGER) AS timeline_position,
          test_code, test_name_raw, value_raw, value, unit, ref_low, ref_high, value_status, document_id, page_num, line_no,
          char_start, char_end, source_text, date_source_text, measurement_id FROM m""",
    ),
    "temporal_comparison": with_ctes(
        ["compared"],
        """SELECT case_id, test_code, test_name_raw, previous_date, exam_date,
          CAST(date_diff('day', previous_date, exam_date) AS INTEGER) AS days_between, previous_value, value, previous_unit, unit,
          delta_abs, delta_pct, direction, n + previous_n AS n_evidence FROM compared""",
    ),
    "conflicts": with_ctes(
        ["days", "stated_text", "usable"],
        """SELECT d.case_id, d.test_code, d.exam_date, d.test_name_raw, n_versions, n AS n_evidence, CAST(0 AS INTEGER) AS chunk_no,
          versions, (SELECT string_agg(concat_ws(':', document_id, page_num, char_start), ',' ORDER BY concat_ws(':', document_id, page_num, char_start))
            FROM usable u WHERE u.case_id = d.case_id AND u.test_code = d.test_code AND u.exam_date = d.exam_date) AS evidence
        FROM days d JOIN stated_text s ON d.case_id = s.case_id AND d.test_code = s.test_code AND d.exam_date = s.exam_date""",
    ),
    "conflict_evidence": with_ctes(
        ["days", "usable"],
        """SELECT case_id, test_code, exam_date, exam_date AS evidence_date, document_id, page_num, line_no, char_start, char_end,
          source_text, value_raw, unit FROM usable u
        WHERE (SELECT n_versions FROM days d WHERE d.case_id = u.case_id AND d.test_code = u.test_code AND d.exam_date = u.exam_date) > 1""",
    ),
    "comparison_evidence": with_ctes(
        ["compared", "usable"],
        """SELECT c.case_id, c.test_code, c.exam_date, u.exam_date AS evidence_date, document_id, page_num, line_no, char_start, char_end,
          source_text, value_raw, u.unit
        FROM compared c JOIN usable u ON u.case_id = c.case_id AND u.test_code = c.test_code AND u.exam_date IN (c.previous_date, c.exam_date)""",
    ),
    "measurement_gaps": with_ctes(
        ["gap_rows"],
        """SELECT case_id, gap_type, test_code, exam_date, document_id, page_num, description,
          concat_ws(':', document_id, page_num, char_start) AS evidence FROM gap_rows""",
    ),
    "document_gaps": with_ctes(
        ["page_rows"],
        f"""SELECT case_id, gap_type, CAST(NULL AS VARCHAR) AS test_code, CAST(NULL AS DATE) AS exam_date, document_id,
          CAST(page_num AS INTEGER) AS page_num, CASE gap_type {DOC_GAP_TEXT} END AS description, document_id || ':' || page_num AS evidence
        FROM (SELECT *, CASE WHEN n_chars < 100 THEN 'DOCUMENT_UNREADABLE' WHEN NOT contains({folded('text')}, 'ment') THEN 'NOT_SYNTHETIC_DOCUMENT'
            WHEN length(trim(page, ' ')) = 0 THEN 'NON_TEXTUAL_PAGE' END AS gap_type FROM page_rows)
        WHERE gap_type = 'NON_TEXTUAL_PAGE' OR (gap_type IS NOT NULL AND page_num = 1)""",
    ),
    "out_of_range": with_ctes(
        ["found"],
        f"SELECT finding_id, {KEYS}, summary, evidence FROM found WHERE finding_type = 'OUT_OF_DOCUMENT_RANGE'",
    ),
    "findings_all": with_ctes(
        ["found"], f"SELECT {', '.join(FOUND_SHOWN)}, CAST(0 AS INTEGER) AS chunk_no, evidence FROM found"
    ),
    "finding_evidence": with_ctes(
        ["found", "placed"],
        f"""SELECT finding_id, document_id, page_num, line_no, char_start, char_end, source_text
        FROM placed p JOIN found f ON {same("p", "f", [*KEY, "summary"])} AND (own = '' OR own = f.evidence)""",
    ),
    "latest_state_events": latest("events", "user_id, event_type", "ts"),
    "latest_state_conversations": latest("conversations", "conv_id, role", "turn"),
    "latest_state_stream": latest("events", "user_id, event_type", "ts"),
    "latest_state_many_batches": latest("events", "user_id, event_type", "ts"),
    "review_decisions_latest": with_ctes(
        ["reviewer_events"],
        latest(
            "(SELECT * FROM reviewer_events WHERE scope_ok AND value_ok)", "review_id, finding_id", "decided_at",
            "review_id, scope, finding_id, action, corrected_value, corrected_unit, reviewer_tech_id, decided_at",
        ),
    ),
    # a rule on the normalised finding id: review-level events carry the fixed key
    "review_decision_expectations": with_ctes(
        ["reviewer_events"],
        report("reviewer_events", [("has_keys", "true"), ("valid_scope_action", "scope_ok"), ("correction_has_value", "value_ok")]),
    ),
    "expectation_report": report(
        "lineitem",
        [("positive_quantity", "l_quantity > 0"), ("small_discount", "l_discount <= 0.05"),
         ("returned_is_closed", "l_returnflag <> 'R' OR l_linestatus = 'F'")],
    ),
    "expect_or_fail": "SELECT o_orderstatus, count(*) AS n_orders FROM orders GROUP BY 1",
    "contract_validation": r"""SELECT page_id, case_id, concat_ws(',',
        CASE WHEN NOT regexp_matches(case_id, '^[A-Za-z0-9][A-Za-z0-9_.-]{0,127}$') THEN 'case_id' END,
        CASE WHEN NOT regexp_matches(review_id, '^[A-Za-z0-9][A-Za-z0-9_.-]{0,127}$') THEN 'review_id' END,
        CASE WHEN length(html) % 2 = 1 THEN 'data_classification' END,
        CASE WHEN NOT regexp_matches(scenario, '^[A-Za-z0-9][A-Za-z0-9_.-]{0,127}$') THEN 'scenario' END,
        CASE WHEN length(html) < 2000 THEN 'baseline' END) AS violations
      FROM (SELECT *, regexp_extract(url, '^https?://([^/]+)', 1) AS case_id, regexp_extract(url, '^https?://[^/]+/(.*)$', 1) AS review_id,
        regexp_extract(url, '\.com/([a-z]*)', 1) AS scenario FROM pages)""",
    "upload_gate": f"""SELECT d.doc_id, CAST(strlen(text) AS BIGINT) AS size_bytes, CAST(CASE WHEN strlen(text) > 8000 THEN 413 WHEN lang = 'de' THEN 415
        WHEN NOT contains({folded('text')}, 'tion') THEN 422 WHEN l.doc_id IS NOT NULL THEN 409 ELSE 201 END AS INTEGER) AS outcome
      FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id""",
    # one value per kind of line; the text of a broken line is written out
    "rescued_feed": r"""SELECT CASE WHEN whole THEN event_id END AS event_id, CASE WHEN whole THEN user_id END AS user_id,
        CASE WHEN whole THEN event_type END AS event_type, CASE WHEN event_type IN ('view', 'purchase') THEN value END AS value,
        CASE event_type WHEN 'error' THEN '{"value":"n/a"}' WHEN 'view' THEN '{"extra":"x"}'
          WHEN 'click' THEN '{"value":"' || CAST(value AS VARCHAR) || '"}'
          WHEN 'signup' THEN '{"_corrupt_record":"#{\"event_id\":' || event_id || ',\"user_id\":' || user_id
            || ',\"event_type\":\"signup\",\"value\":' || CAST(value AS VARCHAR) || '}"}' END AS _rescued_data,
        event_id AS source_id
      FROM (SELECT *, event_type <> 'signup' AS whole FROM events)""",
    "table_export": """SELECT '{"r_name":"' || r_name || '","n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","note":null}' AS value
      FROM region LEFT JOIN nation ON n_regionkey = r_regionkey""",
    "unseen_contents": """SELECT DISTINCT sha256(text) AS content_hash FROM documents
      WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))""",
    "line_offsets": """SELECT doc_id, CAST(n AS INTEGER) AS line_no, CAST(coalesce(sum(length(line)) OVER before, 0) AS INTEGER) AS char_start,
        CAST(coalesce(sum(length(line)) OVER before, 0) + length(line) AS INTEGER) AS char_end, md5(line) AS line_md5
      FROM (SELECT doc_id, n, CASE WHEN n < total THEN piece || chr(10) ELSE piece END AS line FROM (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS piece, generate_subscripts(string_split(text, chr(10)), 1) AS n,
          len(string_split(text, chr(10))) AS total FROM documents))
      WHERE line <> '' WINDOW before AS (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "mask_identifiers": masked_sql(),
    "mask_labelled_identifiers": r"""SELECT conv_id, turn, md5('Data' || chr(10) || CASE WHEN role = 'user'
        THEN '  Médico solicitante : ' || regexp_replace(string_split(text, chr(10))[1], '\S', '*', 'g') || substring(text, length(string_split(text, chr(10))[1]) + 1)
        ELSE 'Observação: ' || text END) AS masked_md5 FROM conversations""",
    "declaration_gate": with_ctes(
        ["page_rows"],
        f"""SELECT case_id, document_id, CAST(page_num AS INTEGER) AS page_num, declared AS synthetic_declared,
          declared AND length(trim(page, ' ')) > 0 AS is_textual, CASE WHEN declared THEN md5(page) END AS page_md5
        FROM (SELECT *, contains({folded('text')}, 'tion') AS declared FROM page_rows)""",
    ),
    "declared_documents": f"SELECT conv_id, bool_or(contains({folded('text')}, 'tion')) AS synthetic_declared FROM conversations GROUP BY 1",
    "test_codes": """SELECT p_partkey, CASE WHEN p_name = 'red widget' AND p_type = 'ECONOMY' THEN 'RWE'
        ELSE 'UNK_' || replace(upper(p_name), ' ', '_') || '_A_' || p_type END AS test_code,
        p_name = 'red widget' AND p_type = 'ECONOMY' AS test_known FROM part""",
    "extract_measurements": RESULTS,
    "evidence_check": with_ctes(
        ["sheets"],
        "SELECT 'C' || user_id AS case_id, count(*) AS n_measurements, CAST(0 AS BIGINT) AS n_misplaced FROM sheets GROUP BY 1",
    ),
    "review_queue": with_ctes(["queue"], "SELECT * EXCLUDE (summary, n_evidence, evidence, forced, lifted) FROM queue"),
    "classify_findings": with_ctes(
        ["answers"],
        f"""SELECT finding_id, needs_review, priority, is_clear,
          sha256('{D.QUESTIONS}|{D.MODEL}|' || context) AS classifier_request_hash, raw_answers AS classifier_raw_answers,
          valid AS classifier_response_valid FROM answers""",
    ),
    "due_for_classification": with_ctes(
        ["queue", "status"], "SELECT finding_id, review_id FROM queue WHERE review_id IN (SELECT review_id FROM status WHERE NOT is_finalized)"
    ),
    "answer_normalisation": with_ctes(
        ["e"],
        """SELECT event_id, CASE WHEN k % 10 < 3 THEN true WHEN k % 10 < 7 THEN false END AS flag,
          CASE k % 10 WHEN 8 THEN 'media' WHEN 9 THEN 'alta' END AS priority FROM e""",
    ),
    "document_set": with_ctes(["docs"], "SELECT case_id, CAST(n_documents AS BIGINT) AS n_documents, input_hash FROM docs"),
    "attestation_payload": with_ctes(["payload"], "SELECT * FROM payload"),
    "review_status": with_ctes(["status"], "SELECT * FROM status"),
    "expected_vs_found": with_ctes(["outcomes"], "SELECT * FROM outcomes"),
    "outcome_histogram": with_ctes(["outcomes"], "SELECT outcome, count(*) AS n FROM outcomes GROUP BY 1"),
    "found_ids": with_ctes(
        ["found"],
        f"SELECT {KEYS}, finding_id, count(*) OVER (PARTITION BY {KEYS}) AS n_findings FROM found",
    ),
    "outcome_ids": with_ctes(
        ["outcomes", "found"],
        f"""SELECT {", ".join(f"f.{c}" for c in KEY)}, f.finding_id, o.outcome FROM found f JOIN outcomes o ON {same("f", "o", KEY)}""",
    ),
    "review_metrics": with_ctes(["metrics"], "SELECT * FROM metrics"),
    "decode_records": with_ctes(
        ["records"],
        """SELECT o_orderkey, CASE WHEN NOT (gone OR short) THEN sha256(review_id) END AS review_id_hash,
          CASE WHEN NOT (gone OR short) THEN sha256('in' || o_orderkey) END AS input_hash, CASE WHEN NOT (gone OR short) THEN sha256('an' || o_orderkey) END AS analysis_hash,
          CASE WHEN NOT (gone OR short) THEN sha256('rv' || o_orderkey) END AS reviewed_hash, CASE WHEN NOT (gone OR short) THEN 'review-wf-1.0.0' END AS workflow_version,
          CASE WHEN NOT (gone OR short) THEN 'extract+' || o_orderpriority END AS model_version,
          CASE WHEN NOT (gone OR short) THEN CASE length(o_orderpriority) WHEN 5 THEN 'CORRECTED' WHEN 6 THEN 'ATTESTED' ELSE 'UNKNOWN_' || length(o_orderpriority) END END AS status,
          CASE WHEN NOT (gone OR short) THEN CAST(epoch(o_orderdate) AS BIGINT) END AS attested_at,
          CASE WHEN gone THEN 'record has 0 bytes, expected at least 242' WHEN short THEN 'record has 100 bytes, expected at least 242' END AS error FROM records""",
    ),
    "verify_accounts": with_ctes(
        ["readings"],
        """SELECT review_id, pda_address, tx_signature, error IS NULL AS account_found, o_orderstatus = 'F' AS tx_confirmed,
          CASE WHEN error IS NULL THEN sha256('in' || o_orderkey) END AS onchain_input_hash,
          CASE WHEN error IS NULL THEN sha256('an' || o_orderkey) END AS onchain_analysis_hash,
          CASE WHEN error IS NULL THEN sha256('rv' || o_orderkey) END AS onchain_reviewed_hash,
          CASE WHEN error IS NULL THEN CASE length(o_orderpriority) WHEN 5 THEN 'CORRECTED' WHEN 6 THEN 'ATTESTED' ELSE 'UNKNOWN_' || length(o_orderpriority) END END AS onchain_status,
          CAST(7 AS BIGINT) AS slot, error FROM readings""",
    ),
    "due_for_verification": with_ctes(
        ["readings"], "SELECT review_id, pda_address, tx_signature FROM readings WHERE error IS NOT NULL OR o_orderstatus <> 'F'"
    ),
    "test_cluster_hosts": "SELECT page_id, page_id % 2 = 0 AS accepted FROM pages",
    "policy_masked_findings": with_ctes(
        ["found", "ranged"],
        """SELECT finding_id, document_id, page_num, line_no, char_start, char_end, '[restrito]' AS source_text
        FROM ranged r JOIN found f ON f.finding_type = 'OUT_OF_DOCUMENT_RANGE' AND f.evidence = concat_ws(':', document_id, page_num, char_start)""",
    ),
    "policy_masked_documents": "SELECT doc_id, md5(text) AS content_md5, CASE WHEN text = '' THEN '' ELSE '[restrito]' END AS page_text FROM documents",
    "secret_scan": " UNION ALL ".join(
        f"SELECT doc_id, {q(kind)} AS kind FROM documents WHERE regexp_matches(text, {q(pattern)})"
        for kind, pattern in [
            ("signing_key_block", "-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
            ("cloud_access_key", r"\b(?:AKIA|ASIA)[A-Z2-7]{16}\b"),
            ("web_token", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
            ("token_literal", r"token\s*=\s*\"[0-9a-f]{16,}"),
        ]
    ),
    "claim_scan": r"""SELECT doc_id, CAST(n AS INTEGER) AS line_no, claim FROM (
        SELECT doc_id, n, claims[i] AS claim, i, list_sum(list_transform(pieces[1:i], lambda p: length(p)))
            + coalesce(list_sum(list_transform(claims[1:i - 1], lambda c: length(c))), 0) AS start, line
        FROM (SELECT *, unnest(generate_series(1, len(claims))) AS i FROM (
          SELECT doc_id, n, line, regexp_extract_all(line, '(?i)tionment|mention|ention ') AS claims,
            string_split_regex(line, '(?i)tionment|mention|ention ') AS pieces
          FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents))))
      WHERE NOT regexp_matches(substring(line, 1, CAST(start AS BIGINT)), ' (?:non|un|the) ')""",
    "residual_identifiers": " UNION ALL ".join(
        f"SELECT 'text' AS column_name, '{kind}' AS kind, count(*) FILTER (regexp_matches(text, {q(pattern)})) AS n_texts FROM documents"
        for kind, pattern in [("cpf", CPF), ("email", EMAIL), ("us_phone", D.US_PHONE)]
    ),
    "serve_case_list": with_ctes(
        ["status"],
        """SELECT case_id, review_id, scenario, review_state, onchain_status, is_finalized, n_documents, n_findings,
          n_pending_human, tx_signature, submitted_at, verified_at FROM status ORDER BY created_at DESC""",
    ),
    "serve_queue": with_ctes(
        ["queue"], f"SELECT {QUEUE_SHOWN.format(extra='summary, ')} FROM queue ORDER BY priority_rank, finding_type, exam_date NULLS FIRST"
    ),
    "serve_sources": with_ctes(["ranged"], "SELECT document_id, page_num, line_no, char_start, char_end, source_text FROM ranged"),
    "serve_pages": with_ctes(
        ["page_rows"], f"SELECT CASE WHEN contains({folded('text')}, 'tion') THEN page END AS page_text FROM page_rows"
    ),
    "serve_timeline": with_ctes(
        ["m"],
        """SELECT exam_date, CAST(CASE WHEN exam_date IS NOT NULL
            THEN dense_rank() OVER (PARTITION BY case_id ORDER BY exam_date NULLS FIRST) END AS INTEGER) AS timeline_position,
          test_code, test_name_raw, value_raw, unit, value_status, document_id, page_num, source_text
        FROM m ORDER BY exam_date NULLS LAST, test_code""",
    ),
    "serve_comparison": with_ctes(
        ["compared"],
        """SELECT test_code, test_name_raw, previous_date, exam_date, previous_value, value, unit, delta_abs, delta_pct, direction
        FROM compared ORDER BY test_code, exam_date""",
    ),
    "serve_payload": with_ctes(
        ["payload"],
        """SELECT review_id, input_hash, analysis_hash, reviewed_hash, workflow_version, model_version, target_status,
          reviewer_tech_id, signoff_at, ready_for_attestation FROM payload""",
    ),
    "serve_metrics": with_ctes(["metrics"], "SELECT * FROM metrics ORDER BY case_id"),
}
# tables brought up to date batch by batch hold what a full build holds
ORACLES["refreshed_timeline"] = ORACLES["timeline"]
ORACLES["refreshed_comparison"] = ORACLES["temporal_comparison"]

# --- feeds: every event is a line; a line cut off has no values at all
_USER_HASH = "sha256('{0}' || user_id)"
_FEED_ROWS = {
    "cases": """SELECT CASE WHEN k % 31 <> 0 THEN 'C' || user_id END AS case_id, 'R' || user_id AS review_id,
        CASE WHEN k % 7 = 0 THEN 'REAL' ELSE 'SYNTHETIC' END AS data_classification, event_type AS scenario, ts AS created_at,
        CASE WHEN k % 19 <> 0 THEN CAST(k AS INTEGER) END AS manual_review_seconds_baseline""",
    "classifier_decisions": f"""SELECT 'f-' || user_id || '-' || event_type AS finding_id, 'R' || user_id AS review_id, needs_review,
        priority, value < 50 AS is_clear, 'm1' AS classifier_model, 'q1' AS classifier_prompt_version,
        {_USER_HASH.format("request")} AS classifier_request_hash, '{{}}' AS classifier_raw_answers,
        coalesce(k % 17 <> 0 AND k % 5 <> 0, false) AND priority <> 'urgente' AND needs_review IS NOT NULL AS classifier_response_valid,
        'review-wf-1.0.0' AS workflow_version, CASE WHEN k % 31 <> 0 THEN ts END AS decided_at""",
    "review_decisions": """SELECT 'R' || user_id AS review_id,
        CASE event_type WHEN 'signup' THEN 'REVIEW' WHEN 'error' THEN 'PAGE' ELSE 'FINDING' END AS scope,
        CASE WHEN event_type = 'signup' THEN '__REVIEW__' WHEN value > 5 THEN 'f' || k END AS finding_id,
        CASE event_type WHEN 'signup' THEN 'SIGNOFF' WHEN 'view' THEN 'CORRECT' ELSE 'CONFIRM' END AS action,
        CASE WHEN value > 50 THEN value END AS corrected_value, CAST(NULL AS VARCHAR) AS corrected_unit,
        'reviewer-1' AS reviewer_tech_id, CASE WHEN k % 31 <> 0 THEN ts END AS decided_at""",
    "attestations": f"""SELECT 'R' || user_id AS review_id, CASE WHEN k % 11 = 0 THEN 'mainnet' ELSE 'devnet' END AS cluster,
        'program' AS program_id, 'pda-' || user_id AS pda_address, CASE WHEN k % 23 <> 0 THEN 'tx-' || k END AS tx_signature,
        CASE WHEN k % 41 = 0 THEN '0x' ELSE {_USER_HASH.format("in")} END AS input_hash, {_USER_HASH.format("an")} AS analysis_hash,
        {_USER_HASH.format("rv")} AS reviewed_hash, 'review-wf-1.0.0' AS workflow_version, 'm1' AS model_version,
        'SUBMITTED' AS status, 'reviewer-1' AS reviewer_tech_id, CASE WHEN k % 31 <> 0 THEN ts END AS submitted_at""",
    "attestation_verifications": f"""SELECT 'R' || user_id AS review_id, 'pda-' || user_id AS pda_address, 'tx-' || k AS tx_signature, k % 3 = 0 AS account_found,
        k % 2 = 0 AS tx_confirmed, {_USER_HASH.format("in")} AS onchain_input_hash, {_USER_HASH.format("an")} AS onchain_analysis_hash,
        {_USER_HASH.format("rv")} AS onchain_reviewed_hash, 'ATTESTED' AS onchain_status,
        CASE WHEN k % 19 <> 0 THEN CAST(k AS BIGINT) END AS slot, CASE WHEN k % 5 = 0 THEN 'slow' END AS error,
        CASE WHEN k % 31 <> 0 THEN ts END AS verified_at""",
}
#: conditions of the rules (a row is dropped) and the warnings (it stays), for a line that is whole
_FEED_RULES = {
    "cases": {"has_keys": "case_id IS NOT NULL", "has_ts": "true"},
    "classifier_decisions": {"has_keys": "decided_at IS NOT NULL"},
    "review_decisions": {
        "has_keys": "decided_at IS NOT NULL",
        "valid_scope_action": "scope = 'REVIEW' OR (scope = 'FINDING' AND finding_id IS NOT NULL)",
        "correction_has_value": "action <> 'CORRECT' OR corrected_value IS NOT NULL",
    },
    "attestations": {
        "has_keys": "submitted_at IS NOT NULL", "has_tx": "tx_signature IS NOT NULL", "devnet_only": "cluster = 'devnet'",
        "hashes_are_sha256": "input_hash <> '0x'",
    },
    "attestation_verifications": {"has_keys": "verified_at IS NOT NULL"},
}
_FEED_WARNINGS = {
    "cases": {"declared_synthetic": "data_classification = 'SYNTHETIC'"},
    "classifier_decisions": {"schema_ok": "priority <> 'urgente' AND needs_review IS NOT NULL"},
}
_FEED_KEYS = {
    "cases": ("case_id", "created_at"), "classifier_decisions": ("finding_id", "decided_at"),
    "review_decisions": ("review_id, finding_id", "decided_at"), "attestations": ("review_id", "submitted_at"),
    "attestation_verifications": ("review_id", "verified_at"),
}


def _feed_lines(name: str) -> str:
    answers = """SELECT *, CASE WHEN k % 13 <> 0 THEN value > 20 END AS needs_review,
        CASE k % 4 WHEN 0 THEN 'alta' WHEN 1 THEN 'media' WHEN 2 THEN 'baixa' ELSE 'urgente' END AS priority FROM e"""
    return f"{_FEED_ROWS[name]}, event_id % 29 <> 0 AS whole FROM ({answers})"


def _feed_current(name: str) -> str:
    keys, sequence = _FEED_KEYS[name]
    good = " AND ".join(f"({rule})" for rule in ["whole", *_FEED_RULES[name].values()])
    return with_ctes(["e"], latest(f"(SELECT * FROM ({_feed_lines(name)}) WHERE {good})", keys, sequence, "* EXCLUDE (whole)"))


for _name in _FEED_ROWS:
    ORACLES[f"feed_{_name}"] = _feed_current(_name)
ORACLES["feed_expectations"] = with_ctes(["e"], " UNION ALL ".join(
    f"""SELECT '{feed}' AS source, '{rule}' AS rule, '{action}' AS action, count(*) AS n_rows,
      count(*) FILTER (coalesce(NOT (whole AND ({condition})), true)) AS n_failed FROM ({_feed_lines(feed)})"""
    for action, sets in (("drop", _FEED_RULES), ("warn", _FEED_WARNINGS)) for feed, rules in sets.items() for rule, condition in rules.items()
))
ORACLES["feed_quarantine"] = with_ctes(["e"], " UNION ALL ".join(
    f"""SELECT '{feed}' AS feed, concat_ws(',', {", ".join(
        f"CASE WHEN coalesce(NOT (whole AND ({condition})), true) THEN '{rule}' END" for rule, condition in rules.items()
      )}) AS broken_rules, count(*) AS n_rows FROM ({_feed_lines(feed)}) GROUP BY 2 HAVING broken_rules <> ''"""
    for feed, rules in _FEED_RULES.items()
))


def _tree(part: str, items: str) -> str:
    return f"""SELECT case_id, '{part}' AS part, sha256(string_agg(leaf || h, '' ORDER BY leaf)) AS digest, CAST(sum(n) AS BIGINT) AS n_items
      FROM (SELECT case_id, substr(h, 1, 4) AS leaf, sha256(string_agg(h, '' ORDER BY h)) AS h, count(*) AS n
        FROM (SELECT case_id, sha256(item) AS h FROM ({items})) GROUP BY case_id, substr(h, 1, 4)) GROUP BY case_id"""


ORACLES["case_trees"] = with_ctes(["queue", "e"], " UNION ALL ".join([
    _tree("input", "SELECT DISTINCT 'C' || user_id AS case_id, sha256(event_type || '|' || k) AS item FROM e"),
    _tree("analysis", f"SELECT case_id, {ANALYSIS} AS item FROM queue"),
    _tree("decisions", f"SELECT case_id, {DECISION} AS item FROM queue WHERE reviewer_action IS NOT NULL"),
]))
ORACLES["warning_counts"] = with_ctes(["m", "found", "payload"], """
  SELECT 'measurements' AS source, 'value_present_when_ok' AS rule, 'warn' AS action, count(*) AS n_rows,
    count(*) FILTER (value_status = 'OK' AND value IS NULL) AS n_failed FROM m
  UNION ALL SELECT 'findings', 'registered_case', 'warn', count(*), count(*) FILTER (review_id IS NULL) FROM found
  UNION ALL SELECT 'payload', 'versions_fit_ledger', 'warn', count(*),
    count(*) FILTER (strlen(workflow_version) > 32 OR strlen(model_version) > 32) FROM payload""")
ORACLES["aborted_runs"] = " UNION ALL ".join(
    f"SELECT '{source}' AS source, CASE WHEN bool_and({rule}) THEN 'passed' ELSE 'expectation failed: {name}' END AS outcome FROM {source}"
    for source, name, rule in (
        ("orders", "known_status", "o_orderstatus IN ('F', 'O', 'P')"), ("lineitem", "small_discount", "l_discount <= 0.05"),
        ("documents", "has_words", "coalesce(n_chars > 0, false)"), ("events", "few_seconds", "coalesce(value < 50, false)"),
    )
)


# --- portal: the rows of the smallest value of a key
def _portal(source: str, key: str, columns: str) -> str:
    return with_ctes([source], f"SELECT {columns} FROM {source} WHERE {key} = (SELECT min({key}) FROM {source})")


ORACLES["portal_queue"] = _portal("queue", "case_id", QUEUE_SHOWN.format(extra="summary, "))
ORACLES["portal_timeline"] = _portal("m", "case_id", """exam_date, CAST(CASE WHEN exam_date IS NOT NULL
    THEN dense_rank() OVER (PARTITION BY case_id ORDER BY exam_date NULLS FIRST) END AS INTEGER) AS timeline_position,
    test_code, test_name_raw, value_raw, unit, value_status, document_id, page_num, source_text""")
ORACLES["portal_comparison"] = _portal(
    "compared", "case_id", "test_code, test_name_raw, previous_date, exam_date, previous_value, value, unit, delta_abs, delta_pct, direction"
)
ORACLES["portal_payload"] = _portal("payload", "review_id", """review_id, input_hash, analysis_hash, reviewed_hash, workflow_version,
    model_version, target_status, reviewer_tech_id, signoff_at, ready_for_attestation""")
ORACLES["portal_pages"] = _portal("page_rows", "document_id", f"CASE WHEN contains({folded('text')}, 'tion') THEN page END AS page_text")
ORACLES["portal_sources"] = with_ctes(
    ["found", "placed"],
    f"""SELECT document_id, page_num, line_no, char_start, char_end, source_text
    FROM placed p JOIN found f ON {same("p", "f", [*KEY, "summary"])} AND (own = '' OR own = f.evidence)
    WHERE f.finding_id = (SELECT min(finding_id) FROM found)""",
)

# --- each rule is met and broken by some rows
ORACLES["due_without_answer"] = with_ctes(
    ["queue", "status"],
    "SELECT finding_id, review_id FROM queue WHERE exam_date IS NULL AND review_id IN (SELECT review_id FROM status WHERE NOT is_finalized)",
)
ORACLES["policy_restricted_documents"] = """SELECT doc_id, true AS content_hidden,
    CASE WHEN text = '' THEN '' WHEN text IS NOT NULL THEN '[restrito]' END AS page_text FROM documents"""
ORACLES["mask_functions"] = """SELECT doc_id, CASE WHEN text = '' THEN '' WHEN text IS NOT NULL THEN '[restrito]' END AS hidden, md5(text) AS shown_md5,
    true AS raw_hidden, md5(text) AS raw_md5 FROM documents"""
_NOTES = """SELECT event_id, event_type, lpad(CAST(event_id AS VARCHAR), 9, '0') AS n,
    upper(left(translate(sha256(lpad(CAST(event_id AS VARCHAR), 9, '0')), '0189', 'ABCD'), 16)) AS key FROM events"""
ORACLES["mask_notes"] = f"""SELECT event_id, CASE event_type WHEN 'click' THEN 'CPF ***.***.***-** ok' WHEN 'view' THEN 'cns *** **** **** ****'
    WHEN 'purchase' THEN 'fone (**) *****-****, id ' || key WHEN 'signup' THEN '-----BEGIN RSA PRIVATE KEY----- ' || n
    ELSE 'AKIA' || key || ' eyJ' || key || '.eyJ' || key || '.' || key END AS masked FROM ({_NOTES})"""
ORACLES["residual_notes"] = " UNION ALL ".join(
    f"SELECT '{column}' AS column_name, '{kind}' AS kind, {count} AS n_texts FROM events"
    for column in ("text", "masked")
    for kind, event_type in (("cpf", "click"), ("cns", "view"), ("email", None), ("phone", "purchase"))
    for count in ["count(*) FILTER (event_type = '%s')" % event_type if event_type and column == "text" else "CAST(0 AS BIGINT) * count(*)"]
)
ORACLES["secret_scan_notes"] = """SELECT event_id, unnest(CASE event_type WHEN 'signup' THEN ['signing_key_block']
    ELSE ['cloud_access_key', 'web_token'] END) AS kind FROM events WHERE event_type IN ('signup', 'error')"""
ORACLES["decision_contract"] = with_ctes(["e"], """SELECT event_id, concat_ws(',',
    CASE WHEN k % 29 = 0 THEN 'review_id' END, CASE WHEN scope = 'PAGE' THEN 'scope' END, CASE WHEN k % 5 = 4 THEN 'action' END,
    CASE WHEN k % 7 = 1 THEN 'corrected_unit' END, CASE WHEN k % 37 = 0 THEN 'reviewer_tech_id' END,
    CASE WHEN scope = 'FINDING' AND k % 4 = 0 THEN 'finding_scope_names_finding' END,
    CASE WHEN scope = 'FINDING' AND k % 5 = 3 THEN 'finding_scope_no_signoff' END,
    CASE WHEN scope = 'FINDING' AND k % 5 = 1 AND value <= 20 AND k % 7 > 1 THEN 'correction_has_value' END,
    CASE WHEN scope = 'REVIEW' AND (k % 5 <> 3 OR k % 4 <> 0) THEN 'review_scope_signoff_only' END) AS violations
  FROM (SELECT *, CASE WHEN k % 3 = 0 THEN 'REVIEW' WHEN k % 31 = 0 THEN 'PAGE' ELSE 'FINDING' END AS scope FROM e)""")
ORACLES["attestation_contract"] = with_ctes(["e"], """SELECT event_id, concat_ws(',',
    CASE WHEN k % 11 = 0 THEN 'cluster' END, CASE WHEN k % 13 = 0 THEN 'program_id' END, CASE WHEN k % 17 = 0 THEN 'pda_address' END,
    CASE WHEN k % 19 = 0 THEN 'tx_signature' END, CASE WHEN k % 23 = 0 THEN 'input_hash' END, CASE WHEN k % 29 = 0 THEN 'reviewed_hash' END,
    CASE WHEN k % 7 = 0 THEN 'model_version' END, CASE WHEN k % 5 = 0 THEN 'status' END) AS violations FROM e""")
_SHEET_ROWS = ORACLES["extract_measurements"]
ORACLES["misplaced_evidence"] = f"""SELECT document_id, CAST(CASE WHEN event_id % 7 = 0 THEN 2 ELSE 1 END AS INTEGER) AS page_num,
    CAST(char_start + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS INTEGER) AS char_start, source_text
  FROM (SELECT *, CAST(substr(document_id, 2) AS BIGINT) AS event_id FROM ({_SHEET_ROWS})) WHERE event_id % 5 = 0 OR event_id % 7 = 0"""
ORACLES["test_codes_from_table"] = """WITH names AS (SELECT *, lower(p_name || ' a ' || p_type) AS key FROM part),
  codes AS (SELECT key, min('T' || p_size) AS code FROM names WHERE p_partkey % 3 > 0 GROUP BY key)
  SELECT p_partkey, coalesce(code, 'UNK_' || regexp_replace(regexp_replace(upper(n.key), '[^A-Z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')) AS test_code,
    code IS NOT NULL AS test_known FROM names n LEFT JOIN codes c ON c.key = n.key"""
