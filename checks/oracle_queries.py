"""DuckDB SQL for every key of ``checks.queries``."""

from __future__ import annotations

from caseloom import fixed_values as fv
from caseloom.operators.validation import FALSE_WORDS, OPTIONAL, TRUE_WORDS, VOCABULARIES
from checks import fake_model as fm
from checks import oracle as o
from checks.queries import EMAIL_ANSWER, EXTRACTION_FIELDS, SUMMARY_ANSWER, SUMMARY_FIELDS

Q = o.q
X = ", ".join(EXTRACTION_FIELDS)
DOC_KEY = "'doc_' || doc_id AS source_file"

NAMES = f"""names AS (
  SELECT '/in/' || p_partkey AS path,
    CASE p_partkey % 10 WHEN 0 THEN '.' WHEN 1 THEN '~$' WHEN 2 THEN '_' ELSE '' END
      || p_name || ' (' || p_partkey || ')' ||
      CASE p_partkey % 7 WHEN 0 THEN '.TXT' WHEN 1 THEN '.md' WHEN 2 THEN '.tar.pdf'
        WHEN 3 THEN '.xlsx' WHEN 4 THEN '' WHEN 5 THEN '.Docx' ELSE '.été' END AS name,
    CAST(p_size AS BIGINT) AS length
  FROM part
),
files AS (
  SELECT *, ltrim(sfx, '.') AS file_type,
    starts_with(name, '.') OR starts_with(name, '~$') AS ignored,
    sfx IN ('.docx', '.md', '.pdf', '.txt') AS known
  FROM (SELECT *, {o.suffix('name')} AS sfx FROM names)
)"""


def from_files(select: str) -> str:
    return f"WITH {NAMES} {select}"


def from_corpus(select: str) -> str:
    return f"WITH corpus AS ({o.corpus_oracle()}) {select}"


VALUES = f"""WITH corpus AS ({o.corpus_oracle()}),
lines AS (
  SELECT source_file, unnest(range(0, len(parts))) AS line_no, unnest(parts) AS line
  FROM (SELECT source_file, string_split(text, chr(10)) AS parts FROM corpus)
),
vals AS (SELECT *, regexp_extract(line, '[:|](.*)$', 1) AS value FROM lines)"""


def _join(names) -> str:
    return "concat_ws('; ', " + ", ".join(names) + ")"


def _problem(name: str, kinds: str) -> str:
    def say(what: str) -> str:
        return Q(f"{name}: {what}")

    t, v = f"json_type(jj, '$.{name}')", f"json_extract_string(jj, '$.{name}')"
    head = f"CASE WHEN {t} IS NULL THEN {say('field required')} "
    if kinds == "flag":
        allowed = o.words(TRUE_WORDS + FALSE_WORDS)
        return head + (
            f"WHEN {t} IN ('NULL', 'OBJECT') OR lower({v}) NOT IN {allowed} "
            f"THEN {say('not a boolean')} END"
        )
    if kinds == "optional":
        return head + f"WHEN {t} NOT IN ('VARCHAR', 'NULL') THEN {say('not a string')} END"
    if kinds == "list":
        items = f"json_extract(jj, '$.{name}[*]')"
        texts = f"json_extract_string(jj, '$.{name}[*]')"
        return head + (
            f"WHEN {t} <> 'ARRAY' OR len(list_filter({items}, lambda i: json_type(i) <> 'VARCHAR')) > 0 "
            f"THEN {say('not a list of strings')} "
            f"WHEN len(list_filter({texts}, lambda i: trim(i, {o.TRIM}) <> '')) = 0 "
            f"THEN {say('needs at least one paragraph')} END"
        )
    head += f"WHEN {t} <> 'VARCHAR' THEN {say('not a string')} "
    if kinds == "vocabulary":
        return head + f"WHEN {v} NOT IN {o.words(VOCABULARIES[name])} THEN {say('not in the vocabulary')} END"
    return head + f"WHEN {o.collapse(v)} = '' THEN {say('must not be empty')} END"


def _kind(name: str) -> str:
    if name in ("is_complaint", "escalation_required", "supporting_document_available"):
        return "flag"
    if name in OPTIONAL:
        return "optional"
    if name in VOCABULARIES:
        return "vocabulary"
    return "list" if name == "body_paragraphs" else "text"


def checked(fields) -> str:
    """CTE ``checked`` over ``answers(key, j)``."""
    return f"""valid AS (
  SELECT *, json_valid(j) AND coalesce(json_type(CASE WHEN json_valid(j) THEN j ELSE '1' END) = 'OBJECT', false)
      AS is_object,
    CASE WHEN json_valid(j) THEN j ELSE '[]' END AS jj
  FROM answers
),
checked AS (
  SELECT *, CASE WHEN NOT is_object THEN 'answer is not a JSON object'
    ELSE {_join(_problem(f, _kind(f)) for f in fields)} END AS violations
  FROM valid
)"""


def _field(name: str) -> str:
    v = f"json_extract_string(jj, '$.{name}')"
    kind = _kind(name)
    value = {
        "flag": f"lower({v}) IN {o.words(TRUE_WORDS)}",
        "vocabulary": v,
        "text": o.collapse(v),
        "optional": o.none_if_blank(v),
    }.get(kind, v)
    if name == "email":
        value = o.valid_email(v)
    if name == "phone_number":
        value = o.valid_phone(v)
    return f"CASE WHEN violations = '' THEN {value} END AS {name}"


ANSWERS = f"""{o.drafted()},
answers AS (
  SELECT source_file, CASE k % 20
    WHEN 0 THEN replace(record_json, '"customer_name"', '"customer"')
    WHEN 1 THEN replace(record_json, '"Low"', '"Lowest"')
    WHEN 2 THEN substr(record_json, 1, length(record_json) - 1)
    WHEN 3 THEN replace(record_json, ': true', ': "yes"')
    WHEN 4 THEN replace(record_json, ': false', ': "perhaps"')
    WHEN 5 THEN '[1, 2]'
    WHEN 6 THEN replace(replace(record_json, '"priority"', '"prio"'), '"email": ', '"email": 5, "mail": ')
    ELSE record_json END AS j
  FROM drafts
)"""


# --- The run of the stand-in model, worked out from prompt lengths --------------------


def _missing(fields) -> str:
    return "; ".join(f"{f}: field required" for f in fields)


def _fate(task: str, n: str, fields, own: str) -> str:
    """Error text of one model task, null when it succeeds; ``own`` are its violations."""
    mismatch = f"Fake payload did not match schema for task '{task}': "
    return (
        f"CASE WHEN {n} % {fm.OUTAGE} = 0 THEN "
        f"{Q(f'''Fake call failed for task '{task}' after 2 attempt(s): planned outage''')} "
        f"WHEN {n} % {fm.BROKEN} = 0 THEN 'unexpected error: planned defect' "
        f"WHEN {n} % {fm.REFUSAL} = 0 THEN {Q(f'''Model refused task '{task}': planned refusal''')} "
        f"WHEN {n} % {fm.NO_ANSWER} = 0 THEN "
        f"{Q(f'''Fake returned no parsable object for task '{task}' (finish_reason=length)''')} "
        f"WHEN {n} % {fm.EMPTY} = 0 THEN {Q(mismatch + _missing(fields))} "
        f"WHEN {own} <> '' THEN {Q(mismatch)} || {own} END"
    )


def _called(n: str) -> str:
    return f"CASE WHEN {n} IS NULL OR {n} % {fm.OUTAGE} = 0 OR {n} % {fm.BROKEN} = 0 THEN 0 ELSE 1 END"


def _nth(values, n: str) -> str:
    return f"list_extract([{', '.join(Q(v) for v in values)}], 1 + {n} % {len(values)})"


def model_run(timed: str) -> str:
    own1 = (
        "concat_ws('; ', CASE WHEN n1 % 41 = 0 THEN 'complaint_category: not in the vocabulary' END, "
        "CASE WHEN n1 % 43 = 0 THEN 'issue_description: must not be empty' END)"
    )
    own2 = "CASE WHEN n2 % 47 = 0 THEN 'body_paragraphs: needs at least one paragraph' ELSE '' END"
    email_fields = ("subject", "greeting", "body_paragraphs", "closing", "sender_name")
    calls = " + ".join(_called(n) for n in ("n1", "n2", "n3"))
    tokens = " + ".join(f"({_called(n)}) * coalesce({n} // 4, 0)" for n in ("n1", "n2", "n3"))
    record = f"""
    CASE WHEN n1 % 3 <> 0 THEN 'Client ' || n1 END AS customer_name,
    CASE WHEN n1 % 2 = 1 THEN 'c' || n1 || '@example.com' END AS email,
    CASE WHEN n1 % 4 <> 0 THEN '+44 ' || (1000000 + n1) END AS phone_number,
    CASE WHEN n1 % 5 <> 0 THEN 'Product ' || (n1 % 7) END AS product_or_service,
    {_nth(fv.CATEGORIES, "n1")} AS complaint_category,
    'Document of ' || n1 || ' characters' AS issue_description,
    CAST(NULL AS VARCHAR) AS resolution_provided,
    n1 % 2 = 0 AS is_complaint, n1 % 3 = 0 AS escalation_required,
    false AS supporting_document_available,
    {_nth(fv.CASE_STATUSES, "n1")} AS overall_case_status,
    {_nth(fv.PRIORITIES, "n1")} AS priority,
    {_nth(fv.SENTIMENTS, "n1")} AS customer_sentiment,
    CAST(NULL AS VARCHAR) AS extraction_notes"""
    kept = ", ".join(f"CASE WHEN e1 IS NULL AND n1 IS NOT NULL THEN {f} END AS {f}" for f in EXTRACTION_FIELDS)
    return f"""WITH corpus AS ({o.corpus_oracle()}),
docs AS ({o.RAW_FORMS}),
cuts AS (SELECT *, CASE WHEN load_error IS NULL THEN text END AS cut FROM docs),
first AS (SELECT *, length({o.prompt(fv.PROMPT_EXTRACTION)}) AS n1 FROM cuts),
fate1 AS (SELECT *, CASE WHEN n1 IS NOT NULL THEN {_fate("extraction", "n1", EXTRACTION_FIELDS, own1)} END AS e1 FROM first),
records AS (SELECT *, {record} FROM fate1),
kept AS (SELECT source_file, cut, load_error, n1, e1, {kept} FROM records),
jsons AS (SELECT *, CASE WHEN e1 IS NULL AND n1 IS NOT NULL THEN {o.record_json()} END AS record_json FROM kept),
second AS (SELECT *, length({o.prompt(fv.PROMPT_EMAIL)}) AS n2, length({o.prompt(fv.PROMPT_SUMMARY)}) AS n3 FROM jsons),
fate2 AS (SELECT *,
  CASE WHEN n2 IS NOT NULL THEN {_fate("customer_email", "n2", email_fields, own2)} END AS e2,
  CASE WHEN n3 IS NOT NULL THEN {_fate("case_summary", "n3", SUMMARY_FIELDS, "''")} END AS e3
  FROM second)
SELECT source_file,
  CASE WHEN n2 IS NULL THEN 'FAILED' WHEN e2 IS NULL AND e3 IS NULL THEN 'SUCCESS' ELSE 'PARTIAL' END AS status,
  concat_ws(' | ', 'ingestion: ' || load_error, 'extraction: ' || e1, 'customer_email: ' || e2, 'case_summary: ' || e3) AS errors,
  {X},
  CASE WHEN n2 IS NOT NULL AND e2 IS NULL THEN 'Reply ' || n2 END AS subject,
  CASE WHEN n2 IS NOT NULL AND e2 IS NULL THEN 'First part' END AS paragraphs,
  CASE WHEN n3 IS NOT NULL AND e3 IS NULL THEN 'Case ' || n3 END AS case_overview,
  CAST({calls} AS BIGINT) AS calls, CAST({tokens} AS BIGINT) AS prompt_tokens,
  CAST(({calls}) * {fm.COMPLETION_TOKENS} AS BIGINT) AS completion_tokens,
  CASE WHEN n1 IS NULL THEN '' WHEN n2 IS NULL THEN 'extraction' ELSE {Q(timed)} END AS timed
FROM fate2"""


def _report_column(name: str) -> str:
    own = {
        "case_id": "case_id", "source_file": "source_file", "file_type": "file_type",
        "processing_status": "status",
        "recommended_next_action": "coalesce(recommended_next_action, '')",
        "email_generated": "CASE WHEN has_email THEN 'Yes' ELSE 'No' END",
        "summary_generated": "CASE WHEN has_summary THEN 'Yes' ELSE 'No' END",
        "processing_seconds": "CAST(0 AS DOUBLE)",
        "errors": "errors",
    }
    if _kind(name) == "flag":
        return f"CASE WHEN {name} IS NULL THEN '' WHEN {name} THEN 'Yes' ELSE 'No' END AS {name}"
    return f"{own.get(name, f'coalesce({name}, {Q(str())})')} AS {name}"


_NOTE = (
    "'# Case Summary — ' || case_id || chr(10) || chr(10) || '**Source file:** ' || c.source_file || '  ' "
    "|| chr(10) || '**Category:** ' || c.complaint_category || '  ' || chr(10) || '**Priority:** ' || "
    "c.priority || '  ' || chr(10) || '**Escalation required:** ' || CASE WHEN c.escalation_required "
    "THEN 'Yes' ELSE 'No' END || '  ' || chr(10) || chr(10) || "
    + o.RENDERED_SUMMARY.replace("recommended_next_action", "d.recommended_next_action")
    + " || chr(10)"
)


def model_sql() -> dict[str, str]:
    """The counterparts of ``queries.MODEL_RUNS``."""
    return {
        "generate_structured": model_run("downstream_tasks_parallel,extraction"),
        "generate_structured_sequential": model_run("case_summary,customer_email,extraction"),
    }


def oracle_sql() -> dict[str, str]:
    parsed, ruled, drafted, cased = o.parsed(), o.ruled(), o.drafted(), o.cased()
    strip_text = o.strip("text")

    def prose_issue(line: str, opening: str) -> str:
        return (
            f"CASE WHEN longest IS NOT NULL THEN {line} WHEN {o.strip(opening)} <> '' "
            f"THEN {o.strip(opening)} ELSE {Q(fv.NO_ISSUE_TEXT)} END"
        )

    def longest(key: str, text: str, source: str) -> str:
        return f"""plines AS (
  SELECT {key}, unnest(range(1, len(parts) + 1)) AS ln, unnest(parts) AS raw
  FROM (SELECT {key}, regexp_split_to_array({text}, '\\r\\n|[{o.BREAKS}]') AS parts FROM {source})
),
plongest AS (
  SELECT {key}, s AS longest FROM (SELECT *, {o.strip("raw")} AS s FROM plines)
  WHERE length(s) > {fv.PROSE_MIN_CHARS} AND NOT contains(substr(raw, 1, {fv.PROSE_LABEL_WINDOW}), ':')
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY length(s) DESC, ln) = 1
)"""

    doc_name = "'doc ' || doc_id || '.txt'"
    return {
        "discover": from_files(
            "SELECT name, file_type, ignored, NOT ignored AND known AS eligible, "
            "NOT ignored AND NOT known AS skipped FROM files"
        ),
        "eligible": from_files("SELECT name FROM files WHERE NOT ignored AND known"),
        "skipped": from_files("SELECT name FROM files WHERE NOT ignored AND NOT known ORDER BY name"),
        "skipped_by_anti_join": from_files(
            "SELECT name FROM files WHERE NOT ignored EXCEPT ALL "
            "SELECT name FROM files WHERE NOT ignored AND known"
        ),
        "limited_run": from_files(
            "SELECT name, length FROM files WHERE NOT ignored AND known ORDER BY name LIMIT 25"
        ),
        "scan_text": from_corpus(
            "SELECT source_file, CASE WHEN k % 2 = 0 THEN text "
            "ELSE regexp_replace(text, '[^\\x{00}-\\x{ff}]', '?', 'g') END AS text FROM corpus"
        ),
        "scan_docx": (
            "SELECT 'f' || c_custkey || '.docx' AS source_file, "
            "CASE WHEN c_custkey % 4 = 0 THEN 'Case of ' || c_name || chr(10) || 'Über & out' || chr(10) "
            "|| 'Customer Name | ' || c_name END AS raw, "
            "CASE WHEN c_custkey % 4 = 1 THEN 'Failed to read f' || c_custkey || "
            "'.docx: File is not a zip file' END AS load_error "
            "FROM customer WHERE c_custkey % 4 IN (0, 1)"
        ),
        "extract_document_text": (
            "SELECT 'f' || c_custkey || list_extract(['.docx', '.docx', '.rtf', '.txt'], 1 + c_custkey % 4) "
            "AS source_file, CASE c_custkey % 4 WHEN 0 THEN 'Case of ' || c_name || chr(10) || 'Über & out' "
            "|| chr(10) || 'Customer Name | ' || c_name WHEN 3 THEN 'Name: ' || c_name || chr(10) || "
            "'Item: ' || c_mktsegment ELSE '' END AS text, CASE c_custkey % 4 WHEN 1 THEN 'Failed to read f' "
            "|| c_custkey || '.docx: File is not a zip file' WHEN 2 THEN 'No text extractor is registered "
            "for .rtf files (f' || c_custkey || '.rtf)' END AS load_error FROM customer"
        ),
        "table_source": f"""{o.ruled(o.DOCUMENT_TABLE)}
SELECT docs.source_file, CASE WHEN extraction.k IS NULL THEN 'FAILED' ELSE 'SUCCESS' END AS status, {X}
FROM docs LEFT JOIN extraction USING (k)""".replace(
            "SELECT docs.source_file,", "SELECT docs.source_file AS source_file,"
        ),
        "case_id": from_files(f"SELECT name, {o.case_id('name')} AS case_id FROM files"),
        "document_meta": f"""SELECT {o.case_id(doc_name)} AS case_id, {doc_name} AS source_file,
  'txt' AS file_type, strlen(text) AS file_size_bytes, length(text) AS char_count,
  false AS truncated FROM documents""",
        "truncate": "SELECT doc_id, substr(text, 1, 2000) AS kept, length(text) > 2000 AS truncated FROM documents",
        "display_name": f"{ruled} SELECT source_file, {o.NAME} AS display_name FROM extraction",
        "email_topic": f"{ruled} SELECT source_file, {o.TOPIC} AS topic FROM extraction",
        "total_duration": (
            "SELECT o_orderkey, round(o_totalprice / 1000.0 + o_custkey / 7.0 + o_orderkey / 9.0, 3) "
            "AS seconds FROM orders"
        ),
        "failed_record": (
            f"{cased} SELECT case_id, source_file, file_type, size AS file_size_bytes, "
            "CAST(char_count AS BIGINT) AS char_count, 'ingestion: ' || why AS errors "
            "FROM cases WHERE NOT extracted"
        ),
        "empty_text": from_corpus(
            f"SELECT source_file, load_error FROM ({o.RAW_FORMS}) WHERE load_error IS NOT NULL"
        ),
        "has_extraction": f"{cased} SELECT source_file, true AS has_email FROM cases WHERE extracted",
        "enquiry_predicate": (
            f"{ruled} SELECT source_file, enquiry FROM subjects UNION ALL "
            f"SELECT {DOC_KEY}, {o.any_of('lower(text)', fv.ENQUIRY_MARKERS)} FROM documents"
        ),
        "normalise_unicode": f"SELECT doc_id, {o.normalise('text')} AS text FROM documents",
        "normalise": from_corpus(f"SELECT source_file, {o.normalise('raw_text')} AS text FROM corpus"),
        "collapse_ws": from_corpus(f"SELECT source_file, {o.collapse('raw_text')} AS text FROM corpus"),
        "blank_to_none": f"{VALUES} SELECT source_file, line_no, {o.none_if_blank('value')} AS value FROM vals",
        "clean_value": f"{VALUES} SELECT source_file, line_no, {o.clean('value')} AS value FROM vals",
        "split_lines": from_corpus(
            f"""SELECT source_file, row_number() OVER (PARTITION BY source_file ORDER BY ln) - 1 AS line_no,
  line FROM (SELECT source_file, ln, {o.strip('raw')} AS line FROM (
    SELECT source_file, unnest(range(1, len(parts) + 1)) AS ln, unnest(parts) AS raw
    FROM (SELECT source_file, regexp_split_to_array(raw_text, '\\r\\n|[{o.BREAKS}]') AS parts FROM corpus)))
  WHERE line <> ''"""
        ),
        "classify_line": (
            f"{parsed} SELECT source_file, row_number() OVER (PARTITION BY k ORDER BY ln) - 1 AS event_no, "
            "label, name AS canonical, value FROM classified JOIN (SELECT k, source_file FROM doc) USING (k) "
            "WHERE kind IS NOT NULL"
        ),
        "canonical_label": (
            f"{VALUES}, known(kind, name, label) AS (VALUES {o._LABELS}) "
            "SELECT source_file, line_no, name AS canonical FROM (SELECT *, lower(regexp_extract(line, "
            "'^(?:- \\*\\*)?([A-Za-z /-]+?)[ \\t]*[:|]', 1)) AS label FROM vals) LEFT JOIN known USING (label)"
        ),
        "parse_fields": (
            f"{parsed} SELECT source_file, name AS field, v AS value FROM field_rows "
            "JOIN (SELECT k, source_file FROM doc) USING (k)"
        ),
        "parse_sections": (
            f"{parsed} SELECT source_file, name AS section, v AS body FROM section_rows "
            "JOIN (SELECT k, source_file FROM doc) USING (k)"
        ),
        "extract_block": from_corpus(f"SELECT source_file, {strip_text} AS document, '' AS nothing FROM corpus"),
        "scan_email": (
            f"{ruled} SELECT source_file, found_email AS found FROM outcome UNION ALL "
            f"SELECT {DOC_KEY}, {o.first('text', o.EMAIL_SCAN)} FROM documents"
        ),
        "scan_phone": (
            f"{ruled} SELECT source_file, found_phone AS found FROM outcome UNION ALL "
            f"SELECT {DOC_KEY}, {o.first('text', o.PHONE_SCAN)} FROM documents"
        ),
        "pick_issue": (
            f"{ruled}, texts AS (SELECT doc_id, {strip_text} AS t FROM documents), "
            f"{longest('doc_id', 't', 'texts')} SELECT source_file, issue FROM outcome UNION ALL "
            f"SELECT {DOC_KEY}, {prose_issue('longest', 't')} FROM texts LEFT JOIN plongest USING (doc_id)"
        ),
        "issue_excerpt": (
            f"WITH texts AS (SELECT doc_id, {strip_text} AS t FROM documents), {longest('doc_id', 't', 'texts')} "
            f"SELECT doc_id, {prose_issue('substr(longest, 1, 800)', 'substr(t, 1, 300)')} AS issue "
            "FROM texts LEFT JOIN plongest USING (doc_id)"
        ),
        "longest_line": (
            "WITH turns AS (SELECT conv_id * 1000000 + turn AS key, * FROM conversations), "
            f"{longest('key', 'text', 'turns')} "
            "SELECT conv_id, turn, longest AS line FROM turns LEFT JOIN plongest USING (key)"
        ),
        "build_notes": f"{ruled} SELECT source_file, notes FROM outcome",
        "subject_text": f"{ruled} SELECT source_file, subject FROM subjects",
        "score_category": (
            f"{ruled} SELECT source_file, category, CAST(score AS BIGINT) AS score FROM scores "
            "JOIN (SELECT k, source_file FROM doc) USING (k)"
        ),
        "keyword_score": (
            f"{ruled} SELECT source_file, category, CAST(score AS BIGINT) AS score FROM scores "
            "JOIN (SELECT k, source_file FROM doc) USING (k)"
        ),
        "category_native": (
            f"{ruled} SELECT source_file, coalesce(category, 'Other') AS category FROM doc LEFT JOIN best USING (k)"
        ),
        "category_rules_join": (
            f"{ruled} SELECT source_file, coalesce(category, 'Other') AS category FROM doc LEFT JOIN best USING (k)"
        ),
        "decide_escalation": f"{ruled} SELECT source_file, escalated FROM outcome",
        "decide_status": f"{ruled} SELECT source_file, case_status FROM outcome",
        "decide_sentiment": f"{ruled} SELECT source_file, sentiment FROM outcome",
        "decide_priority": f"{ruled} SELECT source_file, priority FROM outcome",
        "supporting_document": f"{ruled} SELECT source_file, supporting FROM outcome",
        "contains_any": (
            "SELECT conv_id, turn, "
            f"{o.any_of('lower(text)', ('app', 'ser', 'ion la', 'not a complaint'))} AS hit FROM conversations"
        ),
        "extraction": f"{ruled} SELECT source_file, {X} FROM extraction",
        "validate_email": f"{VALUES} SELECT source_file, line_no, {o.valid_email('value')} AS email FROM vals",
        "validate_phone": f"{VALUES} SELECT source_file, line_no, {o.valid_phone('value')} AS phone FROM vals",
        "read_responses": (
            f"{ANSWERS}, {checked(EXTRACTION_FIELDS)} SELECT source_file, violations, "
            f"{', '.join(_field(f) for f in EXTRACTION_FIELDS)} FROM checked"
        ),
        "email_parts": (
            f"WITH answers AS (SELECT o_orderkey, {EMAIL_ANSWER} AS j FROM orders), "
            f"{checked(('subject', 'greeting', 'body_paragraphs', 'closing', 'sender_name'))} "
            "SELECT o_orderkey, violations, "
            f"{', '.join(_field(f) for f in ('subject', 'greeting', 'closing', 'sender_name'))}, "
            "CASE WHEN violations = '' THEN array_to_string(list_filter(list_transform("
            f"json_extract_string(jj, '$.body_paragraphs[*]'), lambda i: {o.collapse('i')}), "
            "lambda i: i <> ''), '|') END AS paragraphs FROM checked"
        ),
        "summary_parts": (
            f"WITH answers AS (SELECT o_orderkey, {SUMMARY_ANSWER} AS j FROM orders), "
            f"{checked(SUMMARY_FIELDS)} SELECT o_orderkey, violations, "
            f"{', '.join(_field(f) for f in SUMMARY_FIELDS)} FROM checked"
        ),
        "build_email": (
            f"{drafted} SELECT source_file, subject, greeting, closing, sender_name, "
            "concat_ws('|', p1, p2, p3, p4, p5) AS paragraphs FROM drafts"
        ),
        "build_summary": f"{drafted} SELECT source_file, {', '.join(SUMMARY_FIELDS)} FROM drafts",
        "render_email": f"{drafted} SELECT source_file, {o.RENDERED_EMAIL} AS text FROM drafts",
        "render_summary": f"{drafted} SELECT source_file, {o.RENDERED_SUMMARY} AS text FROM drafts",
        "prompt_extraction": from_corpus(
            f"SELECT source_file, {o.prompt(fv.PROMPT_EXTRACTION)} AS prompt "
            "FROM (SELECT source_file, text AS cut FROM corpus)"
        ),
        "prompt_email": (
            f"{drafted} SELECT source_file, {o.prompt(fv.PROMPT_EMAIL)} AS prompt "
            "FROM (SELECT source_file, d AS cut, record_json FROM drafts)"
        ),
        "prompt_summary": (
            f"{drafted} SELECT source_file, {o.prompt(fv.PROMPT_SUMMARY)} AS prompt "
            "FROM (SELECT source_file, d AS cut, record_json FROM drafts)"
        ),
        "process_documents": (
            f"{cased} SELECT c.case_id, c.source_file, "
            "CASE WHEN extracted THEN 'SUCCESS' ELSE 'FAILED' END AS status, "
            "CAST(char_count AS BIGINT) AS char_count, truncated, "
            f"{', '.join(f'c.{f}' for f in EXTRACTION_FIELDS)}, d.subject, d.recommended_next_action, "
            "CAST(coalesce(prompt_tokens, 0) AS BIGINT) AS prompt_tokens "
            "FROM cases c LEFT JOIN drafts d USING (k)"
        ),
        "case_status": f"{cased} SELECT source_file, status, errors FROM cases",
        "task_results_to_record": f"""{drafted},
raw AS ({o.RAW_FORMS})
SELECT raw.source_file AS source_file, CASE WHEN raw.load_error IS NULL THEN 'SUCCESS' ELSE 'FAILED' END AS status,
  CASE WHEN raw.k % 3 <> 0 THEN subject END AS subject,
  CASE WHEN raw.k % 5 <> 0 THEN current_status END AS current_status
FROM raw LEFT JOIN drafts USING (k)""",
        "manifest_to_content": (
            "SELECT o_orderkey AS path, text, text IS NULL AS unread "
            "FROM orders LEFT JOIN documents ON doc_id = o_orderkey"
        ),
        "count_by_status": (
            f"{cased} SELECT count(*) AS documents_processed, "
            "count(*) FILTER (status = 'SUCCESS') AS succeeded, "
            "count(*) FILTER (status = 'PARTIAL') AS partial, "
            "count(*) FILTER (status = 'FAILED') AS failed FROM cases"
        ),
        "token_usage": (
            f"{cased} SELECT CAST(3 * n AS BIGINT) AS calls, CAST(p AS BIGINT) AS prompt_tokens, "
            f"CAST(3 * n * {fv.COMPLETION_TOKENS_PER_CALL} AS BIGINT) AS completion_tokens, "
            f"CAST(p + 3 * n * {fv.COMPLETION_TOKENS_PER_CALL} AS BIGINT) AS total_tokens FROM ("
            "SELECT count(*) FILTER (extracted) AS n, sum(prompt_tokens) AS p FROM cases)"
        ),
        "run_outcome": (
            f"{cased} SELECT CASE WHEN coalesce(bool_and(status = 'SUCCESS'), true) THEN 'OK' "
            "ELSE 'PARTIAL' END AS outcome FROM cases"
        ),
        "run_manifest": (
            f"{cased}, {NAMES} SELECT count(*) AS documents_processed, "
            "count(*) FILTER (status = 'SUCCESS') AS succeeded, "
            "count(*) FILTER (status = 'PARTIAL') AS partial, "
            "count(*) FILTER (status = 'FAILED') AS failed, "
            "(SELECT count(*) FROM files WHERE NOT ignored AND NOT known) AS skipped FROM cases"
        ),
        "error_list": (
            f"{cased} SELECT case_id, source_file, unnest(string_split(errors, ' | ')) AS error "
            "FROM cases WHERE errors <> ''"
        ),
        "case_id_collisions": (
            f"SELECT case_id, count(*) AS files, max(p_name || '.' || p_partkey) AS kept_file "
            f"FROM (SELECT *, {o.case_id('p_name')} AS case_id FROM part) GROUP BY case_id HAVING count(*) > 1"
        ),
        "report_rows": (
            f"{cased} SELECT {', '.join(_report_column(n) for n in fv.REPORT_COLUMNS)} FROM cases "
            "ORDER BY source_file"
        ),
        "summary_view": (
            f"{cased} SELECT case_id, file_type, status, coalesce(complaint_category, '—') AS category, "
            "coalesce(priority, '—') AS priority, CASE WHEN NOT extracted THEN '—' WHEN escalation_required "
            "THEN 'Yes' ELSE 'No' END AS escalation, CAST(0 AS DOUBLE) AS seconds FROM cases"
        ),
        "structured_rows": (
            f"{cased} SELECT case_id, source_file, status AS processing_status, size AS file_size_bytes, "
            "errors, priority FROM cases WHERE extracted"
        ),
        "email_texts": (
            f"{cased} SELECT case_id, c.source_file, {o.RENDERED_EMAIL} AS text "
            "FROM cases c JOIN drafts d USING (k) WHERE has_email"
        ),
        "summary_texts": (
            f"{cased} SELECT case_id, c.source_file, {_NOTE} AS text "
            "FROM cases c JOIN drafts d USING (k) WHERE has_summary"
        ),
    }
