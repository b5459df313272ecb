"""Form documents composed from the given tables.

The prose in ``documents`` has no form labels, so the form rules would see nothing in
it. Every order therefore becomes one form: customer and part fill the fields,
phrases picked by the order key fill the sections, and a document with the same key
is worked in whole. The text is the same SQL for Spark and for DuckDB.

Forms come in four layouts (plain, Markdown, Word-like with the table rows last, and
headings without colons), with blank and placeholder values, labels that repeat,
sections that repeat, fields between sections, and free text without any label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caseloom.plans.sealing import sealed
from checks.spread import share_out

DESCRIPTIONS = (
    "I was billed twice for the month and the duplicate charge is still on my invoice.",
    "The delivery never came. The courier tracking has not moved and the parcel is lost.",
    "The fan stopped working on day two, smells of smoke, and that is a manufacturing defect.",
    "It is still under warranty and the guarantee says so.",
    "I cancelled my plan in the cooling off period and want my money back.",
    "Since the move I cannot log in: access denied, a new password, and the OTP is never sent.",
    "Another blank screen, another error. I had to reinstall and it crashed while saving.",
    "Your staff were rude and dismissive and the communication was very poor.",
    "This is completely unacceptable and I want this escalated to a manager.",
    "A question only, this is not a complaint: may I have clarification on the upgrade?",
    "There is a refund and a delivery to sort out.",
    "A courier brought a faulty item.",
    "I am happy with how it appears.",
    "I am awaiting news.",
    "Too short.",
    "",
    "(none recorded)",
    "This is the third time I write and there was no response. I am furious, the worst support.",
    "I have attached my receipt.  The server gave a timeout,   and the bug is a regression.",
    "The shipment was damaged and the consignment is stuck at the sorting hub.",
    "Please raise this to a manager. It is costing me money and I am extremely frustrated.",
    "Thank you, I appreciate the help and I am satisfied, but the charges are odd.",
    "The screen is broken and not working, and a technician failed to fix the malfunction.",
    "My account locked itself after login attempts when I tried to sign in.",
    "They arrived outside the agreed slot without calling ahead.",
    "An overcharge was made on the auto-payment, reimburse me or I start a chargeback.",
    'The page said "error" and C:/logs was empty; I am angry and disappointed.',
)
DETAILS = (
    "Ledger shows a duplicate charge on the fourth.",
    "None.",
    "",
    "Follow-up call made; payment still pending and the dispatch note is missing.",
    "N/A",
    "Known issue.",
    "The report shows an error on the server after the last release, several customers affected.",
    "Customer was disappointed with the staff.",
    "-",
    "Warranty status confirmed.",
    "Straightforward question about plans.",
)
RESOLUTIONS = (
    "A refund was approved and settled.",
    "(none recorded)",
    "",
    "Bank transfer, being processed since Tuesday.",
    "A new unit was sent and the case is closed.",
    "We apologised and a goodwill credit of 150 was applied. Now closed.",
    "Team will look at it next week.",
    "Engineer visit scheduled for Monday.",
    "none.",
    "Unknown",
    "The order was replaced and the payment was credited.",
    "**Resolved** on the phone.",
    "Customer confirmed the fix.",
)
ESCALATIONS = (
    "Not required, resolved at first line by chat.",
    "So far not requested.",
    "Wants a supervisor on the phone.",
    "Escalated on Monday, ticket 9.",
    "Not yet escalated, waits for the audit.",
    "Desk two, handled by the duty manager, now closed.",
    "",
    "None.",
    "Customer mentioned the consumer court and legal steps.",
    "A callback was asked for.",
    "To be decided.",
    "No escalation.",
)
SUPPORTING = (
    "Invoice INV-7 and bank statement extract.",
    "None provided.",
    "",
    "Screenshot of the page.",
    "Photo enclosed",
    "Call recording reference CR-1.",
    "nothing to add",
    "A copy of the receipt as evidence.",
)

NL = "chr(10)"
KEY = "CAST(k AS STRING)"


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _pick(number: str, phrases: tuple[str, ...]) -> str:
    cases = " ".join(f"WHEN {i} THEN {_quote(p)}" for i, p in enumerate(phrases))
    return f"CASE ({number}) % {len(phrases)} {cases} END"


def _join(*parts: str) -> str:
    return " || ".join(parts)


_NAME = (
    "CASE k % 11 WHEN 3 THEN 'N/A' WHEN 5 THEN '' WHEN 7 THEN '  ' || c_name || '   of  ' || "
    "c_mktsegment WHEN 9 THEN '**' || c_name || '**' ELSE c_name END"
)
_EMAIL = (
    f"CASE k % 13 WHEN 1 THEN '<User.' || {KEY} || '@Example.COM>' WHEN 2 THEN 'not-an-email' "
    f"WHEN 3 THEN '' WHEN 4 THEN 'missing@tld' WHEN 5 THEN 'u' || {KEY} || '@example.co.uk.' "
    f"WHEN 6 THEN 'write to a.b+' || {KEY} || '@mail.example.org, please' WHEN 7 THEN 'N/A' "
    f"WHEN 8 THEN 'a b@c.com' WHEN 9 THEN 'x@y@z.example.com' "
    f"ELSE 'user' || {KEY} || '@example.com' END"
)
_PHONE = (
    f"CASE k % 12 WHEN 0 THEN '12' WHEN 1 THEN '(none)' WHEN 2 THEN '080-4455-9012' "
    f"WHEN 3 THEN '(555) 123-4567' WHEN 4 THEN '' WHEN 5 THEN '+1234567890123456789' "
    f"WHEN 6 THEN 'call +44 7700  900123 after six' WHEN 7 THEN '555' "
    f"ELSE '+91 98765 ' || CAST(10000 + k % 90000 AS STRING) END"
)
_PRODUCT = (
    "CASE k % 9 WHEN 2 THEN '' WHEN 4 THEN 'unknown' WHEN 6 THEN '_' || p_name || '_' "
    "ELSE coalesce(p_name, 'item') || ' ' || coalesce(p_brand, '') END"
)
_TITLE = "CASE WHEN k % 29 = 0 THEN 'CUSTOMER ENQUIRY' ELSE 'CUSTOMER CASE RECORD' END"

_KEYS = "k, p_name, o_orderpriority, prose"
_FIELDS = f"""k % 4 AS layout,
  {_TITLE} AS title,
  CAST(CAST(o_orderdate AS DATE) AS STRING) AS received,
  {_NAME} AS name_v, {_EMAIL} AS email_v, {_PHONE} AS phone_v, {_PRODUCT} AS product_v"""
_SECTIONS = f"""{_pick("k", DESCRIPTIONS)}
    || CASE WHEN k % 6 = 1
       THEN ' Write to me at Fallback.' || {KEY} || '@Example.net, please.' ELSE '' END
    || CASE WHEN k % 3 = 0 AND prose IS NOT NULL THEN {NL} || prose ELSE '' END AS description_v,
  {_pick("k * 5 + k / 27".replace("k / 27", "CAST(floor(k / 27) AS BIGINT)"), DETAILS)} AS details_v,
  {_pick("k * 3 + CAST(floor(k / 13) AS BIGINT)", RESOLUTIONS)} AS resolution_v,
  {_pick("k * 7 + CAST(floor(k / 12) AS BIGINT)", ESCALATIONS)} AS escalation_v,
  {_pick("k + CAST(floor(k / 8) AS BIGINT)", SUPPORTING)} AS supporting_v"""
_FORM = f"""
SELECT
  {_KEYS},
  {_FIELDS},
  {_SECTIONS}
FROM joined
"""

_TICKET = (
    f"CASE WHEN k % 7 = 4 THEN 'Ticket: T-' || {KEY} || {NL} || 'This line belongs to nothing.' "
    f"|| {NL} ELSE '' END"
)
_REPEAT = (
    f"CASE WHEN k % 7 = 2 THEN {NL} || {NL} || 'Issue Details: see below' || {NL} || "
    f"'Second note on the same issue.' ELSE '' END"
)
_TAIL = f"CASE WHEN k % 3 = 2 AND prose IS NOT NULL THEN {NL} || prose ELSE '' END"

_PLAIN = _join(
    "title", NL, "'===================='", NL, NL,
    "'Reference: CMP-'", KEY, NL, "'Date Received: '", "received", NL,
    "'Customer Name: '", "name_v", NL, "'Email: '", "email_v", NL,
    "'Phone: '", "phone_v", NL, "'Product / Service: '", "product_v", NL, NL,
    "'Complaint Description:'", NL, "description_v", NL, NL, _TICKET,
    "'Issue Details:'", NL, "details_v", NL, NL,
    "'Resolution Provided:'", NL, "resolution_v", NL, NL,
    "'Escalation:'", NL, "escalation_v", NL, NL,
    "'Supporting Information:'", NL, "supporting_v",
)
_MARKDOWN = _join(
    "'# '", "title", NL, NL,
    "'- **Reference:** CMP-'", KEY, NL, "'- **Customer Name:** '", "name_v", NL,
    "'- **Email:** '", "email_v", NL, "'- **Phone:** '", "phone_v", NL,
    "'- **Product / Service:** '", "product_v", NL, NL,
    "'## Complaint Description'", NL, NL, "description_v", NL, NL,
    "'## **Issue Details**'", NL, NL, "details_v", NL, NL, _TICKET,
    "'## Resolution Provided'", NL, NL, "resolution_v", NL, NL,
    "'**Escalation:** '", "escalation_v", NL, NL,
    "'## Supporting Documents'", NL, NL, "'_'", "supporting_v", "'_'",
)
_WORD = _join(
    "title", NL, "'Complaint Description'", NL, "description_v", NL,
    "'Issue Details'", NL, "details_v", NL, "'Resolution Provided'", NL, "resolution_v", NL,
    "'Escalation'", NL, "escalation_v", NL, "'Supporting Information'", NL, "supporting_v", NL,
    "'Customer Name | '", "name_v", NL, "'Email | '", "email_v", NL,
    "'Phone | '", "phone_v", NL, "'Product / Service | '", "product_v", NL,
    "'Warranty Status | In warranty'",
)
_LOOSE = _join(
    "title", NL, "'raised by : '", "name_v", NL, "'E-MAIL: '", "email_v", NL,
    f"CASE WHEN k % 5 = 0 THEN 'Phone:' || {NL} || 'Mobile: 080-4455-9012' "
    "ELSE 'Contact number: ' || phone_v END", NL,
    "'Service: '", "product_v", NL, "'priority note: '", "o_orderpriority", NL,
    "'Description'", NL, "description_v", NL, "'Action taken: '", "resolution_v", NL,
    "'Details'", NL, "details_v", NL, _TICKET,
    "CASE WHEN k % 8 = 3 THEN '' ELSE 'Escalation Information' || chr(10) || escalation_v END", NL,
    "'Attachments |'", NL, "supporting_v",
)

_JOINED = """
WITH keyed AS (
  SELECT o_orderkey AS k, o_custkey, o_orderdate, o_orderpriority,
         o_orderkey % (SELECT count(*) FROM {part}) AS part_no
  FROM {orders}
)"""
_JOINED_ROWS = """
  SELECT k, o_orderdate, o_orderpriority, coalesce(c_name, '') AS c_name,
         coalesce(c_mktsegment, '') AS c_mktsegment, p_name, p_brand, d.text AS prose
  FROM keyed
  LEFT JOIN {customer} ON c_custkey = o_custkey
  LEFT JOIN {part} ON p_partkey = part_no
  LEFT JOIN {documents} d ON d.doc_id = k
"""
_COMPOSED = f"""
  SELECT k, layout,
    CASE WHEN k % 3 = 1 AND prose IS NOT NULL THEN prose ELSE
      CASE layout WHEN 0 THEN {_PLAIN} WHEN 1 THEN {_MARKDOWN} WHEN 2 THEN {_WORD}
      ELSE {_LOOSE} END || {_REPEAT} || {_TAIL} END AS text
  FROM form
"""
_NAMED = f"""
SELECT
  k,
  'case_' || {KEY} || CASE layout WHEN 0 THEN '.txt' WHEN 1 THEN '.md' WHEN 2 THEN '.docx'
    ELSE '.pdf' END AS source_file,
  CASE layout WHEN 0 THEN 'txt' WHEN 1 THEN 'md' WHEN 2 THEN 'docx' ELSE 'pdf' END AS file_type,
  text,
  CASE WHEN k % 53 = 0 THEN '  ' || {NL} || chr(9) || {NL} || ' '
  ELSE CASE k % 5
    WHEN 0 THEN replace(text, {NL}, chr(13) || {NL})
    WHEN 1 THEN replace(text, {NL}, '  ' || {NL} || {NL} || chr(9) || {NL} || {NL})
    WHEN 2 THEN replace(text, ' ', chr(160))
    WHEN 3 THEN replace(text, {NL}, chr(13))
    ELSE text END END AS raw_text
FROM composed
"""

#: The whole in one statement; ``{orders}`` and the other slots name the tables.
CORPUS_SQL = (
    f"{_JOINED},\njoined AS ({_JOINED_ROWS}),\nform AS ({_FORM}),\ncomposed AS ({_COMPOSED})\n{_NAMED.strip()}\n"
)

TABLES = ("orders", "customer", "part", "documents")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``k, source_file, file_type, text, raw_text``: one form per order."""
    tables = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in TABLES}
    # Composing and reading a form costs far more than moving its order does.
    tables["orders"] = share_out(tables["orders"], "o_orderkey")
    tables["documents"] = share_out(tables["documents"].select("doc_id", "text"), "doc_id")
    joined = spark.sql(_JOINED + _JOINED_ROWS, **tables)
    # Spark makes one method of the projections between two generators, and the JVM only compiles
    # those below 8,000 bytes.
    form = joined
    for part in (_FIELDS, _SECTIONS):
        form = spark.sql(f"SELECT *, {part} FROM {{form}}", form=form)
        form = sealed(form, *(name for name in form.columns if name.endswith("_v")))
    composed = sealed(spark.sql(_COMPOSED.replace("FROM form", "FROM {form}"), form=form), "text")
    return spark.sql(_NAMED.replace("FROM composed", "FROM {composed}"), composed=composed)


def corpus_oracle() -> str:
    """The same text for DuckDB, where the tables are views."""
    return CORPUS_SQL.format(**{name: name for name in TABLES})
