"""One Spark query per operator, over the given tables."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions import contacts, naming, text as tx
from caseloom.operators import drafting, parsing, prompts, report, rule_table, rules, validation
from caseloom.plans import workflow
from caseloom.plans.sealing import sealed
from caseloom.sinks import outputs
from caseloom.sources import documents as docs_source
from caseloom.sources import manifest as listing
from caseloom.storage import settle
from checks.corpus import corpus
from checks.fake_model import MODEL
from checks.spread import spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: Runs of a made-up model. Only the tests use them; they are no queries over the tables.
MODEL_RUNS: dict[str, Query] = {}
c = F.col


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


# --- Inputs the queries share ---------------------------------------------------


def forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).select("k", "source_file", "file_type", "text")


def seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms with the text the rules see as ``d``."""
    return forms(spark, sf_dir).select("k", "source_file", parsing.rule_view(c("text")).alias("d"))


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.with_parsed_form(seen(spark, sf_dir), "d")


def ruled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.with_rule_outcome(parsed(spark, sf_dir))


def extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.with_rule_extraction(seen(spark, sf_dir), "d")


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).select(
        "source_file", "file_type", c("raw_text").alias("text"),
        F.octet_length("raw_text").alias("file_size_bytes"),
    )


def case_key() -> Column:
    return F.regexp_extract("meta.source_file", r"(\d+)", 1).cast("long")


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workflow.process_documents(workflow.load_texts(raw_documents(spark, sf_dir)))


def planned_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cases with some emails and summaries taken away, as failed tasks leave them."""
    df = cases(spark, sf_dir).withColumn("_k", case_key())

    def fails(every: int) -> Column:
        return c("extraction").isNotNull() & (c("_k") % every == 0)

    message = F.lit("planned failure")
    first = F.get("errors", F.lit(0))
    return workflow.finish(
        df.select(
            "meta", "extraction", "usage",
            F.regexp_replace(first, "^ingestion: ", "").alias("load_error"),
            F.when(~fails(31), c("customer_email")).alias("customer_email"),
            F.when(fails(31), message).alias("customer_email_error"),
            F.when(~fails(37), c("case_summary")).alias("case_summary"),
            F.when(fails(37), message).alias("case_summary_error"),
        )
    )


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder listing made of part names: documents, artefacts and foreign types."""
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("/in/"), c("p_partkey").cast("string")).alias("path"),
        F.concat(
            F.expr(
                "CASE p_partkey % 10 WHEN 0 THEN '.' WHEN 1 THEN '~$' WHEN 2 THEN '_' ELSE '' END"
            ),
            c("p_name"), F.lit(" ("), c("p_partkey").cast("string"), F.lit(")"),
            F.expr(
                "CASE p_partkey % 7 WHEN 0 THEN '.TXT' WHEN 1 THEN '.md' WHEN 2 THEN '.tar.pdf' "
                "WHEN 3 THEN '.xlsx' WHEN 4 THEN '' WHEN 5 THEN '.Docx' ELSE '.été' END"
            ),
        ).alias("name"),
        c("p_size").cast("long").alias("length"),
    )


def flat(x: Column, fields: list[str]) -> list[Column]:
    return [x[f].alias(f) for f in fields]


EXTRACTION_FIELDS = [
    "customer_name", "email", "phone_number", "product_or_service", "complaint_category",
    "issue_description", "resolution_provided", "is_complaint", "escalation_required",
    "supporting_document_available", "overall_case_status", "priority", "customer_sentiment",
    "extraction_notes",
]
SUMMARY_FIELDS = [name for name, _ in fv.SUMMARY_TITLES]


# --- Scans and sources ----------------------------------------------------------


@query
def discover(spark, sf_dir):
    return listing.discover(file_names(spark, sf_dir)).select(
        "name", "file_type", "ignored", "eligible", "skipped"
    )


@query
def eligible(spark, sf_dir):
    return listing.eligible_files(listing.discover(file_names(spark, sf_dir))).select("name")


@query
def skipped(spark, sf_dir):
    return listing.skipped_files(listing.discover(file_names(spark, sf_dir)))


@query
def skipped_by_anti_join(spark, sf_dir):
    files = listing.discover(file_names(spark, sf_dir)).where(~c("ignored"))
    return files.join(listing.eligible_files(files).select("path"), "path", "left_anti").select("name")


@query
def limited_run(spark, sf_dir):
    files = listing.discover(file_names(spark, sf_dir))
    return listing.eligible_files(files, limit=25).select("name", "length")


@query
def scan_text(spark, sf_dir):
    content = F.when(c("k") % 2 == 0, F.encode("text", "UTF-8")).otherwise(
        F.encode("text", "ISO-8859-1")
    )
    df = forms(spark, sf_dir).select("source_file", content.alias("content"))
    return df.select("source_file", docs_source.decode_text(c("content")).alias("text"))


def _docx(paragraphs: list[str], cells: list[str]) -> bytes:
    """A Word file with paragraphs and a one-row table."""
    def escape(s: str) -> str:
        return s.replace("&", "&amp;").replace("<", "&lt;")

    def para(s: str) -> str:
        return f'<w:p><w:r><w:t xml:space="preserve">{escape(s)}</w:t></w:r></w:p>'

    body = "<w:tbl><w:tr>" + "".join(f"<w:tc>{para(x)}</w:tc>" for x in cells) + "</w:tr></w:tbl>"
    body += "".join(para(x) for x in paragraphs)
    ns = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        z.writestr(
            "word/document.xml",
            f'<?xml version="1.0" encoding="UTF-8"?><w:document xmlns:w="{ns}"><w:body>{body}'
            "</w:body></w:document>",
        )
    return held.getvalue()


def _contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File contents of four kinds, as a folder scan hands them on."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            data = []
            for k, who, seg in zip(b["c_custkey"], b["c_name"], b["c_mktsegment"]):
                kind = k % 4
                if kind == 0:
                    data.append(_docx([f"Case of {who}", "Über & out"], ["Customer Name", f" {who} "]))
                else:
                    data.append(f"Name: {who}\nItem: {seg}".encode())
            suffix = b["c_custkey"].map(lambda k: (".docx", ".docx", ".rtf", ".txt")[k % 4])
            yield pd.DataFrame(
                {
                    "name": "f" + b["c_custkey"].astype(str) + suffix,
                    "length": [len(x) for x in data],
                    "content": data,
                    "load_error": None,
                }
            )

    schema = "name string, length long, content binary, load_error string"
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return customers.mapInPandas(pack, schema)


@query
def scan_docx(spark, sf_dir):
    from caseloom.sources.extractors import BUILT_IN

    files = _contents(spark, sf_dir).where(c("name").endswith(".docx"))
    return docs_source.scan_with_extractors(files, BUILT_IN).select("source_file", "raw", "load_error")


@query
def extract_document_text(spark, sf_dir):
    from caseloom.sources.extractors import BUILT_IN

    files = _contents(spark, sf_dir)
    native = naming.suffix(c("name")).isin(*docs_source.TEXT_SUFFIXES)
    both = docs_source.scan_text(files.where(native)).unionByName(
        docs_source.scan_with_extractors(files.where(~native), BUILT_IN)
    )
    return workflow.load_texts(both.withColumnRenamed("raw", "text")).select(
        "source_file", "text", "load_error"
    )


@query
def table_source(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc_"), c("doc_id").cast("string"), F.lit(".txt")).alias("source_file"), "text"
    )
    done = workflow.process_documents(workflow.load_texts(docs))
    return done.select(
        c("meta.source_file"), "status", *flat(c("extraction"), EXTRACTION_FIELDS)
    )


# --- Projections and filters ----------------------------------------------------


@query
def case_id(spark, sf_dir):
    return file_names(spark, sf_dir).select("name", naming.case_id(c("name")).alias("case_id"))


@query
def document_meta(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc "), c("doc_id").cast("string"), F.lit(".txt")).alias("source_file"), "text"
    )
    return workflow.with_meta(docs).select("meta.*").drop("ingested_at")


@query
def truncate(spark, sf_dir):
    limit = 2_000
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        workflow.truncate(c("text"), limit).alias("kept"),
        workflow.is_truncated(c("text"), limit).alias("truncated"),
    )


@query
def display_name(spark, sf_dir):
    return extracted(spark, sf_dir).select(
        "source_file", drafting.display_name(c("extraction")).alias("display_name")
    )


@query
def email_topic(spark, sf_dir):
    return extracted(spark, sf_dir).select(
        "source_file", drafting.email_topic(c("extraction")).alias("topic")
    )


@query
def total_duration(spark, sf_dir):
    durations = F.create_map(
        F.lit("extraction"), c("o_totalprice") / 1000.0,
        F.lit("customer_email"), c("o_custkey") / 7.0,
        F.lit("case_summary"), c("o_orderkey") / 9.0,
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", report.total_duration(durations).alias("seconds")
    )


@query
def failed_record(spark, sf_dir):
    done = cases(spark, sf_dir)
    return done.where(c("status") == "FAILED").select(
        "meta.case_id", "meta.source_file", "meta.file_type", "meta.file_size_bytes",
        "meta.char_count", F.array_join("errors", " | ").alias("errors"),
    )


@query
def empty_text(spark, sf_dir):
    return workflow.load_texts(raw_documents(spark, sf_dir)).where(
        c("load_error").isNotNull()
    ).select("source_file", "load_error")


@query
def has_extraction(spark, sf_dir):
    return cases(spark, sf_dir).where(c("extraction").isNotNull()).select(
        "meta.source_file", c("customer_email").isNotNull().alias("has_email")
    )


@query
def enquiry_predicate(spark, sf_dir):
    own = seen(spark, sf_dir).select("source_file", F.lower("d").alias("low"))
    prose = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc_"), c("doc_id").cast("string")).alias("source_file"),
        F.lower("text").alias("low"),
    )
    return own.unionByName(prose).select("source_file", rules.is_enquiry("low").alias("enquiry"))


# --- Text normalisation and parsing ---------------------------------------------


@query
def normalise(spark, sf_dir):
    return corpus(spark, sf_dir).select("source_file", tx.normalise(c("raw_text")).alias("text"))


@query
def normalise_unicode(spark, sf_dir):
    """Texts with ligatures, full-width letters and combining marks become what they were without."""
    odd = c("text")
    for plain, other in (("fi", "\ufb01"), ("T", "\uff34"), ("e", "\uff45"), ("\u00e9", "e\u0301"), ("\u00f1", "n\u0303")):
        odd = F.replace(odd, F.lit(plain), F.lit(other))
    return table(spark, sf_dir, "documents").select("doc_id", tx.normalise(odd).alias("text"))


@query
def collapse_ws(spark, sf_dir):
    return corpus(spark, sf_dir).select("source_file", tx.collapse_ws(c("raw_text")).alias("text"))


def _field_lines(spark, sf_dir) -> DataFrame:
    lines = forms(spark, sf_dir).select(
        "source_file", F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )
    return lines.select(
        "source_file", c("line_no").cast("long").alias("line_no"), "line",
        F.regexp_extract("line", r"[:|](.*)$", 1).alias("value"),
    )


@query
def blank_to_none(spark, sf_dir):
    return _field_lines(spark, sf_dir).select(
        "source_file", "line_no", tx.blank_to_none(c("value")).alias("value")
    )


@query
def clean_value(spark, sf_dir):
    return _field_lines(spark, sf_dir).select(
        "source_file", "line_no", tx.clean_value(c("value")).alias("value")
    )


@query
def split_lines(spark, sf_dir):
    found = corpus(spark, sf_dir).select("source_file", tx.split_lines(c("raw_text")).alias("lines"))
    return (
        sealed(found, "lines")
        .select("source_file", F.posexplode("lines").alias("line_no", "line"))
        .select("source_file", c("line_no").cast("long").alias("line_no"), "line")
    )


@query
def classify_line(spark, sf_dir):
    found = seen(spark, sf_dir).select("source_file", parsing.classify_lines(c("d")).alias("events"))
    events = sealed(found, "events").select(
        "source_file", F.posexplode("events").alias("event_no", "e")
    )
    return events.select("source_file", c("event_no").cast("long").alias("event_no"), "e.*")


@query
def canonical_label(spark, sf_dir):
    label = F.regexp_extract("line", r"^(?:- \*\*)?([A-Za-z /-]+?)\s*[:|]", 1)
    return _field_lines(spark, sf_dir).select(
        "source_file", "line_no", parsing.canonical_label(label).alias("canonical")
    )


@query
def parse_fields(spark, sf_dir):
    chunks = seen(spark, sf_dir).select("source_file", parsing.event_chunks(c("d")).alias("chunks"))
    fields = chunks.select("source_file", parsing.parse_fields(c("chunks")).alias("f"))
    return sealed(fields, "f").select("source_file", F.explode("f").alias("field", "value"))


@query
def parse_sections(spark, sf_dir):
    chunks = seen(spark, sf_dir).select("source_file", parsing.event_chunks(c("d")).alias("chunks"))
    sections = chunks.select("source_file", parsing.parse_sections(c("chunks")).alias("s"))
    return sealed(sections, "s").select("source_file", F.explode("s").alias("section", "body"))


@query
def extract_block(spark, sf_dir):
    prompt = prompts.prompt_extraction(c("source_file"), c("text"))
    return forms(spark, sf_dir).select(
        "source_file",
        parsing.extract_block(prompt, "document").alias("document"),
        parsing.extract_block(prompt, "extracted_data").alias("nothing"),
    )


@query
def scan_email(spark, sf_dir):
    own = parsed(spark, sf_dir).select(
        "source_file", contacts.scan_email(c("f_email"), c("d")).alias("found")
    )
    prose = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc_"), c("doc_id").cast("string")).alias("source_file"),
        contacts.scan_email(F.lit(""), c("text")).alias("found"),
    )
    return own.unionByName(prose)


@query
def scan_phone(spark, sf_dir):
    own = parsed(spark, sf_dir).select("source_file", contacts.scan_phone(c("f_phone")).alias("found"))
    prose = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc_"), c("doc_id").cast("string")).alias("source_file"),
        contacts.scan_phone(c("text")).alias("found"),
    )
    return own.unionByName(prose)


@query
def pick_issue(spark, sf_dir):
    own = parsed(spark, sf_dir).select(
        "source_file",
        rules.pick_issue(c("s_description"), c("s_issue_details"), c("d")).alias("issue"),
    )
    prose = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc_"), c("doc_id").cast("string")).alias("source_file"),
        rules.pick_issue(F.lit(""), F.lit(""), tx.strip(c("text"))).alias("issue"),
    )
    return own.unionByName(prose)


@query
def issue_excerpt(spark, sf_dir):
    """The excerpt lengths that a caller may ask for."""
    issue = rules.pick_issue(F.lit(""), F.lit(""), tx.strip(c("text")), max_chars=800, opening_chars=300)
    return table(spark, sf_dir, "documents").select("doc_id", issue.alias("issue"))


@query
def longest_line(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return turns.select(
        "conv_id", "turn", rules.longest_prose_line(c("text")).alias("line")
    )


@query
def build_notes(spark, sf_dir):
    fields = {n: c(f"f_{n}") for n in rules.FORM_FIELDS}
    return parsed(spark, sf_dir).select(
        "source_file", rules.build_notes(fields, c("s_resolution")).alias("notes")
    )


# --- Rules ----------------------------------------------------------------------


@query
def subject_text(spark, sf_dir):
    return parsed(spark, sf_dir).select("source_file", "subject")


@query
def score_category(spark, sf_dir):
    scores = parsed(spark, sf_dir).select(
        "source_file", F.explode(rules.category_scores("subject")).alias("s")
    )
    return scores.select(
        "source_file", "s.category", c("s.score").cast("long").alias("score")
    ).where("score > 0")


def _rule_rows(spark) -> DataFrame:
    return spark.createDataFrame(
        list(fv.CATEGORY_KEYWORDS), "category string, keyword string, weight long"
    )


@query
def keyword_score(spark, sf_dir):
    return rule_table.keyword_scores(
        parsed(spark, sf_dir).select("source_file", "subject"), _rule_rows(spark), "source_file", "subject"
    )


@query
def category_native(spark, sf_dir):
    return parsed(spark, sf_dir).select(
        "source_file", rules.top_category(rules.category_scores("subject")).alias("category")
    )


@query
def category_rules_join(spark, sf_dir):
    return rule_table.top_categories(
        parsed(spark, sf_dir).select("source_file", "subject"), _rule_rows(spark), "source_file", "subject"
    )


@query
def decide_escalation(spark, sf_dir):
    return ruled(spark, sf_dir).select("source_file", "escalated")


@query
def decide_status(spark, sf_dir):
    return ruled(spark, sf_dir).select("source_file", "case_status")


@query
def decide_sentiment(spark, sf_dir):
    return ruled(spark, sf_dir).select("source_file", "sentiment")


@query
def decide_priority(spark, sf_dir):
    return ruled(spark, sf_dir).select("source_file", "priority")


@query
def supporting_document(spark, sf_dir):
    return ruled(spark, sf_dir).select("source_file", "supporting")


@query
def contains_any(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    words = ("app", "ser", "ion la", "not a complaint")
    turns = turns.select("conv_id", "turn", F.lower("text").alias("low"))
    return turns.select("conv_id", "turn", tx.contains_any("low", words).alias("hit"))


@query
def extraction(spark, sf_dir):
    return extracted(spark, sf_dir).select("source_file", "extraction.*")


# --- Validation -----------------------------------------------------------------


@query
def validate_email(spark, sf_dir):
    return _field_lines(spark, sf_dir).select(
        "source_file", "line_no", contacts.valid_email(c("value")).alias("email")
    )


@query
def validate_phone(spark, sf_dir):
    return _field_lines(spark, sf_dir).select(
        "source_file", "line_no", contacts.valid_phone(c("value")).alias("phone")
    )


def _answers(spark, sf_dir) -> DataFrame:
    """Records as JSON, some of them broken in one way each."""
    good = extracted(spark, sf_dir).select(
        "k", "source_file", prompts.extraction_json(c("extraction")).alias("j")
    )
    broken = F.expr(
        r"""CASE k % 20
          WHEN 0 THEN replace(j, '"customer_name"', '"customer"')
          WHEN 1 THEN replace(j, '"Low"', '"Lowest"')
          WHEN 2 THEN substring(j, 1, length(j) - 1)
          WHEN 3 THEN replace(j, ': true', ': "yes"')
          WHEN 4 THEN replace(j, ': false', ': "perhaps"')
          WHEN 5 THEN '[1, 2]'
          WHEN 6 THEN replace(replace(j, '"priority"', '"prio"'), '"email": ', '"email": 5, "mail": ')
          ELSE j END"""
    )
    return good.select("source_file", broken.alias("answer"))


@query
def read_responses(spark, sf_dir):
    done = validation.read_responses(_answers(spark, sf_dir), "extraction", "answer")
    return done.select(
        "source_file",
        F.array_join("extraction_violations", "; ").alias("violations"),
        *flat(c("extraction"), EXTRACTION_FIELDS),
    )


def _order_answers(spark, sf_dir, sql: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", F.expr(sql).alias("answer"))


EMAIL_ANSWER = (
    """'{"subject": "' || CASE o_orderkey % 5 WHEN 0 THEN '  ' ELSE '  Order   ' || """
    """CAST(o_orderkey AS STRING) END || '", "greeting": "Dear  you,", "body_paragraphs": ' || """
    """CASE o_orderkey % 7 WHEN 0 THEN '[]' WHEN 1 THEN '[" ", "  "]' WHEN 2 THEN '"text"' """
    """WHEN 3 THEN '["a", 1]' WHEN 4 THEN '["a", null]' ELSE '["One  line", " ", "' || """
    """o_orderpriority || ' "]' END || ', "closing": ' || CASE o_orderkey % 11 WHEN 0 THEN 'null' """
    """WHEN 1 THEN '7' ELSE '"Kind   regards,"' END || CASE o_orderkey % 13 WHEN 0 THEN '' ELSE """
    """', "sender_name": "Team"' END || '}'"""
)
SUMMARY_ANSWER = (
    """'{"case_overview": "Order  ' || CAST(o_orderkey AS STRING) || '", "key_issue": ' || """
    """CASE o_orderkey % 5 WHEN 0 THEN '""' WHEN 1 THEN 'true' WHEN 2 THEN '{"a": "b"}' """
    """ELSE '" key "' END || ', "action_taken": "x", "current_status": "' || o_orderstatus || '"' """
    """|| CASE o_orderkey % 7 WHEN 0 THEN '' ELSE ', "recommended_next_action": "go"' END || '}'"""
)


@query
def email_parts(spark, sf_dir):
    df = _order_answers(spark, sf_dir, EMAIL_ANSWER)
    done = validation.read_responses(df, "customer_email", "answer")
    e = c("customer_email")
    return done.select(
        "o_orderkey",
        F.array_join("customer_email_violations", "; ").alias("violations"),
        *flat(e, ["subject", "greeting", "closing", "sender_name"]),
        F.array_join(e["body_paragraphs"], "|").alias("paragraphs"),
    )


@query
def summary_parts(spark, sf_dir):
    df = _order_answers(spark, sf_dir, SUMMARY_ANSWER)
    done = validation.read_responses(df, "case_summary", "answer")
    return done.select(
        "o_orderkey",
        F.array_join("case_summary_violations", "; ").alias("violations"),
        *flat(c("case_summary"), SUMMARY_FIELDS),
    )


# --- Derived texts --------------------------------------------------------------


def drafted(spark, sf_dir) -> DataFrame:
    x = c("extraction")
    return extracted(spark, sf_dir).select(
        "k", "source_file", "extraction",
        drafting.build_email(x).alias("e"), drafting.build_summary(x).alias("s"),
    )


@query
def build_email(spark, sf_dir):
    return drafted(spark, sf_dir).select(
        "source_file", "e.subject", "e.greeting", "e.closing", "e.sender_name",
        F.array_join("e.body_paragraphs", "|").alias("paragraphs"),
    )


@query
def build_summary(spark, sf_dir):
    return drafted(spark, sf_dir).select("source_file", "s.*")


@query
def render_email(spark, sf_dir):
    return drafted(spark, sf_dir).select("source_file", drafting.render_email(c("e")).alias("text"))


@query
def render_summary(spark, sf_dir):
    return drafted(spark, sf_dir).select("source_file", drafting.render_summary(c("s")).alias("text"))


@query
def prompt_extraction(spark, sf_dir):
    return forms(spark, sf_dir).select(
        "source_file", prompts.prompt_extraction(c("source_file"), c("text")).alias("prompt")
    )


@query
def prompt_email(spark, sf_dir):
    record = prompts.extraction_json(c("extraction"))
    return extracted(spark, sf_dir).select(
        "source_file", prompts.prompt_email(c("source_file"), c("d"), record).alias("prompt")
    )


@query
def prompt_summary(spark, sf_dir):
    record = prompts.extraction_json(c("extraction"))
    return extracted(spark, sf_dir).select(
        "source_file", prompts.prompt_summary(c("source_file"), c("d"), record).alias("prompt")
    )


# --- Inference ------------------------------------------------------------------


def _by_model(spark, sf_dir, task_mode: str) -> DataFrame:
    texts = workflow.load_texts(raw_documents(spark, sf_dir))
    return workflow.process_documents(texts, MODEL, task_mode=task_mode)


def _model_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "meta.source_file", "status", F.array_join("errors", " | ").alias("errors"),
        *flat(c("extraction"), EXTRACTION_FIELDS),
        c("customer_email.subject").alias("subject"),
        F.array_join("customer_email.body_paragraphs", "|").alias("paragraphs"),
        c("case_summary.case_overview").alias("case_overview"),
        "usage.calls", "usage.prompt_tokens", "usage.completion_tokens",
        F.array_join(F.array_sort(F.map_keys("task_durations_seconds")), ",").alias("timed"),
    )


def generate_structured(spark, sf_dir):
    return _model_columns(_by_model(spark, sf_dir, "parallel"))


def generate_structured_sequential(spark, sf_dir):
    return _model_columns(_by_model(spark, sf_dir, "sequential"))


MODEL_RUNS.update(
    generate_structured=generate_structured,
    generate_structured_sequential=generate_structured_sequential,
)


# --- Workflow, joins, aggregations, report --------------------------------------


@query
def process_documents(spark, sf_dir):
    done = cases(spark, sf_dir)
    return done.select(
        "meta.case_id", "meta.source_file", "status", "meta.char_count", "meta.truncated",
        *flat(c("extraction"), EXTRACTION_FIELDS),
        c("customer_email.subject").alias("subject"),
        c("case_summary.recommended_next_action").alias("recommended_next_action"),
        "usage.prompt_tokens",
    )


@query
def case_status(spark, sf_dir):
    return planned_cases(spark, sf_dir).select(
        "meta.source_file", "status", F.array_join("errors", " | ").alias("errors")
    )


@query
def task_results_to_record(spark, sf_dir):
    whole = cases(spark, sf_dir).select(c("meta.source_file").alias("source_file"), "status")
    # Both come of the same drafts, which are written so that the forms are not read for each.
    drafts = settle(
        drafted(spark, sf_dir).select("k", "source_file", "e.subject", "s.current_status"), "drafts"
    )
    mails = drafts.where(c("k") % 3 != 0).select("source_file", "subject")
    notes = drafts.where(c("k") % 5 != 0).select("source_file", "current_status")
    return workflow.assemble(whole, mails, notes, "source_file")


@query
def manifest_to_content(spark, sf_dir):
    files = table(spark, sf_dir, "orders").select(c("o_orderkey").alias("path"))
    contents = table(spark, sf_dir, "documents").select(c("doc_id").alias("path"), "text")
    return listing.attach_content(files, contents, "path").select(
        "path", "text", c("text").isNull().alias("unread")
    )


@query
def count_by_status(spark, sf_dir):
    return report.count_by_status(planned_cases(spark, sf_dir))


@query
def token_usage(spark, sf_dir):
    return report.token_usage(cases(spark, sf_dir))


@query
def run_outcome(spark, sf_dir):
    return report.run_outcome(planned_cases(spark, sf_dir))


@query
def run_manifest(spark, sf_dir):
    gone = listing.skipped_files(listing.discover(file_names(spark, sf_dir)))
    return report.run_counts(planned_cases(spark, sf_dir), gone)


@query
def error_list(spark, sf_dir):
    return report.error_list(planned_cases(spark, sf_dir)).select("case_id", "source_file", "error")


@query
def case_id_collisions(spark, sf_dir):
    names = table(spark, sf_dir, "part").select(
        F.struct(
            naming.case_id(c("p_name")).alias("case_id"),
            F.concat("p_name", F.lit("."), c("p_partkey").cast("string")).alias("source_file"),
        ).alias("meta")
    )
    return report.case_id_collisions(names)


@query
def report_rows(spark, sf_dir):
    # A sort samples its input first; from a written table that does not parse twice.
    rows = settle(report.report(planned_cases(spark, sf_dir)), "report")
    return report.stable_order(rows)


@query
def summary_view(spark, sf_dir):
    return report.summary_view(planned_cases(spark, sf_dir))


@query
def structured_rows(spark, sf_dir):
    return outputs.structured(planned_cases(spark, sf_dir)).select(
        "case_id", "source_file", "processing_status", "metadata.file_size_bytes",
        F.array_join("errors", " | ").alias("errors"),
        c("extraction.priority").alias("priority"),
    )


@query
def email_texts(spark, sf_dir):
    return outputs.emails(planned_cases(spark, sf_dir))


@query
def summary_texts(spark, sf_dir):
    return outputs.summaries(planned_cases(spark, sf_dir))
