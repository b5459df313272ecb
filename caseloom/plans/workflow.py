"""From a table of documents to a table of cases.

Input columns: ``source_file`` and ``text``; optionally ``file_type``,
``file_size_bytes`` and ``load_error``. Output: one row per input row, schema
``schemas.CASES``. With the rules the whole plan is one narrow stage: it reads,
projects and writes, and never shuffles, so it scales with the input splits and
also runs on a streaming table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions import naming
from caseloom.functions.text import normalise_column
from caseloom.operators import prompts as p
from caseloom.operators.drafting import build_email, build_summary
from caseloom.operators.inference import (
    PAIR_SECONDS,
    Model,
    Request,
    check_replies,
    generate_structured,
)
from caseloom.operators.parsing import rule_view
from caseloom.operators.rules import with_rule_extraction
from caseloom.plans.sealing import sealed
from caseloom.schemas import CASES, META, USAGE
from caseloom.storage import new_table_path, settle

RULES = "rules"
RULES_MODEL = "offline-rule-based"
TASK_MODES = ("sequential", "parallel")


def load_texts(df: DataFrame) -> DataFrame:
    """Normalise ``text``; documents without any get a ``load_error`` instead."""
    df = normalise_column(df.withColumn("text", F.coalesce("text", F.lit(""))), "text")
    earlier = F.col("load_error") if "load_error" in df.columns else F.lit(None).cast("string")
    empty = F.when(
        F.col("text") == "", F.concat(F.col("source_file"), F.lit(fv.EMPTY_DOCUMENT_SUFFIX))
    )
    return sealed(df.withColumn("load_error", F.coalesce(earlier, empty)), "text", "load_error")


def truncate(text: Column, max_chars: int | None) -> Column:
    """The opening ``max_chars`` characters; the whole text without a limit."""
    return text if max_chars is None else F.substring(text, 1, max_chars)


def is_truncated(text: Column, max_chars: int | None) -> Column:
    return F.lit(False) if max_chars is None else F.char_length(text) > max_chars


def with_meta(df: DataFrame, max_chars: int | None = None) -> DataFrame:
    """``source_file, text (cut to max_chars), load_error, meta``.

    ``meta.char_count`` is the length before the cut, 0 for unreadable documents.
    """
    have = df.columns
    name, text = F.col("source_file"), F.col("text")
    error = F.col("load_error") if "load_error" in have else F.lit(None).cast("string")
    readable = error.isNull()
    kind = F.col("file_type") if "file_type" in have else naming.file_type(name)
    size = F.col("file_size_bytes") if "file_size_bytes" in have else F.octet_length(text)
    parts = {
        "case_id": naming.case_id(name),
        "source_file": name,
        "file_type": kind,
        "file_size_bytes": F.coalesce(size.cast("long"), F.lit(0)),
        "char_count": F.when(readable, F.char_length(text)).otherwise(0),
        "truncated": readable & is_truncated(text, max_chars),
        "ingested_at": F.current_timestamp(),
    }
    meta = F.struct(*(parts[f.name].cast(f.dataType).alias(f.name) for f in META.fields))
    return df.select(
        name,
        F.when(readable, truncate(text, max_chars)).alias("text"),
        error.alias("load_error"),
        meta.alias("meta"),
    )


def process_documents(
    df: DataFrame,
    provider: str | Model = RULES,
    *,
    max_chars: int | None = None,
    task_mode: str = "parallel",
    workers: int | None = None,
) -> DataFrame:
    """Run the three tasks over every document.

    Whole texts are read unless ``max_chars`` is given, to bound what a model is paid for.

    The rules are lazy. A ``Model`` runs at once: every stage of model calls is
    written to the shared folder before the next one reads it, so that no call is
    made twice.
    """
    if task_mode not in TASK_MODES:
        raise ValueError(f"task_mode must be one of {TASK_MODES}")
    if max_chars is not None and max_chars < 1:
        raise ValueError("max_chars must be positive")
    df = with_meta(df, max_chars)
    if isinstance(provider, Model):
        return _by_model(df, provider, task_mode == "parallel", workers)
    if provider == RULES:
        return _by_rules(df)
    raise ValueError(f"unknown provider {provider!r}: use 'rules' or a Model")


def _by_rules(df: DataFrame) -> DataFrame:
    df = df.select("*", rule_view(F.col("text")).alias("_document"))
    df = with_rule_extraction(df, "_document", into="_record")
    df = df.select(
        "*", F.when(F.col("load_error").isNull(), F.col("_record")).alias("extraction")
    )
    x = F.col("extraction")
    # Lengths that the usage names more than once.
    df = df.select(
        "*",
        (F.char_length("source_file") + F.char_length("text")).alias("_chars"),
        p.extraction_json_length(x).alias("_record_chars"),
    )
    return finish(
        df.select(
            "meta", "load_error", "extraction",
            # The rules draft both texts for every record.
            F.when(x.isNull(), "FAILED").otherwise("SUCCESS").alias("status"),
            build_email(x).alias("customer_email"),
            build_summary(x).alias("case_summary"),
            p.estimated_usage(x.isNotNull(), F.col("_chars"), F.col("_record_chars")).alias("usage"),
        )
    )


def _by_model(df: DataFrame, model: Model, parallel: bool, workers: int | None) -> DataFrame:
    name, text = F.col("source_file"), F.col("text")
    ledger = new_table_path(df.sparkSession, "ledger") if model.ledger is True else model.ledger or None
    # Task 1. Rows that could not be read have no text, so they get no prompt.
    df = df.select("*", p.prompt_extraction(name, text).alias("_prompt"))
    first = Request("extraction", p.EXTRACTION_INSTRUCTIONS, "_prompt")
    if workers is not None:
        # Of a written table the partitions are known before any task runs.
        df = settle(df, "asked")
    df = generate_structured(df, [first], model, workers=workers, ledger=ledger).drop("_prompt", PAIR_SECONDS)
    df = check_replies(settle(df, "extraction"), "extraction", model.name)

    # Tasks 2 and 3 read the validated record, so rows without one get no prompt.
    df = df.select("*", p.extraction_json(F.col("extraction")).alias("_json"))
    json = F.col("_json")
    df = df.select(
        "*",
        p.prompt_email(name, text, json).alias("_email_prompt"),
        p.prompt_summary(name, text, json).alias("_summary_prompt"),
    ).drop("text", "_json")
    later = [
        Request("customer_email", p.EMAIL_INSTRUCTIONS, "_email_prompt"),
        Request("case_summary", p.SUMMARY_INSTRUCTIONS, "_summary_prompt"),
    ]
    df = generate_structured(df, later, model, parallel=parallel, workers=workers, ledger=ledger)
    df = settle(df.drop("_email_prompt", "_summary_prompt"), "artefacts")
    for task in ("customer_email", "case_summary"):
        df = check_replies(df, task, model.name)
    return finish(_with_model_facts(df, parallel))


def _with_model_facts(df: DataFrame, parallel: bool) -> DataFrame:
    replies = [F.col(f"{t}_reply") for t in ("extraction", "customer_email", "case_summary")]

    def total(part: str) -> Column:
        return sum((F.coalesce(r[part], F.lit(0)) for r in replies), F.lit(0)).cast("long")

    extraction, email, summary = replies
    entries = [(F.lit("extraction"), extraction["seconds"])]
    if parallel:
        pair = F.when(email.isNotNull(), F.col(PAIR_SECONDS))
        entries.append((F.lit("downstream_tasks_parallel"), pair))
    else:
        entries.append((F.lit("customer_email"), email["seconds"]))
        entries.append((F.lit("case_summary"), summary["seconds"]))
    listed = F.array(*(F.struct(k.alias("key"), v.alias("value")) for k, v in entries))
    durations = F.map_from_entries(F.filter(listed, lambda e: e["value"].isNotNull()))
    usage = F.struct(
        total("calls").alias("calls"),
        total("prompt_tokens").alias("prompt_tokens"),
        total("completion_tokens").alias("completion_tokens"),
    )
    return df.select("*", durations.alias("durations"), usage.cast(USAGE).alias("usage"))


def case_status(extraction: Column, email: Column, summary: Column) -> Column:
    return (
        F.when(extraction.isNull(), "FAILED")
        .when(email.isNotNull() & summary.isNotNull(), "SUCCESS")
        .otherwise("PARTIAL")
    )


def task_errors(**messages: Column) -> Column:
    """``"<task>: <message>"`` for every message there is, in the order given."""
    return F.array_compact(
        F.array(*(F.concat(F.lit(f"{task}: "), said) for task, said in messages.items()))
    )


def finish(df: DataFrame) -> DataFrame:
    """Grade the rows and shape them as ``schemas.CASES``.

    Reads ``meta extraction customer_email case_summary usage`` and, where present,
    ``load_error``, ``<task>_error``, ``durations`` and ``status``. Nothing is sealed here,
    so a filter or a narrow selection on the result leaves out what it doesn't need.
    """
    have = df.columns

    def said(column: str) -> Column:
        return F.col(column) if column in have else F.lit(None).cast("string")

    errors = task_errors(
        ingestion=said("load_error"),
        extraction=said("extraction_error"),
        customer_email=said("customer_email_error"),
        case_summary=said("case_summary_error"),
    )
    durations = F.col("durations") if "durations" in have else F.create_map()
    made = case_status(F.col("extraction"), F.col("customer_email"), F.col("case_summary"))
    parts = {
        "meta": F.col("meta"),
        "status": F.col("status") if "status" in have else made,
        "extraction": F.col("extraction"),
        "customer_email": F.col("customer_email"),
        "case_summary": F.col("case_summary"),
        "errors": errors,
        "task_durations_seconds": durations,
        "usage": F.col("usage"),
    }
    # ``meta`` has its type already; a cast would keep filters on its fields from the scan.
    return df.select(
        *(
            parts[f.name] if f.name == "meta" else parts[f.name].cast(f.dataType).alias(f.name)
            for f in CASES.fields
        )
    )


def assemble(cases: DataFrame, emails: DataFrame, summaries: DataFrame, key: str) -> DataFrame:
    """Join task results that were computed as separate jobs onto the case rows.

    Only narrow result columns are joined; document text stays where it is.
    """
    return cases.join(emails, key, "left").join(summaries, key, "left")
