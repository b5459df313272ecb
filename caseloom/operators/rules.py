"""The rule provider: decision tables as native column expressions.

``with_parsed_form`` and ``with_rule_outcome`` add working columns in layers. Each
layer is its own ``select`` and nothing filters on a derived column, so Catalyst
keeps one copy of the parsed form and every later rule reads it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions.contacts import scan_email, scan_phone, valid_email, valid_phone
from caseloom.functions.text import (
    LINE_BREAK,
    clean_trimmed,
    collapse_column,
    contains_any,
    drop_line_ends,
    placeholder_to_none,
    plain_ends,
    sql_text,
    strip,
)
from caseloom.operators.parsing import listed_text, listed_value, marked_chunks, marked_events
from caseloom.plans.sealing import sealed

MARKED, CHUNKS = "_marked", "_chunks"
FORM_FIELDS = ("name", "email", "phone", "product")
#: What goes around the working columns of a layer.
Layer = Callable[[DataFrame], DataFrame]


def _as_it_is(df: DataFrame) -> DataFrame:
    return df


def subject_text(description: Column, issue_details: Column, lower_document: Column) -> Column:
    """What the case is about: the complaint itself, never its resolution."""
    stated = F.lower(F.concat_ws(" ", description, issue_details))
    both = plain_ends(description) & plain_ends(issue_details)
    # Of two values without blanks around them, as a form has them, an empty one only leaves the blank.
    one = plain_ends(description) & (issue_details == "")
    own = F.when(both, stated).when(one, F.lower(description)).otherwise(strip(stated))
    return F.coalesce(F.nullif(own, F.lit("")), lower_document)


def category_scores(subject: str, keywords=fv.CATEGORY_KEYWORDS) -> Column:
    """``array<struct<score, category>>`` over the categories that have keywords.

    ``keywords`` is a short list of ``(category, keyword, weight)``; ``rule_table`` takes
    tables of any length.
    """
    by_category: dict[str, list[str]] = {}
    for category, keyword, weight in keywords:
        hit = f"IF(contains(`{subject}`, {sql_text(keyword)}), {int(weight)}, 0)"
        by_category.setdefault(category, []).append(hit)
    scored = (
        f"struct({' + '.join(hits)} AS score, {sql_text(category)} AS category)"
        for category, hits in by_category.items()
    )
    return F.expr(f"array({', '.join(scored)})")


def top_category(scores: Column) -> Column:
    """Highest score; on a tie the alphabetically last name; no hit is Other."""
    # Named once, so that the scores are not worked out again for its category.
    best = F.array_max(F.filter(scores, lambda s: s["score"] > 0))
    return F.coalesce(best["category"], F.lit("Other"))


def top_of_column(scores: Column) -> Column:
    """``top_category`` of a column, which may be named twice: no function runs over the scores."""
    best = F.array_max(scores)
    return F.when(best["score"] > 0, F.coalesce(best["category"], F.lit("Other"))).otherwise("Other")


# The decision tables take names of lower-case text columns.


def is_enquiry(document: str) -> Column:
    return contains_any(document, fv.ENQUIRY_MARKERS)


def decide_escalation(escalation: str, description: str) -> Column:
    """A refusal in the escalation section beats everything else."""
    stated = F.col(escalation) != ""
    return (
        F.when(stated & contains_any(escalation, fv.ESCALATION_DENIED), F.lit(False))
        .when(stated & contains_any(escalation, fv.ESCALATION_ASKED), F.lit(True))
        .otherwise(contains_any(description, fv.ESCALATION_IN_DESCRIPTION))
    )


def decide_status(escalated: Column, resolution: str, document: str) -> Column:
    """Pending work is looked for before finished work."""
    return (
        F.when(escalated, "Escalated")
        .when(F.col(resolution) == "", "Open")
        .when(contains_any(resolution, fv.WORK_PENDING), "In Progress")
        .when(contains_any(document, fv.CASE_CLOSED), "Closed")
        .when(contains_any(resolution, fv.WORK_DONE), "Resolved")
        .otherwise("In Progress")
    )


def decide_sentiment(subject: str, escalated: Column, enquiry: Column) -> Column:
    angry = F.when(escalated, "Very Negative").otherwise("Negative")
    return (
        F.when(contains_any(subject, fv.STRONGLY_NEGATIVE), "Very Negative")
        .when(contains_any(subject, fv.NEGATIVE), angry)
        .when(enquiry | contains_any(subject, fv.POSITIVE), "Positive")
        .otherwise("Neutral")
    )


def decide_priority(escalated: Column, status: Column, sentiment: Column) -> Column:
    return (
        F.when(escalated & (sentiment == "Very Negative"), "Critical")
        .when(escalated, "High")
        .when(status.isin("Resolved", "Closed"), "Low")
        .otherwise("Medium")
    )


def supporting_document(supporting: str, description: str) -> Column:
    return contains_any(supporting, fv.EVIDENCE_WORDS) | contains_any(
        description, fv.EVIDENCE_IN_DESCRIPTION
    )


def longest_prose_line(document: Column) -> Column:
    """Longest line that does not look like a label, the first one on ties."""

    def rank(line: Column, position: Column) -> Column:
        bare = strip(line)
        prose = (F.char_length(bare) > fv.PROSE_MIN_CHARS) & ~F.substring(
            line, 1, fv.PROSE_LABEL_WINDOW
        ).contains(":")
        return F.when(
            prose,
            F.struct(F.char_length(bare).alias("size"), (-position).alias("order"), bare.alias("line")),
        )

    return F.array_max(F.transform(F.split(document, LINE_BREAK), rank))["line"]


def pick_issue(
    description: Column, issue_details: Column, document: Column,
    max_chars: int | None = None, opening_chars: int | None = None,
) -> Column:
    """The text that states the issue, whole unless excerpt lengths are given.

    ``opening_chars`` is for the opening of a document that has nothing better.
    """

    def cut(c: Column, limit: int | None = max_chars) -> Column:
        return c if limit is None else F.substring(c, 1, limit)

    long_enough = fv.ISSUE_MIN_CHARS
    opening = strip(cut(document, opening_chars))
    return (
        F.when(F.char_length(description) > long_enough, cut(description))
        .when(F.char_length(issue_details) > long_enough, cut(issue_details))
        .otherwise(
            F.coalesce(
                cut(longest_prose_line(document)),
                F.nullif(opening, F.lit("")),
                F.lit(fv.NO_ISSUE_TEXT),
            )
        )
    )


def build_notes(fields: dict[str, Column], resolution: Column) -> Column:
    """``fields`` and ``resolution`` hold '' for what the document does not state."""
    missing = F.array_compact(
        F.array(*(F.when(fields[name] == "", F.lit(said)) for name, said in fv.NOTE_FIELD_NAMES))
    )
    before, after = fv.NOTE_MISSING
    return F.concat_ws(
        " ",
        F.lit(fv.NOTE_ORIGIN),
        F.when(
            F.size(missing) > 0,
            F.concat(F.lit(before), F.array_join(missing, ", "), F.lit(after)),
        ),
        F.when(resolution == "", F.lit(fv.NOTE_NO_RESOLUTION)),
    )


def with_parsed_form(df: DataFrame, document: str, layer: Layer = _as_it_is) -> DataFrame:
    """Add ``f_*`` (fields), ``s_*`` (sections), ``lower_document`` and ``subject``.

    Missing and blank values are both ''. ``layer`` is put around the working columns in between.
    """
    keep = df.columns
    # Functions over arrays are worked out by an interpreter, so the text they take is made before them.
    df = df.select("*", drop_line_ends(F.col(document)).alias(MARKED))
    df = sealed(df.select(*keep, marked_events(F.col(MARKED)).alias(MARKED)), MARKED)
    df = layer(df.select(*keep, marked_chunks(F.col(MARKED)).alias(CHUNKS)))
    # The parts of the events are named often, so they are made columns first.
    chunks, *parts = (F.col(x) for x in (CHUNKS, "_label", "_value", "_rest"))
    df = layer(df.select("*", *(chunks[part].alias(f"_{part}") for part in ("label", "value", "rest"))))
    empty = F.lit("")
    found = {f"f_{n}": F.coalesce(listed_value(*parts[:2], n), empty) for n in FORM_FIELDS}
    found |= {f"s_{n}": listed_text(chunks, *parts, n) for n in fv.SECTION_LABELS}
    df = layer(df.select(*keep, *(F.trim(text).alias(name) for name, text in found.items())))
    fields = [name for name in found if name.startswith("f_")]
    df = layer(df.withColumns({name: clean_trimmed(F.col(name)) for name in fields}))
    df = df.withColumns({name: clean_trimmed(F.col(name)) for name in found if name not in fields})
    df = layer(df.select(*keep, *found, F.lower(document).alias("lower_document")))
    return df.select(
        "*",
        F.lower("s_description").alias("l_description"),
        F.lower("s_resolution").alias("l_resolution"),
        F.lower("s_escalation").alias("l_escalation"),
        F.lower("s_supporting").alias("l_supporting"),
        subject_text(
            F.col("s_description"), F.col("s_issue_details"), F.col("lower_document")
        ).alias("subject"),
    )


def with_rule_outcome(df: DataFrame, layer: Layer = _as_it_is) -> DataFrame:
    """Add ``enquiry category escalated case_status sentiment priority supporting``."""
    c = F.col
    df = layer(df.select("*", category_scores("subject").alias("scores")))
    df = layer(
        df.select(
            "*",
            is_enquiry("lower_document").alias("enquiry"),
            decide_escalation("l_escalation", "l_description").alias("escalated"),
            supporting_document("l_supporting", "l_description").alias("supporting"),
        )
    )
    df = df.select(
        "*",
        F.when(c("enquiry"), "General Enquiry").otherwise(top_of_column(c("scores"))).alias("category"),
        decide_status(c("escalated"), "l_resolution", "lower_document").alias("case_status"),
        decide_sentiment("subject", c("escalated"), c("enquiry")).alias("sentiment"),
    )
    return df.select(
        "*", decide_priority(c("escalated"), c("case_status"), c("sentiment")).alias("priority")
    )


def with_rule_extraction(df: DataFrame, document: str, into: str = "extraction") -> DataFrame:
    """Add the validated extraction struct, computed by the rules."""
    keep = df.columns
    c = F.col

    def layer(df: DataFrame) -> DataFrame:
        # All of a record is needed, so closing a layer leaves nothing to prune. Spark makes one method
        # of the projections between two generators, and the JVM only compiles those below 8,000 bytes.
        return sealed(df, *(name for name in df.columns if name not in keep))

    df = layer(with_parsed_form(df, document, layer))
    df = layer(with_rule_outcome(df, layer))
    fields = {n: c(f"f_{n}") for n in FORM_FIELDS}
    # Searches of long text get a layer of their own, so that they run once each.
    df = df.select(
        "*",
        scan_email(c("f_email"), c(document)).alias("found_email"),
        scan_phone(c("f_phone")).alias("found_phone"),
        pick_issue(c("s_description"), c("s_issue_details"), c(document)).alias("issue"),
    )
    # Collapsed texts are named more than once, too.
    flat = ("f_name", "found_email", "found_phone", "f_product", "issue", "s_resolution")
    df = layer(df.select("*", *(collapse_column(c(name)).alias(f"flat_{name}") for name in flat)))
    df = df.select(
        *keep,
        placeholder_to_none(c("flat_f_name")).alias("x_name"),
        valid_email(c("flat_found_email"), placeholder_to_none).alias("x_email"),
        valid_phone(c("flat_found_phone"), placeholder_to_none).alias("x_phone"),
        placeholder_to_none(c("flat_f_product")).alias("x_product"),
        c("flat_issue").alias("x_issue"),
        placeholder_to_none(c("flat_s_resolution")).alias("x_resolution"),
        build_notes(fields, c("s_resolution")).alias("x_notes"),
        "enquiry", "category", "escalated", "supporting", "case_status", "priority", "sentiment",
    )
    df = df.select(
        *keep,
        F.struct(
            c("x_name").alias("customer_name"),
            c("x_email").alias("email"),
            c("x_phone").alias("phone_number"),
            c("x_product").alias("product_or_service"),
            c("category").alias("complaint_category"),
            c("x_issue").alias("issue_description"),
            c("x_resolution").alias("resolution_provided"),
            (~c("enquiry")).alias("is_complaint"),
            c("escalated").alias("escalation_required"),
            c("supporting").alias("supporting_document_available"),
            c("case_status").alias("overall_case_status"),
            c("priority").alias("priority"),
            c("sentiment").alias("customer_sentiment"),
            c("x_notes").alias("extraction_notes"),
        ).alias(into),
    )
    return sealed(df, into)
