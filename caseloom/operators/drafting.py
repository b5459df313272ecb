"""The two texts derived from a case: customer email and internal summary."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions.text import collapse_ws, fill


def display_name(x: Column) -> Column:
    """The customer's name, or a neutral stand-in."""
    return F.coalesce(F.nullif(x["customer_name"], F.lit("")), F.lit(fv.DEFAULT_CUSTOMER))


def _product(x: Column) -> Column:
    return F.nullif(x["product_or_service"], F.lit(""))


def _resolution(x: Column) -> Column:
    return F.nullif(x["resolution_provided"], F.lit(""))


def email_topic(x: Column) -> Column:
    return F.coalesce(_product(x), F.lower(x["complaint_category"]))


def build_email(x: Column) -> Column:
    """The email parts for one extraction struct; null in, null out."""
    topic = email_topic(x)
    status = x["overall_case_status"]
    opening = F.when(x["is_complaint"], fill(fv.EMAIL_OPENING_COMPLAINT, topic=topic)).otherwise(
        fill(fv.EMAIL_OPENING_ENQUIRY, topic=topic)
    )
    progress = F.coalesce(
        fill(fv.EMAIL_DONE_SO_FAR, resolution=_resolution(x)), F.lit(fv.EMAIL_STILL_OPEN)
    )
    paragraphs = F.array_compact(
        F.array(
            opening,
            fill(fv.EMAIL_RESTATEMENT, issue=x["issue_description"]),
            progress,
            F.when(x["escalation_required"], F.lit(fv.EMAIL_ESCALATED)),
            fill(fv.EMAIL_STATUS, status=status),
        )
    )
    email = F.struct(
        fill(
            fv.EMAIL_SUBJECT, category_lower=F.lower(x["complaint_category"]), status=status
        ).alias("subject"),
        fill(fv.EMAIL_GREETING, display_name=display_name(x)).alias("greeting"),
        paragraphs.alias("body_paragraphs"),
        F.lit(fv.EMAIL_CLOSING).alias("closing"),
        F.lit(fv.EMAIL_SENDER).alias("sender_name"),
    )
    return F.when(x.isNotNull(), email)


def next_action(x: Column) -> Column:
    return (
        F.when(x["escalation_required"], fv.NEXT_ACTION_ESCALATED)
        .when(x["overall_case_status"].isin("Resolved", "Closed"), fv.NEXT_ACTION_DONE)
        .when(_resolution(x).isNull(), fv.NEXT_ACTION_NO_RESOLUTION)
        .otherwise(fv.NEXT_ACTION_CHASE)
    )


def build_summary(x: Column) -> Column:
    """The five summary sections for one extraction struct; null in, null out."""
    summary = F.struct(
        fill(
            fv.SUMMARY_OVERVIEW,
            category=x["complaint_category"],
            kind=F.when(x["is_complaint"], "complaint").otherwise("enquiry"),
            display_name=display_name(x),
            subject=F.coalesce(_product(x), F.lit(fv.SUMMARY_DEFAULT_SUBJECT)),
        ).alias("case_overview"),
        x["issue_description"].alias("key_issue"),
        F.coalesce(_resolution(x), F.lit(fv.SUMMARY_NO_ACTION)).alias("action_taken"),
        fill(
            fv.SUMMARY_STATUS,
            status=x["overall_case_status"],
            priority=x["priority"],
            sentiment_lower=F.lower(x["customer_sentiment"]),
        ).alias("current_status"),
        next_action(x).alias("recommended_next_action"),
    )
    return F.when(x.isNotNull(), summary)


def clean_email(e: Column) -> Column:
    """Whitespace rules of an email: each part on one line, no blank paragraphs."""
    paragraphs = F.filter(F.transform(e["body_paragraphs"], collapse_ws), lambda p: p != "")
    return F.when(
        e.isNotNull(),
        F.struct(
            collapse_ws(e["subject"]).alias("subject"),
            collapse_ws(e["greeting"]).alias("greeting"),
            paragraphs.alias("body_paragraphs"),
            collapse_ws(e["closing"]).alias("closing"),
            collapse_ws(e["sender_name"]).alias("sender_name"),
        ),
    )


def clean_summary(s: Column) -> Column:
    return F.when(
        s.isNotNull(),
        F.struct(*(collapse_ws(s[name]).alias(name) for name, _ in fv.SUMMARY_TITLES)),
    )


def render_email(e: Column) -> Column:
    """Plain-text email: subject line, then blocks a blank line apart."""
    return F.concat(
        F.lit("Subject: "), e["subject"], F.lit("\n\n"),
        e["greeting"], F.lit("\n\n"),
        F.array_join(e["body_paragraphs"], "\n\n"), F.lit("\n\n"),
        e["closing"], F.lit("\n"), e["sender_name"], F.lit("\n"),
    )


def render_summary(s: Column) -> Column:
    """Each section under its underlined title, a blank line apart."""
    blocks = []
    for name, title in fv.SUMMARY_TITLES:
        head = f"{title}\n{'-' * len(title)}\n"
        blocks += [F.lit(("\n\n" if blocks else "") + head), s[name]]
    return F.concat(*blocks)


def summary_note(case_id: Column, source_file: Column, x: Column, s: Column) -> Column:
    """The Markdown note of one case: header, then the rendered summary."""
    facts = F.when(
        x.isNotNull(),
        F.concat(
            F.lit("**Category:** "), x["complaint_category"], F.lit("  \n**Priority:** "),
            x["priority"], F.lit("  \n**Escalation required:** "),
            F.when(x["escalation_required"], "Yes").otherwise("No"), F.lit("  \n"),
        ),
    )
    return F.concat(
        F.lit("# Case Summary — "), case_id, F.lit("\n\n**Source file:** "), source_file,
        F.lit("  \n"), F.coalesce(facts, F.lit("")), F.lit("\n"), render_summary(s), F.lit("\n"),
    )
