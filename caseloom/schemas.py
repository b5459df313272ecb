"""Declared schemas of every table the package reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

EXTRACTION = T.StructType(
    [
        T.StructField("customer_name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("phone_number", T.StringType()),
        T.StructField("product_or_service", T.StringType()),
        T.StructField("complaint_category", T.StringType()),
        T.StructField("issue_description", T.StringType()),
        T.StructField("resolution_provided", T.StringType()),
        T.StructField("is_complaint", T.BooleanType()),
        T.StructField("escalation_required", T.BooleanType()),
        T.StructField("supporting_document_available", T.BooleanType()),
        T.StructField("overall_case_status", T.StringType()),
        T.StructField("priority", T.StringType()),
        T.StructField("customer_sentiment", T.StringType()),
        T.StructField("extraction_notes", T.StringType()),
    ]
)

CUSTOMER_EMAIL = T.StructType(
    [
        T.StructField("subject", T.StringType()),
        T.StructField("greeting", T.StringType()),
        T.StructField("body_paragraphs", T.ArrayType(T.StringType())),
        T.StructField("closing", T.StringType()),
        T.StructField("sender_name", T.StringType()),
    ]
)

CASE_SUMMARY = T.StructType(
    [
        T.StructField("case_overview", T.StringType()),
        T.StructField("key_issue", T.StringType()),
        T.StructField("action_taken", T.StringType()),
        T.StructField("current_status", T.StringType()),
        T.StructField("recommended_next_action", T.StringType()),
    ]
)

META = T.StructType(
    [
        T.StructField("case_id", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("file_type", T.StringType()),
        T.StructField("file_size_bytes", T.LongType()),
        T.StructField("char_count", T.LongType()),
        T.StructField("truncated", T.BooleanType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)

USAGE = T.StructType(
    [
        T.StructField("calls", T.LongType()),
        T.StructField("prompt_tokens", T.LongType()),
        T.StructField("completion_tokens", T.LongType()),
    ]
)

#: One row per document: the result of the whole workflow.
CASES = T.StructType(
    [
        T.StructField("meta", META),
        T.StructField("status", T.StringType()),
        T.StructField("extraction", EXTRACTION),
        T.StructField("customer_email", CUSTOMER_EMAIL),
        T.StructField("case_summary", CASE_SUMMARY),
        T.StructField("errors", T.ArrayType(T.StringType())),
        T.StructField("task_durations_seconds", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("usage", USAGE),
    ]
)

#: One row per file of an input folder.
MANIFEST = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("length", T.LongType()),
    ]
)
