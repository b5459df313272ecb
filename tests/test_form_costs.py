"""What keeps the form queries cheap for each form, and that it changes no value."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from caseloom.functions import text as tx
from caseloom.operators import prompts, rules
from caseloom.operators.parsing import event_chunks, field_value, section_text
from caseloom.plans.workflow import load_texts, process_documents
from checks.corpus import corpus
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("tables")
    day = datetime(2024, 5, 1)

    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{at}/{name}.parquet")

    put("orders", [(k, k % 5, day, "1-URGENT") for k in range(200)] + [(None, None, day, None), (7, 1, day, "x")],
        "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string")
    put("customer", [(k, f"Customer {k}", "TOYS") for k in range(4)], "c_custkey long, c_name string, c_mktsegment string")
    put("part", [(k, f"part {k}", "B") for k in range(3)], "p_partkey long, p_name string, p_brand string")
    put("documents", [(k, f"prose {k}") for k in range(0, 100, 2)] + [(None, "lost"), (4, "again")],
        "doc_id long, text string")
    return str(at)


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_forms_are_dealt_to_several_tasks_a_core(spark, tables, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        forms = corpus(spark, tables)
        assert forms.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism
        assert forms.count() == 203  # one order comes twice, one document too
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fields_are_found_without_a_function_over_events(spark):
    chunks = spark.createDataFrame(
        [
            ([("", "Case", None), ("e-mail", " a@b.de", "x"), ("email", " late@b.de", None), ("name", " ", None)],),
            ([],), (None,),
        ],
        "c array<struct<label: string, value: string, rest: string>>",
    )
    found = chunks.select(*(field_value(F.col("c"), n).alias(n) for n in ("email", "name", "phone")))
    assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.collect() == [(" a@b.de", " ", None), (None, None, None), (None, None, None)]


def test_sections_that_come_never_once_and_often(spark):
    once = [("details", " ", "one\ntwo")]
    inline = [("details", " N/A", None)]
    often = [("details", " ", "one"), ("email", " x", None), ("issue details", " see", "below"), ("details", " ", None)]
    rows = [([("", "x", None)],), (once,), (inline,), ([("details", " ", None)],), (often,), (None,)]
    df = spark.createDataFrame(rows, "c array<struct<label: string, value: string, rest: string>>")
    got = [r[0] for r in df.select(section_text(F.col("c"), "issue_details")).collect()]
    assert got == ["", "one two", "", "", "one see below", None]


def test_one_event_pass_reads_odd_blanks_as_plain_ones(spark):
    plain = "Case\nName: A B\n\nDetails\n one\n\n two  x\n"
    odd = [plain, plain.replace("\n", "\r\n"), plain.replace("\n", "\t\n  "), plain.replace("\n", " \n")]
    df = spark.createDataFrame([(t,) for t in odd], "t string").select(event_chunks(F.col("t")).alias("c"))
    assert len({str(r[0]) for r in df.collect()}) == 1


def test_no_break_spaces_stay_out_of_python(spark):
    df = spark.createDataFrame([("a\xa0b \xa0\n\n\n\nc\xa0",), ("a\xa0́\xa0\x0c\nb",), (" \ta\x1f\n",)], "t string")
    done = df.select(tx.normalise(F.col("t")).alias("t"))
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert "replace(t" in plan.split("_nfkc(", 1)[1].split("\n", 1)[0]
    assert [r.t for r in done.collect()] == ["a b\n\nc", "a ́\nb", "a"]


def test_category_scores_are_worked_out_once(spark):
    texts = [("billed twice",), ("the courier lost it",), ("nothing of note",), (None,)]
    df = spark.createDataFrame(texts, "subject string")
    found = df.select(rules.top_category(rules.category_scores("subject")).alias("c"))
    plan = found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("billed twice") == 1
    assert [r.c for r in found.collect()] == ["Billing", "Delivery", "Other", "Other"]


def test_plain_values_and_lines_take_the_short_way_with_the_same_result(spark):
    values = [
        " Ann Lee", "x", "", " ", None, "(none)", "None.", "-", "--", "n/a", "No. 5", "**bold**", "_x_", "a*", "* a",
        " a ", "\ta", "a　", "été", "1)", "a\nb", "  a", "ends \t", "~", "!", "\x7f",
    ]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for row in df.select(tx.clean_value(F.col("v")).alias("a"), tx.clean_expression(F.col("v")).alias("b")).collect():
        assert row.a == row.b

    lines = [
        "a\n\n\nb", "a \nb", "a  \n  b", "a \n \n b", "a   \n\n \n  c d  e", "\n a \n", "a\t\nb", "a\r\nb", "a \nb",
        "", " ", None, "a\x1cb", "é \né", " a", "a ",
    ]
    df = spark.createDataFrame([(v,) for v in lines], "v string")
    made = df.select("v", tx.compact_lines(F.col("v")).alias("a"), F.array_join(tx.split_lines(F.col("v")), "\n").alias("b"))
    assert all(row.a == row.b for row in made.collect())
    ends = spark.createDataFrame([("a \nb",), (" a",), ("aé",), ("",)], "v string")
    assert [r[0] for r in ends.select(tx.plain_ends(F.col("v"))).collect()] == [True, False, False, False]


def test_no_layer_of_a_record_is_one_large_method(spark):
    """The JVM compiles no method above 8,000 bytes of code."""
    text = "Customer Name: Ann\nDescription\nThe parcel was billed twice and I am furious.\nResolution\nA refund was approved."
    rows = [("a", text), ("b", ""), ("c", None), ("a", text)]
    df = spark.createDataFrame(rows, "source_file string, d string")
    done = rules.with_rule_extraction(df, "d")
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = getattr(debug, "MODULE$").codegenStringSeq(done._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [found.apply(k)._3().maxMethodCodeSize() for k in range(found.size())]
    assert sizes and max(sizes) < 8000
    got = sorted((r.source_file, r.extraction.customer_name, r.extraction.complaint_category) for r in done.collect() if r.d)
    assert got == [("a", "Ann", "Billing")] * 2
    assert done.count() == 4


def test_no_layer_of_a_composed_form_is_one_large_method(spark, tables):
    forms = corpus(spark, tables).select("k", "source_file", "text")
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = getattr(debug, "MODULE$").codegenStringSeq(forms._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert max(found.apply(k)._3().maxMethodCodeSize() for k in range(found.size())) < 8000


def test_sections_under_two_spellings_are_joined(spark):
    rows = [([("details", " ", "one"), ("issue details", " ", "two")],), ([("details", " ", "a"), ("details", " ", "b")],)]
    df = spark.createDataFrame(rows, "c array<struct<label: string, value: string, rest: string>>")
    assert [r[0] for r in df.select(section_text(F.col("c"), "issue_details")).collect()] == ["one two", "a b"]


def test_length_of_a_record_is_that_of_its_json(spark):
    texts = [
        "Customer Name: Ann\nDescription\nThe parcel was billed twice and I am furious.",
        'Customer Name: A "B" \\C\nDescription\nA page said "error" in C:\\logs, twice over.\nResolution\nRefund\x01ed.',
        "Customer Name: Zoë — 名\n\n", "", None,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    x = F.col("extraction")
    found = rules.with_rule_extraction(df, "d").select(
        prompts.extraction_json_length(x).alias("a"), F.char_length(prompts.extraction_json(x)).alias("b")
    )
    got = found.collect()
    assert len(got) == 5 and all(row.a == row.b for row in got)


def test_columns_are_cleaned_as_expressions_are(spark):
    values = [
        " Ann  Lee", "x", "", " ", None, "(none)", "None.", "-", "--", "n/a", "No. 5", "**bold**", "_x_", "a*", "* a",
        "\ta", "a\u3000", "été  b", "1)", "a\nb", "  a", "ends \t", "~", "\x7f", "a\x1cb", "a\x85", "\xa0a\r\nb\xa0",
        "a \t\n \nb\n\n\n\nc", "a\r\r\n\rb \r\n", "ﬁ\r\n\t\n\t\n x", "a  \n\n\t\n\nb", "a \t \n\x0b\nb \x1f\n", "\t\n \n",
    ]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    v = F.col("v")
    bare = F.trim(v)
    made = df.select("v", bare.alias("t"), tx.collapse_ws(v).alias("c"), tx.normalise(v).alias("n"), tx.strip(v).alias("s"),
                     tx.clean_expression(bare).alias("e"), tx.compact_lines(v).alias("l"), tx.drop_line_ends(v).alias("d"))
    made = made.select("*", tx.collapse_column(v).alias("c2"), tx.strip_column(v).alias("s2"),
                       tx.clean_trimmed(F.col("t")).alias("e2"), tx.compact_lines(F.col("d")).alias("l2"))
    for row in tx.normalise_column(made.withColumn("n2", v), "n2").collect():
        assert (row.c, row.n, row.s, row.e, row.l) == (row.c2, row.n2, row.s2, row.e2, row.l2), row.v


def test_no_layer_of_a_case_is_one_large_method(spark):
    """The JVM compiles no method above 8,000 bytes of code."""
    df = spark.createDataFrame([("a.txt", "Customer Name: Ann\nDescription\nLate.")], "source_file string, text string")
    debug = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
    plan = process_documents(load_texts(df))._jdf.queryExecution().executedPlan()
    found = getattr(debug, "MODULE$").codegenStringSeq(plan)
    sizes = [found.apply(k)._3().maxMethodCodeSize() for k in range(found.size())]
    assert sizes and max(sizes) < 8000


def test_best_category_of_a_column(spark):
    scores = [[(0, "A"), (2, "B"), (2, "C")], [(0, "Z"), (0, "A")], [(-1, "A")], [], None]
    df = spark.createDataFrame([(s,) for s in scores], "s array<struct<score: int, category: string>>")
    found = df.select(rules.top_of_column(F.col("s")).alias("a"), rules.top_category(F.col("s")).alias("b")).collect()
    assert [r.a for r in found] == [r.b for r in found] == ["C", "Other", "Other", "Other", "Other"]


def test_drafts_are_made_once_for_both_tasks(spark, tables):
    found = QUERIES["task_results_to_record"](spark, tables)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("customer enquiry") == 1  # the records of the cases; those of the drafts are read
    rows = found.collect()
    # Of keys 4 and 7 there are two forms, two emails and two summaries each.
    assert len(rows) == 199 + 8 + 8
    assert all((r.subject is None) == (int(r.source_file[5:].split(".")[0]) % 3 == 0) for r in rows if r.source_file)
