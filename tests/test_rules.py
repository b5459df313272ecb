"""The form parser and the decision tables."""

from __future__ import annotations

import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.operators import drafting, parsing, prompts, rule_table, rules
from caseloom.operators.validation import read_responses
from caseloom.plans.workflow import load_texts, process_documents


def extract(spark, texts):
    df = spark.createDataFrame([(i, t.strip()) for i, t in enumerate(texts)], "i int, d string")
    rows = rules.with_rule_extraction(df.coalesce(1), "d").orderBy("i").collect()
    return [r.extraction for r in rows]


def test_labelled_fields(spark, form):
    (x,) = extract(spark, [form])
    assert (x.customer_name, x.email) == ("Lena Fischer", "lena.fischer@example.com")
    assert (x.product_or_service, x.complaint_category) == ("Prime Fibre Line", "Billing")
    assert x.supporting_document_available and not x.escalation_required
    assert (x.overall_case_status, x.priority, x.customer_sentiment) == ("Resolved", "Low", "Neutral")


ESCALATIONS = [
    ("It was not required this time.", False),
    ("The caller has not requested any.", False),
    ("So far not escalated, although a manager knows.", False),
    ("Ticket handled by a shift manager in Graz.", False),
    ("She asks for a supervisor by name.", True),
    ("Went to legal on Friday.", True),
]


def test_small_forms(spark):
    base = "Complaint Description:\nSince Sunday the heater only hums and stays cold.\n\nEscalation:\n"
    found = extract(spark, [base + said for said, _ in ESCALATIONS])
    assert [x.escalation_required for x in found] == [want for _, want in ESCALATIONS]

    delivery, enquiry, bare, waiting, pending = extract(
        spark,
        [
            "Complaint Description:\nOur courier left the parcel at a depot two towns away."
            "\n\nResolution Provided:\nThe lamp was replaced from stock.\n",
            "Enquiry Description:\nWhich plans work abroad? To be clear, this is not a complaint at all.\n",
            "Complaint Description:\nThe map view shows an error whenever it rains outside.\n",
            "Complaint Description:\nNobody came to read the meter in spring or summer.\n",
            "Complaint Description:\nTwo rooms were booked and only one was ready.\n\nResolution Provided:\n"
            "The hotel says the claim is under review until June.\n",
        ],
    )
    assert delivery.complaint_category == "Delivery"
    assert not enquiry.is_complaint and enquiry.complaint_category == "General Enquiry"
    assert bare.customer_name is None and bare.email is None and bare.phone_number is None
    assert "does not state" in bare.extraction_notes
    assert waiting.overall_case_status == "Open"
    assert pending.overall_case_status == "In Progress"


def test_parser_quirks(spark):
    doc = (
        "Title\nPhone:\nMobile: 080-4455-9012\n## **Details**\nfirst\nTicket: 7\ndropped\n"
        "Details: (none)\nsecond\n**Escalation:** none yet\nProduct/Service | x\n"
    )
    df = spark.createDataFrame([(doc.strip(),)], "d string").coalesce(1)
    df = df.select(parsing.event_chunks(F.col("d")).alias("c"))
    row = df.select(
        parsing.parse_fields(F.col("c")).alias("f"), parsing.parse_sections(F.col("c")).alias("s")
    ).first()
    assert row.f == {"phone": "", "reference": "7", "product": "x"}
    assert row.s == {"issue_details": "first second", "escalation": "none yet"}


def test_long_blank_runs_in_lines_stay_linear(spark):
    doc = "- " + " " * 100_000 + "x\n#" + " " * 100_000 + "Details" + " " * 100_000 + "x\n" + "Name" + " " * 100_000 + ": Ann"
    df = spark.createDataFrame([(doc,)], "d string").coalesce(1)
    df = df.select(parsing.event_chunks(F.col("d")).alias("c"))
    assert df.select(parsing.parse_fields(F.col("c")).alias("f")).first().f == {"name": "Ann"}


def test_ties_and_substrings(spark):
    texts = ["a refund and a delivery", "courier of a faulty item", "happy", "awaiting", "nothing"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1)
    got = df.select("i", rules.top_category(rules.category_scores("t")).alias("x")).orderBy("i")
    assert [r.x for r in got.collect()] == [
        "Refund", "Product Defect", "Technical Issue", "Service Quality", "Other",
    ]


def test_rule_table_equals_brute_force(spark):
    rng = random.Random(5)
    texts = {i: "".join(rng.choice("abc ") for _ in range(rng.randint(0, 40))) for i in range(200)}
    table = [(f"C{n % 5}", "".join(rng.choice("abc ") for _ in range(rng.randint(1, 5))), 1 + n % 3)
             for n in range(40)]
    want = {}
    for i, t in texts.items():
        scores = {}
        for category, word, weight in table:
            if word in t:
                scores[category] = scores.get(category, 0) + weight
        want[i] = max(scores, key=lambda x: (scores[x], x)) if scores else "Other"
    docs = spark.createDataFrame(list(texts.items()), "i int, t string")
    words = spark.createDataFrame(table, "category string, keyword string, weight long")
    for block in (rule_table.BLOCK_RULES, 7):  # one block for each opening length, then several
        got = rule_table.top_categories(docs, words, "i", "t", block).collect()
        assert {r.i: r.category for r in got} == want
    with pytest.raises(ValueError):
        empty = spark.createDataFrame([("C", "", 1)], "category string, keyword string, weight long")
        rule_table.top_categories(docs, empty, "i", "t")


@pytest.mark.parametrize("block", [1, 5000])
def test_rows_of_one_key_add_up(spark, block):
    docs = spark.createDataFrame([("a", "a refund"), ("a", "my refund"), ("b", "none")], "k string, t string")
    words = spark.createDataFrame(
        [("Refund", "refund", 3), ("Money", "fund", 1), ("X", "a", 1), ("Y", "zz", 1)],
        "category string, keyword string, weight long",
    )
    got = rule_table.keyword_scores(docs, words, "k", "t", block).collect()
    assert sorted(map(tuple, got)) == [("a", "Money", 2), ("a", "Refund", 6), ("a", "X", 1)]


def test_a_hundred_thousand_rules_equal_brute_force(spark):
    rng = random.Random(11)
    letters = "abcdefgh é"
    texts = {i: "".join(rng.choice(letters) for _ in range(rng.randint(0, 300))) for i in range(60)}
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(180_000)})
    rules_rows = [(f"C{n % 40}", word, 1 + n % 4) for n, word in enumerate(words)]
    rules_rows += [("Again", word, 2) for word in words[:500]] + rules_rows[:3]
    assert len(rules_rows) > 100_000
    held = {i: Counter((c, w) for c, word, w in rules_rows if word in t) for i, t in texts.items()}
    docs = spark.createDataFrame([*texts.items(), (99, None)], "i int, t string").repartition(3)
    table = spark.createDataFrame(pd.DataFrame(rules_rows, columns=["category", "keyword", "weight"]))
    got = rule_table.matched_rules(docs, table, "i", "t")
    found = Counter((r.i, r.category, r.weight) for r in got.collect())
    assert found == Counter({(i, c, w): n for i, own in held.items() for (c, w), n in own.items()})
    scores = {(r.i, r.category): r.score for r in rule_table.keyword_scores(docs, table, "i", "t").collect()}
    want = Counter()
    for i, own in held.items():
        for (c, w), n in own.items():
            want[i, c] += w * n
    assert scores == dict(want)


def test_rules_of_any_number_take_one_pass_without_a_join(spark):
    docs = spark.createDataFrame([(1, "x")], "i int, t string")
    table = spark.createDataFrame([("C", f"word{n}", 1) for n in range(6000)], "category string, keyword string, weight long")
    plan = rule_table.matched_rules(docs, table, "i", "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert not any(word in plan for word in ("Join", "Exchange", "Generate"))


def test_fields_at_the_end_of_a_long_document(spark, form):
    """Whole texts are read: nothing is cut unless a limit is given."""
    text = "Nothing to see here at all, only filler.\n" * 2500 + form
    assert len(text) > 100_000
    df = spark.createDataFrame([("a.txt", text)], "source_file string, text string")
    row = process_documents(df).first()
    assert (row.extraction.customer_name, row.extraction.complaint_category) == ("Lena Fischer", "Billing")
    assert row.meta.char_count == len(text) and not row.meta.truncated
    long_issue = "Complaint Description:\n" + "The router stops and starts again all day. " * 60
    (x,) = extract(spark, [long_issue])
    assert len(x.issue_description) > 2000
    cut = rules.pick_issue(F.lit("x" * 900), F.lit(""), F.lit(""), max_chars=800)
    assert len(spark.range(1).select(cut.alias("c")).first().c) == 800


def test_prompt_block_gives_the_text_back(spark, form):
    df = spark.createDataFrame([("a.txt", form.strip())], "n string, t string").coalesce(1)
    prompt = prompts.prompt_extraction(F.col("n"), F.col("t"))
    block = parsing.extract_block(prompt, "document")
    assert df.select((block == F.col("t")).alias("x"), (parsing.rule_view(F.col("t")) == F.col("t")).alias("y")).first() == (True, True)


def test_record_json_reads_back(spark, form):
    import json

    df = spark.createDataFrame([(form.replace("Prime", 'Pri"me\\').strip(),)], "d string").coalesce(1)
    row = rules.with_rule_extraction(df, "d").select(
        "extraction", prompts.extraction_json(F.col("extraction")).alias("j")
    ).first()
    assert json.loads(row.j) == row.extraction.asDict()
    assert row.j == json.dumps(row.extraction.asDict(), indent=2, ensure_ascii=False)


def test_rendering(spark, form):
    df = spark.createDataFrame([(form.strip(),)], "d string").coalesce(1)
    x = F.col("extraction")
    row = rules.with_rule_extraction(df, "d").select(
        drafting.render_email(drafting.build_email(x)).alias("e"),
        drafting.render_summary(drafting.build_summary(x)).alias("s"),
    ).first()
    assert row.e.startswith("Subject: Your billing case — Resolved\n\nDear Lena Fischer,\n\nThank you")
    assert row.e.endswith("\n\nKind regards,\nCustomer Support Team\n")
    assert row.s.startswith("Case Overview\n-------------\nBilling complaint raised by Lena Fischer")


def test_rules_plan_is_one_narrow_stage(spark, form):
    path_df = spark.createDataFrame([("a.txt", form)], "source_file string, text string")
    plan = process_documents(path_df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "EvalPython" not in plan
    assert plan.count("action taken|escalation") == 2  # one event pass: its pattern names them twice
    filtered = process_documents(path_df).where("status = 'SUCCESS' AND extraction.priority = 'Low'")
    assert filtered._jdf.queryExecution().executedPlan().toString().count("action taken|escalation") == 2


def test_output_is_filtered_and_pruned(spark, form, tmp_path):
    spark.createDataFrame([("a.txt", form)], "source_file string, text string").write.parquet(f"{tmp_path}/in")
    cases = process_documents(load_texts(spark.read.parquet(f"{tmp_path}/in")))

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert "EqualTo(source_file,a.txt)" in plan(cases.where("meta.source_file = 'a.txt'"))
    assert "Kind regards" in plan(cases) and "Kind regards" not in plan(cases.select("status"))
    assert cases.where("meta.source_file = 'a.txt'").select("status").first().status == "SUCCESS"


def test_vocabularies_cover_the_rules():
    assert {category for category, _, _ in fv.CATEGORY_KEYWORDS} <= set(fv.CATEGORIES)


@pytest.mark.parametrize("flag, want", [
    ("1.0", True), ("0.0", False), ("1", True), ("true", True), ('"Yes"', True), ('"off"', False),
    ('"1.0"', None), ("2", None), ("null", None), ("[1]", None), ("{}", None),
])
def test_flags_in_answers(spark, form, flag, want):
    df = spark.createDataFrame([(form.strip(),)], "d string").coalesce(1)
    json = prompts.extraction_json(F.col("extraction"))
    answer = F.regexp_replace(json, '"is_complaint": (true|false)', f'"is_complaint": {flag}')
    row = read_responses(rules.with_rule_extraction(df, "d").select(answer.alias("a")), "extraction", "a").first()
    assert row.extraction_violations == ([] if want is not None else ["is_complaint: not a boolean"])
    assert (row.extraction and row.extraction.is_complaint) == want


def test_unknown_task_is_named(spark):
    with pytest.raises(ValueError, match="unknown task 'poem'"):
        read_responses(spark.createDataFrame([("{}",)], "a string"), "poem", "a")
