"""Value rules: text cleaning, contacts, names. One job per rule."""

from __future__ import annotations

import random
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions import contacts, naming, text

def run(spark, rule, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").coalesce(1)
    return [r.x for r in df.select("i", rule(F.col("v")).alias("x")).orderBy("i").collect()]


def test_placeholders_and_whitespace(spark):
    blank = ["N/A", "n/a", "unknown", "Not provided", "none", "  ", "-", None]
    assert run(spark, text.blank_to_none, blank) == [None] * len(blank)
    assert run(spark, text.blank_to_none, [" Jo \t de  Wit\n", "a  b"]) == ["Jo de Wit", "a b"]


def test_email_and_phone(spark):
    bad = ["plain words", "half@way", "@no.name", "two parts@site.org"]
    assert run(spark, contacts.valid_email, bad) == [None] * 4
    assert run(spark, contacts.valid_email, ["\t<Jo.DeWit@Mail.Example.ORG>"]) == [
        "jo.dewit@mail.example.org"
    ]
    assert run(spark, contacts.valid_phone, ["7", "call me", "4321"]) == [None] * 3
    good = ["+31 20 794 0801", "0316-550-188", "(030) 901-8220"]
    assert run(spark, contacts.valid_phone, good) == good


def test_case_ids_and_types(spark):
    names = ["letter_7.txt", "form 3 [new].pdf", "in/box.docx", "._.txt", "plain"]
    assert run(spark, naming.case_id, names) == [
        "letter_7", "form_3__new", "in_box", "case", "plain",
    ]
    kinds = ["a.TXT", "b.tar.gz", "none", "trail.", "x.Md"]
    assert run(spark, naming.file_type, kinds) == ["txt", "gz", "", "", "md"]


def test_clean_value(spark):
    empty = ["(none recorded)", "_(none recorded)_", "None.", "N/A", "nil", "---", " ** ", "not provided"]
    assert run(spark, text.clean_value, empty) == [""] * len(empty)
    assert run(spark, text.clean_value, ["** Gold **", "none of it"]) == ["Gold", "none of it"]


def test_normalise_examples(spark):
    given_texts = ["Line one\n\n\n\n\nLine two   \n", "a\r\nb\rc", "ﬁne x", "  lead\n  keep", ""]
    assert run(spark, text.normalise, given_texts) == [
        "Line one\n\nLine two", "a\nb\nc", "fine x", "lead\n  keep", "",
    ]


def _python_normalise(value: str) -> str:
    value = unicodedata.normalize("NFKC", value).replace("\xa0", " ")
    lines = [x.rstrip() for x in value.replace("\r\n", "\n").replace("\r", "\n").split("\n")]
    kept = [x for i, x in enumerate(lines) if x or i == 0 or lines[i - 1]]
    return "\n".join(kept).strip()


ALPHABET = "ab:*_#| \t\n\r\x0b\x0c\x1c\x1f\x85\xa0  　é①"


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=60, max_size=60))
def test_text_rules_match_python(spark, values):
    assert run(spark, text.normalise, values) == [_python_normalise(v) for v in values]
    assert run(spark, text.collapse_ws, values) == [" ".join(v.split()) for v in values]
    lines = [[x.strip() for x in v.splitlines() if x.strip()] for v in values]
    assert run(spark, text.split_lines, values) == lines
    stripped = [v.strip() for v in values]
    assert run(spark, text.compact_lines, stripped) == ["\n".join(x) for x in lines]


def test_characters_passed_over_never_change():
    """Alone, in pairs, before and after marks: what the pattern passes over is normal text."""
    safe = [chr(c) for lo, hi in text.COMMON_BLOCKS for c in range(lo, hi + 1) if text.stays(chr(c))]
    draw = random.Random(1)
    for size in (1, 2, 5, 40):
        for _ in range(4000):
            value = "".join(draw.choice(safe) if draw.random() < 0.7 else chr(draw.randrange(128)) for _ in range(size))
            assert unicodedata.is_normalized("NFKC", value)
    everything = "".join(safe)
    assert unicodedata.normalize("NFKC", everything) == everything
    assert all(c in safe for c in "éüßñçøåœæłđ–—‘’“”•→中文あアé한Ωж")


def test_only_text_that_can_change_goes_to_python(spark):
    values = ["plain", "Café, Straße, año – “so”", "中文 한국 Ωж 🎉", "ﬁne", "Ｔext", "e\u0301", "½", "a\xa0b", "¨", None]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    sent = df.where(F.col("t").rlike(text._may_change())).collect()
    assert [r.t for r in sent] == ["ﬁne", "Ｔext", "e\u0301", "½", "a\xa0b", "¨"]
    got = df.select(text.nfkc(F.col("t")).alias("t")).collect()
    assert [r.t for r in got] == [v and unicodedata.normalize("NFKC", v) for v in values]


def test_long_blank_runs_stay_linear(spark):
    value = "a" + " " * 200_000 + "b" + "." * 100_000
    assert run(spark, text.compact_lines, [value]) == [value]
    assert run(spark, lambda c: contacts.scan_email(F.lit(""), c), ["w" * 200_000 + " x@y.zz"]) == ["x@y.zz"]


def test_placeholder_list_is_lower_case():
    assert all(p == p.lower() for p in fv.NULL_PLACEHOLDERS)
