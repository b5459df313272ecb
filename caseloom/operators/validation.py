"""Checking model answers against the declared schemas.

An answer is a JSON text. It becomes a struct only when every field is present,
of the declared type, inside its vocabulary and non-blank where required;
otherwise the struct is null and the violation list says why. Nothing raises.

The text is parsed once, to a map of variants; kinds and values are read from its members.
Members, kinds, values and collapsed texts are arrays in the order of the fields, each a layer
of its own: none is worked out again wherever it is used, and the generated code has one step
for each layer and not one for each field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom import fixed_values as fv
from caseloom.functions.contacts import valid_email, valid_phone
from caseloom.functions.text import blank_to_none, collapse_ws, placeholder_to_none
from caseloom.operators.drafting import clean_email, clean_summary
from caseloom.plans.sealing import sealed
from caseloom.schemas import CASE_SUMMARY, CUSTOMER_EMAIL, EXTRACTION

VOCABULARIES = {
    "complaint_category": fv.CATEGORIES,
    "overall_case_status": fv.CASE_STATUSES,
    "priority": fv.PRIORITIES,
    "customer_sentiment": fv.SENTIMENTS,
}
OPTIONAL = (
    "customer_name",
    "email",
    "phone_number",
    "product_or_service",
    "resolution_provided",
    "extraction_notes",
)
# The spellings a flag may have besides JSON true and false.
TRUE_WORDS = ("1", "on", "t", "true", "y", "yes")
FALSE_WORDS = ("0", "off", "f", "false", "n", "no")

NOT_AN_OBJECT = "answer is not a JSON object"


def _worded_flag(raw: Column) -> Column:
    word = F.lower(raw)
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def _flag(raw: Column) -> Column:
    """JSON true and false, their spellings, and the numbers 1 and 0 in any notation."""
    number = raw.try_cast("double")
    return F.coalesce(
        _worded_flag(raw), F.when(number == 1, F.lit(True)).when(number == 0, F.lit(False))
    )


def _field_problem(field: T.StructField, kind: Column, raw: Column, flat: Column) -> Column:
    """The first problem of one field as text, null when it is right; ``flat`` is its collapsed text."""
    name = field.name

    def say(what: str) -> Column:
        return F.lit(f"{name}: {what}")

    problem = F.when(kind.isNull(), say("field required"))
    if isinstance(field.dataType, T.BooleanType):
        flag = F.when(kind == "STRING", _worded_flag(raw)).otherwise(_flag(raw))
        return problem.when(
            kind.isin("VOID") | kind.startswith("OBJECT") | flag.isNull(), say("not a boolean")
        )
    if isinstance(field.dataType, T.ArrayType):
        texts = kind.isin("ARRAY<STRING>", "ARRAY<VOID>") & ~F.exists(raw, lambda p: p.isNull())
        return problem.when(~F.coalesce(texts, F.lit(False)), say("not a list of strings")).when(
            F.forall(raw, lambda p: collapse_ws(p) == ""), say("needs at least one paragraph")
        )
    if name in OPTIONAL:
        return problem.when(~kind.isin("STRING", "VOID"), say("not a string"))
    problem = problem.when(kind != "STRING", say("not a string"))
    if name in VOCABULARIES:
        return problem.when(~raw.isin(*VOCABULARIES[name]), say("not in the vocabulary"))
    return problem.when(flat == "", say("must not be empty"))


def _collapsed(answer: Column, raw: Column) -> Column:
    """``collapse_ws`` of a member's text.

    An ASCII answer without an escape has no blanks in its texts but spaces.
    """
    only_spaces = (F.octet_length(answer) == F.char_length(answer)) & ~answer.contains("\\")
    return F.when(only_spaces & ~raw.contains("  "), F.btrim(raw, F.lit(" "))).otherwise(collapse_ws(raw))


def _cleaners(clean, text, flag) -> dict:
    """The field rules of a record: placeholders, whitespace, contact formats."""
    cleaners = {name: clean for name in OPTIONAL}
    cleaners.update(
        email=lambda c: valid_email(c, clean), phone_number=lambda c: valid_phone(c, clean), issue_description=text
    )
    for field in EXTRACTION.fields:
        if isinstance(field.dataType, T.BooleanType):
            cleaners[field.name] = flag
    return cleaners


def clean_extraction(x: Column) -> Column:
    """A record with the field rules applied; null stays null."""
    cleaners = _cleaners(blank_to_none, collapse_ws, lambda c: c)
    fields = (cleaners.get(name, lambda c: c)(x[name]).alias(name) for name in EXTRACTION.fieldNames())
    return F.when(x.isNotNull(), F.struct(*fields))


def _checked_extraction(raw: Column, flat: Column) -> Column:
    """The same from texts that are collapsed already."""
    cleaners = _cleaners(placeholder_to_none, lambda c: c, _flag)
    fields = []
    for name in EXTRACTION.fieldNames():
        source = flat if name in OPTIONAL or name == "issue_description" else raw
        fields.append(cleaners.get(name, lambda c: c)(source[name]).alias(name))
    return F.struct(*fields)


TASKS = {
    "extraction": (EXTRACTION, _checked_extraction),
    "customer_email": (CUSTOMER_EMAIL, lambda raw, flat: clean_email(raw)),
    "case_summary": (CASE_SUMMARY, lambda raw, flat: clean_summary(raw)),
}


def read_responses(df: DataFrame, task: str, answer: str, into: str | None = None) -> DataFrame:
    """Parse and check the JSON column ``answer``.

    Adds the validated struct (named after the task unless ``into`` is given) and
    ``<into>_violations``: null without an answer, an empty array when it is right.
    """
    into = into or task
    if task not in TASKS:
        raise ValueError(f"unknown task {task!r}: one of {', '.join(TASKS)}")
    schema, clean = TASKS[task]
    keep = df.columns
    fields, text = schema.fields, F.col(answer)
    members, kinds, raw, flat = (F.col(f"_{layer}") for layer in ("members", "kinds", "raw", "flat"))
    at = {f.name: F.lit(k) for k, f in enumerate(fields)}

    def value(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.ArrayType):
            return F.try_variant_get(F.get(members, at[f.name]), "$", "array<string>")
        return F.get(raw, at[f.name])

    parsed = F.try_variant_get(F.try_parse_json(text), "$", "map<string,variant>")
    df = df.select(*keep, parsed.alias("_parsed"))
    names = F.array(*(F.lit(f.name) for f in fields))
    df = df.select(
        *keep,
        F.col("_parsed").isNotNull().alias("_object"),
        F.transform(names, lambda name: F.try_element_at("_parsed", name)).alias("_members"),
    )
    # Flags are read as text, so that their spellings can be checked.
    df = df.select(
        *keep,
        "_object",
        "_members",
        F.transform(members, F.schema_of_variant).alias("_kinds"),
        F.transform(members, lambda m: F.try_variant_get(m, "$", "string")).alias("_raw"),
    )
    df = df.select("*", F.transform(raw, lambda r: _collapsed(text, r)).alias("_flat"))
    problems = F.array_compact(
        F.array(
            *(
                _field_problem(f, F.get(kinds, at[f.name]), value(f), F.get(flat, at[f.name]))
                for f in fields
            )
        )
    )
    violations = (
        F.when(text.isNull(), F.lit(None))
        .when(~F.col("_object"), F.array(F.lit(NOT_AN_OBJECT)))
        .otherwise(problems)
    )
    df = df.select(
        *keep,
        F.struct(*(value(f).alias(f.name) for f in fields)).alias("_raw"),
        F.struct(*(F.get(flat, at[f.name]).alias(f.name) for f in fields)).alias("_flat"),
        violations.alias(f"{into}_violations"),
    )
    df = df.select(
        *keep,
        F.when(F.size(f"{into}_violations") == 0, clean(raw, flat)).alias(into),
        f"{into}_violations",
    )
    return sealed(df, into, f"{into}_violations")
