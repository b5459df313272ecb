"""Prompts of the three model tasks, and the token estimate of the rule provider."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom import fixed_values as fv
from caseloom.functions.text import fill
from caseloom.schemas import EXTRACTION, USAGE

EXTRACTION_INSTRUCTIONS = (
    "You turn one customer case document into one structured record. Take every value "
    "from the document and from nowhere else. Use null for whatever the document does "
    "not state; never a stand-in such as N/A. Copy addresses and phone numbers as "
    "written. Describe the issue neutrally in at most three sentences. Record only "
    "resolutions that have already happened. For listed vocabularies choose exactly one "
    "value, and Other only when none fits. Put doubts into extraction_notes. Answer with "
    "the record alone."
)
EMAIL_INSTRUCTIONS = (
    "You write the reply a support team sends to a customer. The validated record is the "
    "source of truth; the document only adds detail. Promise nothing that is not recorded. "
    "Greet the customer by name, or neutrally when there is none. Restate the problem, say "
    "what has been done or that work is under way, mention an escalation without naming "
    "staff, and give one clear next step. Two to four short, calm paragraphs without lists "
    "or placeholders. Answer with the email parts alone."
)
SUMMARY_INSTRUCTIONS = (
    "You write the internal note a support manager reads when sorting a queue. The "
    "validated record is the source of truth; the document only adds detail. At most two "
    "plain sentences per section, no courtesies and no repetition. Actions taken are those "
    "already done, else 'No action recorded.'. End with one concrete step an agent can take "
    "today. Answer with the summary sections alone."
)


#: What a JSON string cannot hold as it is.
_ESCAPED = r'[\x00-\x1f"\\]'


def json_string(c: Column) -> Column:
    """A JSON string literal, or ``null``. Non-ASCII text stays as it is."""
    # Escapes are rare; only values with them pay for a full JSON writer.
    written = F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)
    quote = F.lit('"')
    literal = F.when(c.rlike(_ESCAPED), written).otherwise(F.concat(quote, c, quote))
    return F.coalesce(literal, F.lit("null"))


def extraction_json(x: Column) -> Column:
    """The record as JSON with two-space indent, nulls kept, fields in order."""
    parts: list[Column] = []
    for i, field in enumerate(EXTRACTION.fields):
        parts.append(F.lit(("{" if i == 0 else ",") + f'\n  "{field.name}": '))
        value = x[field.name]
        boolean = isinstance(field.dataType, T.BooleanType)
        parts.append(F.coalesce(value.cast("string"), F.lit("null")) if boolean else json_string(value))
    return F.when(x.isNotNull(), F.concat(*parts, F.lit("\n}")))


def extraction_json_length(x: Column) -> Column:
    """``char_length(extraction_json(x))`` for a record, added up where no value needs an escape."""
    fixed = len("{") + len("\n}") - len(",")
    sizes, flags, texts = [], [], []
    for field in EXTRACTION.fields:
        fixed += len(f',\n  "{field.name}": ')
        value = x[field.name]
        if isinstance(field.dataType, T.BooleanType):
            flags.append(F.when(~value, len("false")).otherwise(len("true")))  # as long as null
        else:
            sizes.append(F.coalesce(F.char_length(value) + 2, F.lit(len("null"))))
            texts.append(value)
    plain = sum(sizes, F.lit(0))
    # Texts with escapes are rare; the function over them keeps the code for the others small.
    written = F.transform(F.array(*texts), lambda text: F.char_length(json_string(text)))
    escapes = F.concat_ws("", *texts).rlike(_ESCAPED)
    size = F.when(escapes, F.aggregate(written, F.lit(0), lambda a, b: a + b)).otherwise(plain)
    return size + sum(flags, F.lit(fixed))


def prompt_extraction(source_file: Column, text: Column) -> Column:
    return fill(fv.PROMPT_EXTRACTION, source_file=source_file, text=text)


def prompt_email(source_file: Column, text: Column, extracted_json: Column) -> Column:
    return fill(
        fv.PROMPT_EMAIL, source_file=source_file, text=text, extracted_json=extracted_json
    )


def prompt_summary(source_file: Column, text: Column, extracted_json: Column) -> Column:
    return fill(
        fv.PROMPT_SUMMARY, source_file=source_file, text=text, extracted_json=extracted_json
    )


def estimated_usage(done: Column, chars: Column, record: Column) -> Column:
    """Calls and tokens the rule provider accounts for one document.

    Prompt lengths are added up from their parts; no prompt text is built. ``done`` tells whether
    there is a record, ``chars`` is the length of file name and text, ``record`` that of the
    record's JSON (``extraction_json_length``). They are named often, so they should be columns.
    """

    def tokens(template: tuple[str, ...], *extra: Column) -> Column:
        fixed = sum(len(part) for part in template if not part.startswith("{"))
        return F.floor(sum(extra, F.lit(fixed) + chars) / fv.CHARS_PER_TOKEN)

    later = tokens(fv.PROMPT_EMAIL, record) + tokens(fv.PROMPT_SUMMARY, record)
    prompt = F.when(done, tokens(fv.PROMPT_EXTRACTION) + later).otherwise(F.lit(0))
    calls = F.when(done, F.lit(3)).otherwise(F.lit(0))
    return F.struct(
        calls.cast("long").alias("calls"),
        prompt.cast("long").alias("prompt_tokens"),
        (calls * fv.COMPLETION_TOKENS_PER_CALL).cast("long").alias("completion_tokens"),
    ).cast(USAGE)
