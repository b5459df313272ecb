"""Parsing a semi-structured form into labelled fields and sections.

A document is a list of lines. A line that names a known section opens it; a
``label: value`` line with a known field label sets the field and closes the open
section; any other line belongs to the open section, or to nothing.

No line-by-line loop is needed for that. The compacted text has no line breaks but
newlines, so one regex pass can rewrite every *event* line as::

    <record separator>label
     value          (always starts with a space, so it is never empty)

and splitting at the record separators gives one chunk per event, each holding its
label, its inline value and the lines that follow it. All of it stays inside the
row: no explode, no shuffle, no state.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseloom import fixed_values as fv
from caseloom.functions.text import BLANK, clean_expression, clean_value, compact_lines, plain_ends, strip


def _either(labels: list[str]) -> str:
    """Any of the labels as a pattern; the look-ahead asks for all first letters at once."""
    spelled = "|".join(re.escape(label).replace("\\ ", " ").replace("\\-", "-") for label in labels)
    return f"(?=[{''.join(sorted({label[0] for label in labels}))}])(?:{spelled})"


_SECTION_ANY = _either([x for names in fv.SECTION_LABELS.values() for x in names])
_FIELD_ANY = _either([x for names in fv.FIELD_LABELS.values() for x in names])
# Possessive, so that a long run of blanks is looked at once.
_B = f"{BLANK}*+"
_MARKS = rf"{_B}\**+{_B}"

#: A line break, so compacted text has none; Java splits at one plain character without a pattern.
MARK = "\x1e"

EVENT_LINE = (
    rf"(?i)\n(?:#{{0,6}}{_MARKS}({_SECTION_ANY}){_MARKS}:?{_B}"
    rf"|[-*]?{_MARKS}({_SECTION_ANY}|{_FIELD_ANY}){_MARKS}[:|]{_B}([^\n]*))(?=\n|\z)"
)


def canonical_label(label: Column) -> Column:
    """The section or field a label spelling stands for, null for any other text."""
    key = F.rtrim(strip(F.lower(label)), F.lit(":"))
    pairs = [
        F.lit(value)
        for groups in (fv.SECTION_LABELS, fv.FIELD_LABELS)
        for name, labels in groups.items()
        for spelling in labels
        for value in (spelling, name)
    ]
    return F.element_at(F.create_map(*pairs), strip(key))


def marked_events(document: Column) -> Column:
    """The compacted text with every event line rewritten behind a mark."""
    lines = F.concat(F.lit("\n"), compact_lines(document))
    return F.regexp_replace(lines, EVENT_LINE, MARK + "$1$2\n $3")


def event_chunks(document: Column) -> Column:
    """The events of a document in order: ``array<struct<label, value, rest>>``.

    ``label`` is lower-case, ``value`` the raw inline value behind one space, ``rest``
    the lines that follow, null when there are none. The unlabelled preamble comes first
    as an element without a value.
    """
    return marked_chunks(marked_events(document))


def marked_chunks(marked: Column) -> Column:
    """``event_chunks`` of a text from ``marked_events``."""
    parts = F.transform(F.split(marked, MARK), lambda chunk: F.split(chunk, "\n", 3))
    return F.transform(
        parts,
        lambda p: F.struct(
            F.lower(F.get(p, F.lit(0))).alias("label"),
            F.get(p, F.lit(1)).alias("value"),
            F.get(p, F.lit(2)).alias("rest"),
        ),
    )


def classify_lines(document: Column) -> Column:
    """The event lines: ``array<struct<label, canonical, value>>``."""

    def describe(event: Column) -> Column:
        return F.struct(
            event["label"].alias("label"),
            canonical_label(event["label"]).alias("canonical"),
            clean_value(event["value"]).alias("value"),
        )

    known = F.filter(
        F.transform(event_chunks(document), describe), lambda e: e["canonical"].isNotNull()
    )
    return known


def field_value(chunks: Column, name: str) -> Column:
    """Raw value of a field: its first occurrence, even when that one is blank.

    Null when the document has no such label. ``clean_value`` makes it final.
    """
    return listed_value(chunks["label"], chunks["value"], name)


def listed_value(labels: Column, values: Column, name: str) -> Column:
    """``field_value`` from the labels and the values of the events."""
    spots = (F.nullif(F.array_position(labels, x), F.lit(0)) for x in fv.FIELD_LABELS[name])
    return F.get(values, (F.least(*spots) - 1).cast("int"))


def section_text(chunks: Column, name: str) -> Column:
    """Raw text of a section: the lines of all its occurrences, joined by spaces.

    '' when there are none. ``clean_value`` makes it final.
    """
    return listed_text(chunks, chunks["label"], chunks["value"], chunks["rest"], name)


def listed_text(chunks: Column, labels: Column, values: Column, rests: Column, name: str) -> Column:
    """``section_text`` from the events and their parts, which are named so often that they should be columns."""
    spellings = fv.SECTION_LABELS[name]
    own = F.filter(chunks, lambda e: e["label"].isin(*spellings))

    def body(value: Column, lines: Column) -> Column:
        rest = F.replace(lines, F.lit("\n"), F.lit(" "))
        inline = F.nullif(clean_expression(value), F.lit(""))
        # Most headings stand alone; only the others need their value looked at.
        return F.when(value == " ", rest).otherwise(
            F.nullif(F.concat_ws(" ", inline, rest), F.lit(""))
        )

    # A heading that comes once is found by its place; no function runs over the events.
    others = reduce(F.array_remove, spellings, labels)
    found = [F.array_position(labels, x) for x in spellings]
    # Where no label repeats, which is asked once for all sections, each spelling found is one heading.
    single = F.size(F.array_distinct(labels)) == F.size(labels)
    spellings_found = reduce(Column.__add__, (F.sign(at).cast("int") for at in found))
    times = F.when(single, spellings_found).otherwise(F.size(labels) - F.size(others))
    spots = (F.nullif(at, F.lit(0)) for at in found)
    place = (F.least(*spots) - 1).cast("int")
    once = body(F.get(values, place), F.get(rests, place))
    every = F.array_join(F.transform(own, lambda e: body(e["value"], e["rest"])), " ")
    return (
        F.when(labels.isNotNull() & (times == 0), F.lit(""))
        .when(times == 1, F.coalesce(once, F.lit("")))
        .otherwise(every)
    )


def has_section(chunks: Column, name: str) -> Column:
    return F.exists(chunks, lambda e: e["label"].isin(*fv.SECTION_LABELS[name]))


def _present(names: list[str], value_of) -> Column:
    entries = F.array(
        *(F.struct(F.lit(n).alias("key"), value_of(n).alias("value")) for n in names)
    )
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def parse_fields(chunks: Column) -> Column:
    """``map<field, value>`` of the labels the document has."""
    return _present(list(fv.FIELD_LABELS), lambda n: clean_expression(field_value(chunks, n)))


def parse_sections(chunks: Column) -> Column:
    """``map<section, text>`` of the headings the document has."""
    return _present(
        list(fv.SECTION_LABELS),
        lambda n: F.when(has_section(chunks, n), clean_expression(section_text(chunks, n))),
    )


def extract_block(prompt: Column, tag: str) -> Column:
    """Text of the first ``<tag>...</tag>`` block, trimmed; '' when there is none."""
    return strip(F.regexp_extract(prompt, rf"(?s)<{tag}>(.*?)</{tag}>", 1))


def rule_view(text: Column) -> Column:
    """The text the rules see: what a ``<document>`` block around it gives back."""
    whole = plain_ends(text) & ~text.contains("</document>")
    return F.when(whole, text).otherwise(strip(F.substring_index(text, "</document>", 1)))
