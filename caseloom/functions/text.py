"""Text cleaning as column expressions.

All whitespace handling is Unicode-aware: the character classes below are written
out because Spark's ``trim`` and Java's ``\\s`` only know ASCII blanks.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom import fixed_values as fv

#: Blanks that stay inside a line, line breaks, and both (regex class bodies).
BLANKS = r"\t\x1f \xa0\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}"
BREAKS = r"\n\x0b\x0c\r\x1c-\x1e\x85\x{2028}\x{2029}"
SPACES = BLANKS + BREAKS


def _guarded(body: str) -> str:
    """A class of blanks that turns visible ASCII down with its first test.

    Java asks the parts of a class one after the other, about a dozen for these.
    """
    return rf"[\x00-\x20\x7f-\x{{ffff}}&&[{body}]]"


BLANK, _BREAK, _SPACE = _guarded(BLANKS), _guarded(BREAKS), _guarded(SPACES)

#: The same set as plain characters, for the trim functions.
SPACE_CHARS = "".join(
    chr(c)
    for lo, hi in (
        (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
        (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
        (0x3000, 0x3000),
    )
    for c in range(lo, hi + 1)
)

LINE_BREAK = rf"\r\n|{_BREAK}"


def strip(c: Column) -> Column:
    """Remove Unicode whitespace from both ends."""
    return F.btrim(c, F.lit(SPACE_CHARS))


def plain_ends(c: Column) -> Column:
    """Whether a text begins and ends with visible ASCII; only its two ends are looked at."""
    last = F.substring(c.cast("binary"), -1, 1)
    return (c >= "!") & (c < "\x7f") & (last >= F.lit(bytearray(b"!"))) & (last < F.lit(bytearray(b"\x7f")))


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


def _any_of(c: Column, words: Iterable[str]) -> Column:
    return reduce(Column.__or__, (c.contains(word) for word in words))


#: ASCII blanks besides spaces and newlines. Looking for one by itself is far quicker than a class.
_OTHER_BLANKS = [x for x in SPACE_CHARS if x.isascii() and x not in " \n"]


def plain_lines(c: Column) -> Column:
    """Whether ASCII text has no blanks but spaces and ``\n``, and no space right before a ``\n``."""
    return is_ascii(c) & ~c.contains(" \n") & ~c.rlike(r"[\x00-\t\x0b-\x1f]")


def collapse_ws(c: Column) -> Column:
    """Every whitespace run becomes one space; none at the ends."""
    # A lone plain space is already right, so the regex skips the common case.
    odd = _guarded(SPACES.replace(" ", ""))
    return F.btrim(F.regexp_replace(c, rf"{_SPACE}{{2,}}|{odd}", " "))


def collapse_column(c: Column) -> Column:
    """``collapse_ws`` of a column: printable ASCII without two spaces in a row only has its ends trimmed."""
    odd = _any_of(c, ("  ", "\n", *_OTHER_BLANKS)) | ~is_ascii(c)
    return F.when(odd, collapse_ws(c)).otherwise(F.btrim(c))


def strip_column(c: Column) -> Column:
    """``strip`` of a column; a text with visible ends, which ``strip`` would read whole, stays as it is."""
    return F.when(plain_ends(c), c).otherwise(strip(c))


def placeholder_to_none(collapsed: Column) -> Column:
    """Text whose whitespace is collapsed already; placeholder text becomes null."""
    return F.when(~F.lower(collapsed).isin(*fv.NULL_PLACEHOLDERS), collapsed)


def blank_to_none(c: Column) -> Column:
    """Collapse whitespace and turn placeholder text into null."""
    return placeholder_to_none(collapse_ws(c))


#: A value with spaces before it at most, that no blank, mark or "nothing here" begins or ends.
_PLAIN_VALUE = r"(?s)\A *+[!-~&&[^(*_nN\-]](?:.*[!-~&&[^*_]])?\z"


def clean_value(c: Column) -> Column:
    """Strip blanks and emphasis marks; text that says "nothing here" becomes ''.

    Takes a column, since it is named often; ``clean_expression`` is for what is worked out.
    """
    return F.when(c.rlike(_PLAIN_VALUE), F.trim(c)).otherwise(clean_expression(c))


def clean_trimmed(c: Column) -> Column:
    """``clean_value`` of a column without spaces at its ends, told plain by its two ends alone."""
    first, last = F.substring(c, 1, 1), F.substring(c.cast("binary"), -1, 1)
    marks = [F.lit(bytearray(mark)) for mark in (b"*", b"_")]
    plain = plain_ends(c) & ~first.isin(*"(*_nN-") & ~last.isin(*marks)
    return F.when((c == "") | plain, c).otherwise(clean_expression(c))


def clean_expression(c: Column) -> Column:
    """The same without a look for plain values first."""
    bare = strip(F.btrim(strip(c), F.lit("*_")))
    pattern = fv.NOTHING_HERE_PATTERN.replace("{ws}", SPACES)
    return F.when(bare.rlike(pattern), "").otherwise(bare)


def split_lines(c: Column) -> Column:
    """Stripped, non-blank lines."""
    return F.filter(F.transform(F.split(c, LINE_BREAK), strip), lambda line: line != "")


def compact_lines(c: Column) -> Column:
    """The text of ``split_lines`` joined by newlines, in one regex pass.

    The result never holds an empty line or a line break but ``\n``, which is what lets the form
    parser mark its events by one.
    """
    text = F.regexp_replace(c, rf"{_BREAK}{_SPACE}*+", "\n")
    text = F.regexp_replace(text, _blanks_before(r"\n", BLANK), "\n")
    # ASCII without odd blanks, and none around its newlines, is the common case: it is only searched.
    plain = is_ascii(c) & ~_any_of(c, _OTHER_BLANKS)
    few = F.when(c.contains("\n\n"), F.replace(c, F.lit("\n\n"), F.lit("\n"))).otherwise(c)
    many = F.regexp_replace(F.replace(c, F.lit(" \n"), F.lit("\n")), r"\n[ \n]*+", "\n")
    made = (
        F.when(plain & ~_any_of(c, (" \n", "\n ", "\n\n\n")), few)
        .when(plain & ~c.contains("  \n"), many)
        .otherwise(text)
    )
    # Ends that are no blanks stay as they are.
    return F.when(plain_ends(c), made).otherwise(strip(made))


def drop_line_ends(c: Column) -> Column:
    """Single spaces before newlines dropped, which changes nothing for ``compact_lines``."""
    lone = c.contains(" \n") & ~c.contains("  \n")
    return F.when(lone, F.replace(c, F.lit(" \n"), F.lit("\n"))).otherwise(c)


def _blanks_before(end: str, blank: str) -> str:
    # The look-behind lets a match start only at the first blank of a run, which
    # keeps long runs of blanks linear.
    return rf"{blank}(?<!{blank}{{2}}){blank}*+{end}"


def _nfkc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


#: Blocks of Latin, Greek, Cyrillic, Armenian, Hebrew and Arabic letters, punctuation, kana,
#: ideographs, Hangul and emoji that are looked through for what NFKC leaves alone.
COMMON_BLOCKS = (
    (0x80, 0x6FF), (0x1E00, 0x1FFF), (0x2010, 0x20CF), (0x2190, 0x22FF), (0x2500, 0x27BF), (0x3001, 0x30FF),
    (0x4E00, 0x9FFF), (0xAC00, 0xD7A3), (0x1F300, 0x1F6FF), (0x1F900, 0x1F9FF),
)


def stays(char: str) -> bool:
    """Whether NFKC leaves a character as it is, whatever its neighbours are.

    It must be normal by itself and not a mark, since marks join what comes before them or
    change places. Nothing but a mark joins, apart from Hangul letters and some vowel signs, which
    the common blocks do not hold.
    """
    return unicodedata.is_normalized("NFKC", char) and not unicodedata.category(char).startswith("M")


@cache
def _may_change() -> str:
    """A pattern for a character that NFKC may change; plain ASCII is passed over first."""
    safe = [c for lo, hi in COMMON_BLOCKS for c in range(lo, hi + 1) if stays(chr(c))]
    ranges: list[list[int]] = []
    for c in safe:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    shown = "".join(rf"\x{{{lo:x}}}-\x{{{hi:x}}}" for lo, hi in ranges)
    return rf"(?=[^\x00-\x7F])[^{shown}]"


def nfkc(c: Column, ascii_only: Column | None = None) -> Column:
    """Unicode compatibility normalisation, which Spark has no built-in for.

    Only text with a character that can change makes the trip to Python; all other rows,
    composed accents and other scripts included, are handed over as null.
    """
    to_python = F.pandas_udf(_nfkc, "string")
    other = ~(is_ascii(c) if ascii_only is None else ascii_only)
    return F.coalesce(to_python(F.when(other & c.rlike(_may_change()), c)), c)


def tidy_lines(c: Column) -> Column:
    """The part of ``normalise`` that follows the Unicode step."""
    c = F.regexp_replace(F.replace(c, F.lit("\xa0"), F.lit(" ")), "\r\n?", "\n")
    # Blanks at the end of a plain text go with the last step.
    c = F.when(plain_lines(c), c).otherwise(_bare_ends(c))
    return strip(F.regexp_replace(c, "\n{3,}", "\n\n"))


def _bare_ends(c: Column) -> Column:
    return F.regexp_replace(c, _blanks_before(r"(?=\n|\z)", _guarded(SPACES.replace(r"\n", ""))), "")


def normalise(c: Column) -> Column:
    """One flavour of text: NFKC, ``\\n`` ends, no trailing blanks, no blank runs."""
    # NFKC makes a space of every no-break space; doing that first keeps such text out of Python.
    return tidy_lines(nfkc(F.replace(c, F.lit("\xa0"), F.lit(" "))))


def normalise_column(df: DataFrame, name: str) -> DataFrame:
    """``df`` with ``normalise`` applied to the column ``name``, a step at a time.

    A search that finds nothing costs far less than a replacement, so each step looks first for what
    it changes. Only a column can be asked for that so often.
    """
    c, ascii_only = F.col(name), F.col("_ascii")

    def replaced(old: str, new: str) -> Column:
        return F.when(c.contains(old), F.replace(c, F.lit(old), F.lit(new))).otherwise(c)

    df = df.withColumn(name, replaced("\xa0", " ")).withColumn("_ascii", is_ascii(c))
    blank_ends = ~ascii_only | _any_of(c, (x + "\n" for x in (" ", *_OTHER_BLANKS)))
    for step in (
        # ASCII stays ASCII, and NFKC leaves no no-break space.
        nfkc(c, ascii_only),
        replaced("\r\n", "\n"),
        replaced("\r", "\n"),
        # A few plain blanks before newlines need no pattern.
        replaced("\t\n", "\n"),
        replaced(" \n", "\n"),
        replaced(" \n", "\n"),
        F.when(blank_ends, _bare_ends(c)).otherwise(c),
        F.when(c.contains("\n\n\n"), F.regexp_replace(c, "\n{3,}", "\n\n")).otherwise(c),
        strip_column(c),
    ):
        df = df.withColumn(name, step)
    return df.drop("_ascii")


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def contains_any(column: str, words: tuple[str, ...]) -> Column:
    """True when any word is a substring; word boundaries do not matter.

    Takes a column name: the chain is one SQL text, which is much quicker to put
    together than a call per word.
    """
    return F.expr(" OR ".join(f"contains(`{column}`, {sql_text(word)})" for word in words))


def fill(template: tuple[str, ...], **slots: Column) -> Column:
    """Concatenate a template of text parts and ``{slot}`` parts."""
    return F.concat(
        *(
            slots[part[1:-1]] if part.startswith("{") and part.endswith("}") else F.lit(part)
            for part in template
        )
    )
