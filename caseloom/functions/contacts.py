"""Finding and checking contact details."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseloom.functions.text import SPACES, blank_to_none

# The patterns of an address, a phone number and a valid address.
# The look-behind and possessive runs only keep the scan linear on long words.
WORD = r"\p{L}\p{N}_"
EMAIL_SCAN = rf"(?<![{WORD}.+-])[{WORD}.+-]++@[{WORD}-]++\.[{WORD}.-]+"
PHONE_SCAN = rf"\+?\p{{Nd}}[\p{{Nd}}{SPACES}().-]{{7,}}\p{{Nd}}"
EMAIL_VALID = rf"^[^@{SPACES}]+@[^@{SPACES}]+\.[A-Za-z]{{2,}}$"
PHONE_DIGITS = (7, 15)


def _first_match(c: Column, pattern: str) -> Column:
    return F.regexp_substr(c, F.lit(pattern))


def scan_email(field: Column, document: Column) -> Column:
    """First address in the field, or in the whole document if that is blank."""
    source = F.when(field == "", document).otherwise(field)
    return F.when(source.contains("@"), _first_match(source, EMAIL_SCAN))


def scan_phone(field: Column) -> Column:
    """First phone number in the labelled field; the document is never scanned."""
    return _first_match(field, PHONE_SCAN)


def valid_email(c: Column, clean: Callable[[Column], Column] = blank_to_none) -> Column:
    """Lower-cased address, or null when it is not one."""
    bare = F.lower(F.btrim(clean(c), F.lit("<>,;")))
    return F.when(bare.rlike(EMAIL_VALID), bare)


def valid_phone(c: Column, clean: Callable[[Column], Column] = blank_to_none) -> Column:
    """The cleaned text as written, or null when its length is implausible."""
    cleaned = clean(c)
    digits = F.ltrim(F.regexp_replace(cleaned, r"[^\p{Nd}+]", ""), F.lit("+"))
    return F.when(F.char_length(digits).between(*PHONE_DIGITS), cleaned)
