"""Ids and types derived from file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseloom import fixed_values as fv


def suffix(name: Column) -> Column:
    """Lower-cased last suffix with its dot, '' when there is none."""
    return F.lower(F.regexp_extract(name, r"(?s)^.+(\.[^.]+)\z", 1))


def file_type(name: Column) -> Column:
    return F.ltrim(suffix(name), F.lit("."))


def case_id(name: Column) -> Column:
    """File-system safe id: the stem with everything unusual replaced by ``_``."""
    stem = F.regexp_replace(name, r"(?s)\.[^.]*\z", "")
    safe = F.btrim(F.regexp_replace(stem, r"[^\p{L}\p{N}_-]", "_"), F.lit("_"))
    return F.coalesce(F.nullif(safe, F.lit("")), F.lit("case"))


def is_ignored(name: Column) -> Column:
    """Editor and system artefacts, which are never input."""
    hit = F.lit(False)
    for prefix in fv.IGNORED_NAME_PREFIXES:
        hit = hit | name.startswith(prefix)
    return hit


def is_eligible(name: Column) -> Column:
    return ~is_ignored(name) & suffix(name).isin(*fv.SUPPORTED_EXTENSIONS)


def is_skipped(name: Column) -> Column:
    """Present, not an artefact, but of a type nothing can read."""
    return ~is_ignored(name) & ~suffix(name).isin(*fv.SUPPORTED_EXTENSIONS)
