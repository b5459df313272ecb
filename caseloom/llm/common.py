"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The ASCII white space of the contracts, as a Java and Python pattern.
BLANKS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else unchanged."""
    return F.translate(text, UPPER, LOWER)


def fan_out(df: DataFrame, column: str, n: int) -> DataFrame:
    """Every row ``n`` times, numbered in ``column``."""
    return df.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(column))


def widened(schema: T.StructType, **kinds: str) -> T.StructType:
    """A new schema with more columns at its end."""
    out = T.StructType(list(schema.fields))
    for name, kind in kinds.items():
        out.add(name, kind)
    return out


def unused(name: str, columns: list[str]) -> str:
    """``name``, with more underscores in front as long as a column is called so in any case."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
