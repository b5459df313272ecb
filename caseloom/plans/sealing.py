"""Keeping an expensive projection in one place.

A filter on a derived column is pushed below the projection that derives it, and takes
a copy of the whole expression along; through the layers of the form parser that copy
grows until planning fails. Columns that come out of a generator cannot be pushed down.
Wrapping the finished columns in a one-element array and unpacking it costs next to
nothing per row and lets users filter on anything afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sealed(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with ``columns`` moved to the end and closed to predicate pushdown."""
    others = [name for name in df.columns if name not in columns]
    return df.select(*others, F.inline(F.array(F.struct(*columns))))
