"""Queries with a DuckDB counterpart, and what all queries share."""

from __future__ import annotations

import os

import duckdb
import pytest

from caseloom.llm.queries import QUERIES
from caseloom.llm.sql import SQL

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(tuple(row[c] for c in columns) for row in df.collect())
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    assert got == sorted(want) and got


def test_every_operator_has_a_query():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
