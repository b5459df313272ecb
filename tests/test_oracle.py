"""Every registered query against its DuckDB counterpart, on the smallest tables."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import oracle_sql, queries
from checks import oracle_queries
from checks.compare import compare, connect
from checks.corpus import TABLES, corpus, corpus_oracle
from checks.queries import MODEL_RUNS, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_keys_match():
    assert set(oracle_queries.oracle_sql()) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_both_engines_compose_the_same_forms(spark, con):
    want = con.execute(f"SELECT * FROM ({corpus_oracle()}) ORDER BY k").fetchall()
    got = [tuple(r) for r in corpus(spark, SF_DIR).orderBy("k").collect()]
    assert got == want and len(TABLES) == 4


SAMPLE = ("discover", "parse_sections", "extraction", "read_responses", "report_rows", "keyword_score", "pick_issue")


@pytest.mark.parametrize("name", SAMPLE if not os.environ.get("TEST_ALL_QUERIES") else sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF_DIR, name, QUERIES[name], oracle_queries.oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", sorted(MODEL_RUNS))
def test_model_run(spark, con, name):
    assert compare(spark, con, SF_DIR, name, MODEL_RUNS[name], oracle_queries.model_sql()[name]) == ""


def test_both_task_modes_agree(spark):
    """Parallel and sequential runs differ in what they time, in nothing else."""
    one, two = (run(spark, SF_DIR).drop("timed") for run in MODEL_RUNS.values())
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty() and not one.isEmpty()
