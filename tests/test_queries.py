"""Every registered query on the smallest tables: its values against SQL, and its plan."""

from __future__ import annotations

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as registered
import checks
from tools.compare import TABLES, rows_of

QUERIES = checks.QUERIES
ORACLES = checks.ORACLES

# Array functions over whole batches, as a dictionary lookup is not a built-in one.
WITH_ARROW = {
    "clean_text",
    "empty_texts_dropped",
    "clean_tokens_lemma",
    "clean_page",
    "community_clean_text",
}


@pytest.fixture(scope="module")
def con(small):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    return connection


def test_every_statement_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, small, con, name):
    df = QUERIES[name](spark, small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    assert ("ArrowEvalPython" in plan) == (name in WITH_ARROW)
    got = rows_of(df.columns, df.collect())
    assert got
    if name in ORACLES:
        result = con.execute(ORACLES[name])
        columns = [d[0] for d in result.description]
        assert sorted(columns) == sorted(df.columns)
        assert got == rows_of(columns, result.fetchall())


def test_entry(spark):
    rows = registered.entry(spark).collect()
    assert len(rows) == 20
    assert rows[0]["comm_count"] == max(r["comm_count"] for r in rows)


def test_the_entry_is_imported_without_a_session():
    """In a process of its own, as this one has a session."""
    code = "import __spark_entry__ as e; assert e.queries() and e.oracle_sql()"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
