"""Every registered query against its SQL on the smallest data."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from quarry.workload import ORACLES, QUERIES
from tests.conftest import SMALL
from tools.check_queries import TABLES, comparable

@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"build_models"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    cursor = con.execute(ORACLES[name])
    expected = comparable(cursor.fetchall(), [d[0] for d in cursor.description])
    assert comparable(df.collect(), df.columns) == expected
