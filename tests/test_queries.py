"""Every registered query against its oracle SQL in DuckDB."""

from pathlib import Path

import duckdb
import pytest
from conftest import SF, plan_of

import __spark_entry__ as entry
from corpusloom.suite import all_suites
from tools.check import rows_of

# The optional subpackage has its own tests.
QUERIES = {name: query for suite in all_suites() for name, query in suite.queries.items()}
ORACLES = {name: sql for suite in all_suites() for name, sql in suite.oracles.items()}


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    got = rows_of(df.columns, df.collect())
    if name in ORACLES:
        rel = con.execute(ORACLES[name])
        assert got == rows_of([d[0] for d in rel.description], rel.fetchall())
    else:
        assert got[1]


def test_contract(spark):
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["name", "purchases"]
