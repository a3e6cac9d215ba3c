"""Every bound query: its plan, and its rows against DuckDB."""

import collections
import pathlib
import re

import duckdb
import pytest

import __spark_entry__ as entry_points

FOLDER = pathlib.Path("/root/testdata/sf0.001")
# the corpus operators have tests of their own
QUERIES = {k: v for k, v in entry_points.queries().items() if k in entry_points.QUERIES}
ORACLES = {k: v for k, v in entry_points.oracle_sql().items() if k in QUERIES}

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in FOLDER.glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def counted(table):
    names = sorted(table.column_names)
    return names, collections.Counter(zip(*[[repr(v) for v in table.column(n).to_pylist()] for n in names]))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(FOLDER))
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert node not in plan
    if name != "running_count":  # its windows are bounded by the number of partitions
        assert not re.search(r"\bWindow\b", plan)
    mine = counted(df.toArrow())
    if name in ORACLES:
        assert mine == counted(duck.sql(ORACLES[name]).to_arrow_table())


def test_contract(spark):
    assert set(ORACLES) == set(QUERIES)
    assert entry_points.entry(spark).count() > 0


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["range_filter"](spark, str(FOLDER))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_extendedprice,1000.0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double,l_tax:double>" in plan
