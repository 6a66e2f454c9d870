"""Every registered query against its SQL in DuckDB, and what no plan may contain."""

import pytest

import __spark_entry__ as entry
from verification.compare import compare, connect
from verification.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    # Thresholds are set for the larger folders; at the smallest one some results are empty.
    assert compare(df, con, ORACLES[name]) in (None, "EMPTY")
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert bad not in plan, bad


def test_entry(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 23 and df.count() > 0
