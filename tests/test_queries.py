"""Every query against the SQL that states its result, and the shape of its plan."""

import pytest

import __spark_entry__
from quayside.catalog import ORACLES, QUERIES
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
WITHOUT_SQL = {"profile_columns_approx", "profile_quantiles_approx"}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert difference(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"):
        assert node not in plan


def test_all_queries_have_sql():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry(spark):
    row = __spark_entry__.entry(spark).first()
    assert row["match"] and row["evaluated"] == 3


def test_estimates_are_close(spark):
    exact = {
        r["column_name"]: r["distinct_count"]
        for r in QUERIES["profile_columns_orders"](spark, FOLDER).collect()
    }
    assert exact["o_orderkey"] == 1500
    near = {r["column_name"]: r["distinct_count"] for r in QUERIES["profile_columns_approx"](spark, FOLDER).collect()}
    assert near["l_returnflag"] == 3 and abs(near["l_linenumber"] - 7) <= 1
    quantiles = {
        (r["column_name"], r["prob"]): r["quantile"]
        for r in QUERIES["profile_quantiles"](spark, FOLDER).collect()
    }
    for r in QUERIES["profile_quantiles_approx"](spark, FOLDER).collect():
        key = (r["column_name"], r["prob"])
        if key in quantiles:
            assert abs(r["quantile"] - quantiles[key]) <= max(1.0, 0.01 * abs(quantiles[key]))
