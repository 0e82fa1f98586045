"""Profiles against plain Python on small tables."""

import random
import statistics

import pytest

from quayside.operators import profile
from quayside.operators.values import quantiles, value_stats


def linear(values, prob):
    ordered = sorted(values)
    at = prob * (len(ordered) - 1)
    low = int(at)
    high = min(low + 1, len(ordered) - 1)
    return ordered[low] + (ordered[high] - ordered[low]) * (at - low)


@pytest.fixture
def no_merging(spark):
    """Keep small range partitions apart, so that ranks are looked up over several of them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("shape", ["distinct", "hot", "two", "one"])
def test_quantiles(spark, no_merging, shape):
    rng = random.Random(shape)
    values = {
        "distinct": [rng.uniform(-1e6, 1e6) for _ in range(2001)],
        "hot": [7.0 if rng.random() < 0.4 else rng.randint(0, 50) / 4 for _ in range(3000)],
        "two": [1.0, 2.0],
        "one": [5.0],
    }[shape]
    df = spark.createDataFrame([(v, None) for v in values] + [(None, 1.0)], "v double, w double").repartition(6)
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {(r["column_name"], r["prob"]): r["quantile"] for r in quantiles(df, ["v", "w"], probs).collect()}
    assert len(got) == 2 * len(probs)
    for p in probs:
        assert got["v", p] == pytest.approx(linear(values, p), rel=1e-12)
        assert got["w", p] == 1.0


def test_value_stats(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", -0.0), ("b", 1.0), (None, None)], "s string, d double")
    got = {r["column_name"]: tuple(r)[1:] for r in value_stats(df, ["s", "d"]).collect()}
    assert got == {"s": (3, 2, 2), "d": (3, 2, 2)}


def test_columns(spark):
    df = spark.createDataFrame([(1, "ab", None), (2, "abc", None), (4, None, None)], "n int, s string, e double")
    got = {r["column_name"]: r.asDict() for r in profile.profile_columns(df).collect()}
    n, s, e = got["n"], got["s"], got["e"]
    assert (n["row_count"], n["null_count"], n["distinct_count"], n["min_value"], n["max_value"]) == (3, 0, 3, "1", "4")
    assert n["mean_value"] == round(7 / 3, 4) and n["std_value"] == round(statistics.stdev([1, 2, 4]), 4)
    assert (s["min_length"], s["max_length"], s["null_count"]) == (2, 3, 1) and s["mean_value"] is None
    assert (e["null_pct"], e["distinct_count"], e["min_value"]) == (100.0, 0, None)


def test_wide_table(spark):
    wide = spark.range(10).selectExpr(*[f"id % {i + 1} as c{i}" for i in range(60)])
    got = {r["column_name"]: r["distinct_count"] for r in profile.profile_columns(wide).collect()}
    assert got == {f"c{i}": min(i + 1, 10) for i in range(60)}


def test_table_counts_nulls_as_equal(spark):
    rows = [(1, None), (1, None), (None, 1), (1, 1), (11, None)]
    got = profile.profile_table(spark.createDataFrame(rows, "a int, b int")).first()
    assert tuple(got) == (5, 2, 1, 4)


def test_topk_breaks_ties_by_value_and_prunes_before_the_shuffle(spark):
    df = spark.createDataFrame([(v,) for v in "ccbbaad"], "v string")
    got = profile.profile_topk(df, ["v"], 2)
    assert [(r["value"], r["n"], r["rank"]) for r in got.orderBy("rank").collect()] == [("a", 2, 1), ("b", 2, 2)]
    assert "TakeOrderedAndProject(limit=2" in got._jdf.queryExecution().executedPlan().toString()


def test_histogram(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 1, 9, 10)] + [(None,)], "v double")
    got = [(r["bin"], r["low"], r["high"], r["records"]) for r in profile.profile_histogram(df, "v", 5).orderBy("bin").collect()]
    assert got == [(0, 0.0, 2.0, 3), (1, 2.0, 4.0, 0), (2, 4.0, 6.0, 0), (3, 6.0, 8.0, 0), (4, 8.0, 10.0, 2)]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [(r["bin"], r["records"]) for r in profile.profile_histogram(flat, "v").collect()] == [(0, 2)]
    assert profile.profile_histogram(df.where("v is null"), "v").count() == 0


def test_one_column_needs_no_nested_loop(spark):
    df = spark.range(100).selectExpr("id % 7 as v")
    plan = profile.profile_columns(df)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert profile.profile_columns(df).first()["distinct_count"] == 7
