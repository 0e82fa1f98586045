"""Exact ranks by narrowing, in every numeric type, against sorted lists."""

import math
import random
from decimal import Decimal

import pytest

from quayside.operators import ranks

PROBS = [0.0, 0.01, 0.3, 0.5, 0.99, 1.0]
rng = random.Random(11)
SHAPES = {
    "bigint": [rng.choice([0, 1, -1]) * (1 << 62) + rng.randrange(200) for _ in range(1500)] + [-(1 << 63), (1 << 63) - 1],
    "past_double": [(1 << 53) + rng.randrange(4000) for _ in range(1500)],
    "int": [rng.choice([-(1 << 31), (1 << 31) - 1, rng.randrange(-50, 50)]) for _ in range(1500)],
    "hot": [7] * 1400 + [rng.randrange(10**12) for _ in range(100)],
    "double": [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(1500)] + [0.0, 5e-324, math.inf, -math.inf, math.nan],
    "close": [1.0 + rng.randrange(2000) * 2.0**-52 for _ in range(1500)],
    "odd": [math.inf, math.nan, math.nan, -math.inf],
    "float": [float(rng.randrange(1 << 24)) / 4 for _ in range(1500)],
    "decimal": [Decimal(rng.randrange(-(10**37), 10**37)).scaleb(-4) for _ in range(1500)],
    "one": [5],
}
KINDS = {"double": "double", "close": "double", "odd": "double", "float": "float", "decimal": "decimal(38,4)", "int": "int"}


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("small", [1, 40, 50_000])
def test_ranks(spark, monkeypatch, shape, small):
    monkeypatch.setattr(ranks, "SMALL", small), monkeypatch.setattr(ranks, "RANGES", 64)
    values = SHAPES[shape]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], f"`a b` {KINDS.get(shape, 'bigint')}").repartition(3)
    windows = []
    look_up = ranks._Ranks.look_up
    monkeypatch.setattr(ranks._Ranks, "look_up", lambda self: windows.extend(i.rows for i in self.open) or look_up(self))
    ordered = sorted(values, key=lambda v: (math.isnan(v), v))
    for column, p, below, above, part in ranks.exact_ranks(df, ["a b"], PROBS):
        at = p * (len(values) - 1)
        want = ordered[math.floor(at)], ordered[math.ceil(at)]
        assert column == "a b" and part == at - math.floor(at)
        assert all(x == y or (x != x and y != y) for x, y in zip((below, above), want)), (p, below, above, want)
    # No window puts more rows in order than a task is meant to hold, however many the column has.
    assert max(windows, default=0) <= small


def test_columns_without_values_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None), (3, None)], "a int, b double")
    assert [tuple(r) for r in ranks.quantiles(df, ["a", "b"], [0.5]).collect()] == [("a", 0.5, 2.0)]
    assert ranks.quantiles(df.limit(0), ["a", "b"], [0.5]).count() == 0


def test_nothing_but_counts_is_shuffled(spark):
    df = spark.range(100_000).selectExpr("id * id as v")
    state = ranks._Ranks(df, "v", 0, ranks.Interval(0, 99_999**2, 0, 100_000, [5, 50_000]))
    plan = state.count_ranges()._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "Sort" not in plan and "rangepartitioning" not in plan
    assert state.count_ranges().count() <= ranks.RANGES


def test_products_past_64_bits_have_ranks(spark, folder):
    from quayside.catalog import QUERIES

    keys = [1, 9_324, 19_999, 120_000, 1_200_000]
    rows = [(k, k, 1, 100.25) for k in keys]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_linenumber long, l_extendedprice double").write.parquet(f"{folder}/lineitem.parquet")
    found = QUERIES["profile_ranks"](spark, folder).where("column_name = 'spread'").collect()
    spread = [str((k - 100) * 10**15) for k in keys]
    assert found and all(r["below"] == spread[math.floor(r["prob"] * 4)] and r["above"] == spread[math.ceil(r["prob"] * 4)] for r in found)
