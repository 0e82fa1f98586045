"""Exact most frequent values without shuffling all of them.

Tasks keep a bounded number of counters each (frequent-items sketches), which merge with a known error:
a value that is more frequent than twice that error is among the candidates. The candidates are counted
again, exactly, with at most their number of rows from each task. If the last wanted count lies above the
bound, no other value can be among the wanted ones; if not, all values are counted.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quayside.operators.values import compact, count_values, value_key

COUNTERS = 10_000


@dataclass(frozen=True)
class HeavyHitters:
    """The most frequent values and how they were found."""

    rows: DataFrame  # ``value, n``, most frequent first
    certain: bool  # whether candidates were enough, or all values had to be counted
    bound: int  # a value that is more frequent than this is a candidate
    candidates: int


def miss_bound(rows: int, counters: int) -> int:
    """How frequent a value may be and still be no candidate: twice the sketch's error of 3.5 rows in its size.

    The size is the least power of two of which three quarters hold the counters; as long as all
    distinct values fit, there is no error, but that is not known beforehand.
    """
    size = 1 << max(math.ceil(math.log2(counters / 0.75)), 3)
    return math.ceil(2 * 3.5 * rows / size)


def heavy_hitters(df: DataFrame, column: str, k: int = 10, counters: int = COUNTERS) -> HeavyHitters:
    """The ``k`` most frequent values of a column that are not null; equal counts are ordered by value.

    Long texts are told apart by digest until the ``k`` values are known, so neither counters nor
    candidates hold whole texts.
    """
    key = value_key(df, column)
    keys = df.select(key.alias("value")).where(F.col("value").isNotNull())
    found = keys.agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(value, {counters}, {counters})").alias("items")
    ).first()
    bound = miss_bound(found["rows"], counters)
    items = [item["item"] for item in found["items"] or ()]
    kind = keys.schema["value"].dataType
    counts = None
    if items:
        # At most ``counters`` values.
        candidates = df.sparkSession.createDataFrame([(item,) for item in items], f"value {kind.simpleString()}")
        near = keys.join(F.broadcast(candidates), "value", "left_semi")
        counts = near.groupBy("value").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value")
        told = counts.limit(k + 1).collect()
        if len(told) >= k and told[k - 1]["n"] > bound:
            last = told[k - 1]["n"]
            # Ties at the last place are settled by the whole value, so all of them are looked at.
            rows = counts.where(F.col("n") >= last)
            return HeavyHitters(_whole(df, column, rows, k), True, bound, len(items))
    rows = count_values(df, key)
    return HeavyHitters(_whole(df, column, rows, k), False, bound, len(items))


def _whole(df: DataFrame, column: str, counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` first of counted keys, with their whole values."""
    value = F.col(f"`{column}`")
    if not isinstance(df.schema[column].dataType, StringType):
        return counts.orderBy(F.desc("n"), "value").limit(k)
    last = counts.orderBy(F.desc("n")).limit(k).agg(F.min("n")).first()[0]
    # Digests do not order as texts do: texts of all keys that may be among the first are looked up.
    may = counts.where(F.col("n") >= F.lit(last)).select(F.col("value").alias("key"), "n")
    texts = df.select(compact(value).alias("key"), value.alias("value")).join(may, "key").groupBy("key", "n").agg(F.first("value").alias("value"))
    return texts.select("value", "n").orderBy(F.desc("n"), "value").limit(k)
