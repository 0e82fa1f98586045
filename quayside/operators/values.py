"""Tables of distinct values: their counts, their order, and lookups by value that stand skew."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quayside.operators.ranks import quantiles
from quayside.session import durable

__all__ = [
    "attach_by_value",
    "compact",
    "count_values",
    "in_order",
    "number_values",
    "quantiles",
    "value_key",
    "value_stats",
    "value_table",
]

_INDEX_BITS = 33  # monotonically_increasing_id: partition number above, row number below.
_DIGEST_FROM = 64  # characters; a marked digest has 65


def compact(text: Column) -> Column:
    """Long texts as their SHA-256 digest, marked so that no short text is equal to one.

    What is shuffled to compare whole texts is then bounded, whatever their length.
    """
    long = F.length(text) > _DIGEST_FROM
    return F.when(long, F.concat(F.lit("#"), F.sha2(text, 256))).otherwise(text)


def value_key(df: DataFrame, column: str) -> Column:
    """What is grouped to tell values apart: the value in its own type, long texts compacted."""
    return compact(F.col(column)) if isinstance(df.schema[column].dataType, StringType) else F.col(column)


def count_values(df: DataFrame, key: Column) -> DataFrame:
    """``value, n`` for values that are not null, counted before and after the shuffle."""
    kept = df.select(key.alias("value")).where(F.col("value").isNotNull())
    return kept.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


def value_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """For each column: its values, the distinct ones among them, and those that occur again.

    Each column is grouped alone and in its own type. On a columnar table that reads every column
    once, and no row is multiplied; a text source is better copied into a columnar one first.
    """
    repeated = F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(F.lit(0)))
    parts = []
    for column in columns:
        stats = count_values(df, value_key(df, column)).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("value_count"),
            F.count(F.lit(1)).alias("distinct_count"),
            F.coalesce(repeated, F.lit(0)).alias("repeated_count"),
        )
        parts.append(stats.select(F.lit(column).alias("column_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


def in_order(df: DataFrame, *order: str) -> DataFrame:
    """Written in range partitions of ``order``; ``span`` is the partition, ``place`` the row in it.

    Range bounds come from a sample, so the table is written before anything counts on them.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = durable(ranged.withColumn("mid", F.monotonically_increasing_id()), "in-order")
    return stored.withColumn("span", F.shiftright("mid", _INDEX_BITS).cast("int")).withColumn(
        "place", F.col("mid").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    ).drop("mid")


def number_values(distinct: DataFrame, column: str, out: str) -> DataFrame:
    """Number distinct rows from 1 in the order of ``column`` without one task seeing them all.

    Each range partition knows its rows' places; the running total over partition sizes, one row
    for each partition, gives the place where it starts.
    """
    ordered = in_order(distinct, column)
    sizes = ordered.groupBy("span").agg(F.count(F.lit(1)).alias("size"))
    before = W.orderBy("span").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("span", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    # One row for each written partition, whatever the data's size.
    numbered = ordered.join(F.broadcast(starts), "span")
    return numbered.withColumn(out, F.col("start") + F.col("place") + 1).drop("span", "place", "start")


def value_table(values: DataFrame) -> DataFrame:
    """Store a table of ``value, n`` and payload columns for :func:`attach_by_value`."""
    return durable(values.withColumn("slot", F.lit(0)), "values")


def attach_by_value(facts: DataFrame, key: Column, table: DataFrame, payload: str, parts: int = 256) -> DataFrame:
    """Left join of ``facts`` with a :func:`value_table` that holds up when few values hold most rows.

    A value with more than one row in ``parts`` is hot; there are fewer than ``parts`` of them, so
    they are looked up by broadcast. Rows settled that way, and rows without a value, go to the
    second join under one of ``parts`` slots that no table row has, which spreads them; all other
    rows meet their value in slot 0. Every row is read once and kept.

    A slot follows from the row and its partition: a task that runs again gives the same slots in
    whatever order it sees its rows, and copies of one row are spread as far as their partitions.
    """
    share = (table.agg(F.sum("n")).first()[0] or 0) // parts
    hot = table.where(F.col("n") > share).select(
        F.col("value").alias("hot_value"), F.col(payload).alias("hot_payload")
    )
    cold = table.where(F.col("n") <= share).select(
        F.col("value").alias("cold_value"), F.col("slot").alias("cold_slot"), F.col(payload).alias("cold_payload")
    )
    names = facts.columns
    seen = facts.withColumn("look", key).join(F.broadcast(hot), F.col("look") == F.col("hot_value"), "left")
    settled = F.col("hot_value").isNotNull() | F.col("look").isNull()
    hashed = [f.name for f in facts.schema.fields if "map<" not in f.dataType.simpleString()]
    spread = (1 + F.pmod(F.xxhash64(F.spark_partition_id(), *hashed), F.lit(parts))).cast("int")
    slotted = seen.withColumn("slot", F.when(settled, spread).otherwise(F.lit(0)))
    joined = slotted.join(
        cold, (F.col("look") == F.col("cold_value")) & (F.col("slot") == F.col("cold_slot")), "left"
    )
    return joined.select(*names, F.coalesce("hot_payload", "cold_payload").alias(payload))
