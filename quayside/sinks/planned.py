"""Partitioned writes with planned file sizes.

Rows are counted for each partition value first. Values with many rows are split into as many tasks as
files of the target size need; values with few are packed into tasks one after the other until a
task has enough. So a hot value is no load of one task, and rare values cost neither a task nor more
than one file each.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayside.operators.values import in_order
from quayside.session import durable
from quayside.sinks.files import sink_partitioned

ROWS_PER_FILE = 1_000_000


def plan_files(df: DataFrame, columns: Sequence[str], rows_per_file: int = ROWS_PER_FILE) -> tuple[DataFrame, int]:
    """``columns, n, first, pieces`` for every partition value, and how many tasks there are.

    A value has ``pieces`` tasks from ``first`` on, or shares its only one with neighbours in order.
    Values are put in order over range partitions, and running totals are taken over the
    partitions' totals and then inside them, so no window sees all values.
    """
    counts = df.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias("n"))
    hot = F.col("n") > rows_per_file
    sized = counts.withColumn("pieces", F.when(hot, F.ceil(F.col("n") / rows_per_file)).otherwise(F.lit(0)).cast("int"))
    sized = sized.withColumn("cold", F.when(hot, F.lit(0)).otherwise(F.col("n")))
    ordered = in_order(sized, *[f"`{c}`" for c in columns])
    totals = ordered.groupBy("span").agg(F.sum("pieces").alias("pieces"), F.sum("cold").alias("cold"))
    before = W.orderBy("span").rowsBetween(W.unboundedPreceding, -1)
    # One row for each range partition.
    starts = totals.select("span", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("pieces", "cold")])
    ends = totals.agg(F.coalesce(F.sum("pieces"), F.lit(0)), F.coalesce(F.sum("cold"), F.lit(0))).first()
    inside = W.partitionBy("span").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    upto = lambda c: F.col(f"{c}_before") + F.coalesce(F.sum(c).over(inside), F.lit(0))
    placed = ordered.join(F.broadcast(starts), "span").withColumns({"ahead": upto("pieces"), "cold_ahead": upto("cold")})
    # A task of rare values takes those that begin within its stretch of the target size.
    shared = F.lit(ends[0]) + F.floor(F.col("cold_ahead") / rows_per_file)
    first = F.when(F.col("pieces") > 0, F.col("ahead")).otherwise(shared).cast("int")
    plan = placed.select(*[F.col(f"`{c}`") for c in columns], "n", first.alias("first"), F.greatest("pieces", F.lit(1)).alias("pieces"))
    return durable(plan, "file-plan"), int(ends[0]) + (int(ends[1]) - 1) // rows_per_file + 1 if ends[1] else max(int(ends[0]), 1)


def sink_planned(
    df: DataFrame, path: str, columns: Sequence[str], fmt: str = "parquet", rows_per_file: int = ROWS_PER_FILE, replace: str = "dynamic"
) -> DataFrame:
    """Write one folder for each partition value in files of about the target size; gives the plan.

    A file of a split value has the target size within the evenness of a hash of its rows; equal rows of
    one input partition stay together.
    """
    plan, tasks = plan_files(df, columns, rows_per_file)
    named = plan.select(*[F.col(f"`{c}`").alias(f"_plan{at}") for at, c in enumerate(columns)], "first", "pieces")
    same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"_plan{at}")) for at, c in enumerate(columns)])
    # From the row and its partition, so that a task that runs again deals its rows out as before.
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *hashed), F.col("pieces"))
    # The plan has one row for each value; Spark broadcasts it if it is small.
    placed = df.join(named, same, "left").withColumn("_task", (F.col("first") + salt).cast("int"))
    rows = placed.repartitionById(tasks, F.col("_task")).select(*[F.col(f"`{c}`") for c in df.columns])
    sink_partitioned(rows, path, columns, fmt, replace=replace)
    return plan
