"""Surrogate keys: one number for each distinct value, the same in every run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.values import attach_by_value, count_values, number_values, value_table

MAP_SCHEMA = "value string, surrogate_id bigint"


class SurrogateMap:
    """The values known so far and their numbers, in an append-only folder with one writer."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def read(self) -> DataFrame:
        # The map is made, empty, when there is none.
        self.spark.createDataFrame([], MAP_SCHEMA).write.mode("ignore").parquet(self.path)
        return self.spark.read.schema(MAP_SCHEMA).parquet(self.path)

    def extend(self, df: DataFrame, column: str) -> DataFrame:
        """Number the values of ``column`` that are new, in their order, above all known numbers.

        Gives the values in ``df`` with their counts and numbers. Only distinct values are matched
        with the map, so a hot value weighs as much as any other, and the match shares the
        partitions in which the values were counted.
        """
        known = self.read()
        top = known.agg(F.max("surrogate_id")).first()[0] or 0
        counts = count_values(df, F.col(column).cast("string"))
        seen = value_table(counts.join(known, "value", "left"))
        fresh = number_values(seen.where(F.col("surrogate_id").isNull()).drop("surrogate_id"), "value", "rank")
        fresh = fresh.withColumn("surrogate_id", (F.col("rank") + F.lit(top)).cast("bigint")).drop("rank")
        fresh.select("value", "surrogate_id").write.mode("append").parquet(self.path)
        return seen.where(F.col("surrogate_id").isNotNull()).unionByName(fresh)

    def attach(self, df: DataFrame, column: str, out: str) -> DataFrame:
        """``df`` with the surrogate of ``column`` as column ``out``; NULL stays NULL."""
        table = self.extend(df, column).withColumnRenamed("surrogate_id", out)
        return attach_by_value(df, F.col(column).cast("string"), table, out)
