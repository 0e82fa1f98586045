"""Profiles of single runs that merge into the profile of many, without reading any run again.

A run leaves one small row for each column: counts, sums and bounds that add up, a sketch of its distinct
values (HyperLogLog) and one of its distribution (KLL). Sketches of runs unite into the sketch
that all rows together would have given, with the error that is stated for it.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.quality import has_order, observed_text
from quayside.operators.values import compact
from quayside.sinks.commits import CommitLog

LG_K = 14
#: Three standard errors of the union of HyperLogLog sketches, as a share.
DISTINCT_ERROR = 3 * 1.04 / math.sqrt(1 << LG_K)
KLL_K = 400
#: Rank error of a KLL sketch of this size at 99 % confidence, as a share of the rows.
RANK_ERROR = 2.296 / KLL_K**0.9021

SCHEMA = (
    "run string, column_name string, data_type string, rows bigint, nulls bigint, min_value string, max_value string, "
    "total double, squares double, values_sketch binary, ranks_sketch binary"
)


def _countable(value, kind: T.DataType):
    """A value in a type that sketches take; equal values stay equal."""
    if isinstance(kind, T.StringType):
        return compact(value)
    if isinstance(kind, T.IntegralType):
        return value.cast("bigint")
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(F.struct(value), {"ignoreNullFields": "false"})
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        value = F.when(value == 0, F.lit(0).cast(kind)).otherwise(value)
    return value.cast("string")


class ProfileStore:
    """Profiles of runs under one folder; a run that is added again replaces its rows."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.commits = CommitLog(spark, f"{self.path}/_commits")

    def add(self, run: str, df: DataFrame, columns: Sequence[str] | None = None) -> None:
        """Profile ``df`` in one pass over its rows and store the result under the run's name."""
        aggs, cells = [F.count(F.lit(1)).alias("rows")], []
        for at, name in enumerate(columns or df.columns):
            kind, value = df.schema[name].dataType, F.col(f"`{name}`")
            number = isinstance(kind, T.NumericType)
            real = value.cast("double")
            aggs += [
                F.count(value).alias(f"seen{at}"),
                (F.min(value) if has_order(kind) else F.lit(None).cast("string")).alias(f"low{at}"),
                (F.max(value) if has_order(kind) else F.lit(None).cast("string")).alias(f"high{at}"),
                (F.sum(real) if number else F.lit(None).cast("double")).alias(f"total{at}"),
                (F.sum(real * real) if number else F.lit(None).cast("double")).alias(f"squares{at}"),
                F.hll_sketch_agg(_countable(value, kind), LG_K).alias(f"values{at}"),
                (F.kll_sketch_agg_double(real, KLL_K) if number else F.lit(None).cast("binary")).alias(f"ranks{at}"),
            ]
            low, high = (observed_text(F.col(f"{end}{at}"), kind) if has_order(kind) else F.col(f"{end}{at}") for end in ("low", "high"))
            cells.append(
                F.struct(
                    F.lit(run).alias("run"),
                    F.lit(name).alias("column_name"),
                    F.lit(kind.simpleString()).alias("data_type"),
                    F.col("rows"),
                    (F.col("rows") - F.col(f"seen{at}")).alias("nulls"),
                    low.alias("min_value"),
                    high.alias("max_value"),
                    F.col(f"total{at}").alias("total"),
                    F.col(f"squares{at}").alias("squares"),
                    F.col(f"values{at}").alias("values_sketch"),
                    F.col(f"ranks{at}").alias("ranks_sketch"),
                )
            )
        folder = f"profile-{uuid.uuid4()}"
        df.agg(*aggs).select(F.inline(F.array(*cells))).write.parquet(f"{self.path}/{folder}")
        while not self.commits.commit(self.commits.newest() + 1, {"run": run, "folder": folder}):
            pass  # another run was first: take the next number

    def read(self, runs: Sequence[str] | None = None) -> DataFrame:
        """Stored rows of all runs, or of some: the last that each run has added."""
        last = {body["run"]: body["folder"] for body in self.commits.bodies()}
        folders = [f"{self.path}/{folder}" for run, folder in sorted(last.items()) if runs is None or run in runs]
        if not folders:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(*folders)

    def merged(self, runs: Sequence[str] | None = None, probs: Sequence[float] = (0.5,)) -> DataFrame:
        """The profile of many runs together, one row for each column.

        ``distinct_estimate`` lies within ``distinct_error`` (a share of the true number), and the ranks of
        ``quantiles`` within ``rank_error`` of the wanted ones, in all but a few of a hundred cases.
        """
        stored = self.read(runs).groupBy("column_name", "data_type")
        filled = F.sum("rows") - F.sum("nulls")
        mean = F.sum("total") / filled
        spread = (F.sum("squares") - filled * mean * mean) / F.nullif(filled - 1, F.lit(0))
        # KLL sketches cannot be read where there are no numbers.
        ranks = F.kll_merge_agg_double("ranks_sketch")
        found = stored.agg(
            F.count_distinct("run").alias("runs"),
            F.sum("rows").alias("row_count"),
            F.sum("nulls").alias("null_count"),
            mean.alias("mean_value"),
            F.sqrt(F.greatest(spread, F.lit(0.0))).alias("std_value"),
            F.hll_sketch_estimate(F.hll_union_agg("values_sketch")).alias("distinct_estimate"),
            ranks.alias("ranks"),
            F.max(F.col("ranks_sketch").isNotNull()).alias("ranked"),
        )
        wanted = F.array(*[F.lit(float(p)) for p in probs])
        numbers = F.when(F.col("ranked") & (F.col("row_count") > F.col("null_count")), F.kll_sketch_get_quantile_double("ranks", wanted))
        return found.withColumn("quantiles", numbers).drop("ranks", "ranked").withColumns(
            {"distinct_error": F.lit(DISTINCT_ERROR), "rank_error": F.lit(RANK_ERROR)}
        )
