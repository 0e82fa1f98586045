"""Profiling reports as tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.quality import has_order, observed_text
from quayside.operators.values import count_values, quantiles, value_key, value_stats

COLUMNS_PER_PASS = 10
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _passes(df: DataFrame, columns: Sequence[str]) -> list[list[str]]:
    """Columns by the pass that measures them.

    Texts go apart from the rest: one text minimum takes a whole aggregation off the fast path. A
    pass is narrow enough for generated code, and each column is read by one pass alone.
    """
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    others = [c for c in columns if c not in texts]
    return [g[i : i + COLUMNS_PER_PASS] for g in (others, texts) for i in range(0, len(g), COLUMNS_PER_PASS)]


def _measures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One aggregation over some columns, turned into one row for each of them."""
    aggs, cells = [F.count(F.lit(1)).alias("rows")], []
    for at, name in enumerate(columns):
        value, kind = F.col(name), df.schema[name].dataType
        measures = {"seen": F.count(value)}
        if has_order(kind):
            measures |= {"min": F.min(value), "max": F.max(value)}
        if isinstance(kind, T.NumericType):
            measures |= {"mean": F.avg(value), "std": F.stddev_samp(value)}
        if isinstance(kind, T.StringType):
            measures |= {"short": F.min(F.length(value)), "long": F.max(F.length(value))}
        aggs += [measure.alias(f"{label}_{at}") for label, measure in measures.items()]

        def found(label: str, absent: str, at: int = at, measures: dict = measures) -> Column:
            return F.col(f"{label}_{at}") if label in measures else F.lit(None).cast(absent)

        nulls = F.col("rows") - F.col(f"seen_{at}")
        cells.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(kind.simpleString()).alias("data_type"),
                F.col("rows").alias("row_count"),
                nulls.alias("null_count"),
                F.when(F.col("rows") > 0, F.lit(100.0) * nulls / F.col("rows")).alias("null_pct"),
                observed_text(found("min", "string"), kind).alias("min_value"),
                observed_text(found("max", "string"), kind).alias("max_value"),
                F.round(found("mean", "double"), 4).cast("double").alias("mean_value"),
                F.round(found("std", "double"), 4).cast("double").alias("std_value"),
                found("short", "int").alias("min_length"),
                found("long", "int").alias("max_length"),
            )
        )
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Type, nulls, distinct values, range, mean, spread and text lengths of each column.

    ``exact=False`` estimates the distinct values from sketches in a single pass without a shuffle
    of values.
    """
    columns = list(columns or df.columns)
    measured = reduce(DataFrame.unionByName, [_measures(df, group) for group in _passes(df, columns)])
    if exact:
        distinct = value_stats(df, columns).select("column_name", "distinct_count")
    else:
        one = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("distinct_count")) for c in columns]
        distinct = one.select(F.inline(F.array(*cells)))
    # Two rows for each column, put together into one.
    both = measured.unionByName(distinct, allowMissingColumns=True)
    rest = [F.max(c).alias(c) for c in both.columns if c not in ("column_name", "distinct_count")]
    whole = F.coalesce(F.max("distinct_count"), F.lit(0)).cast("bigint").alias("distinct_count")
    return both.groupBy("column_name").agg(*rest, whole)


def preview(df: DataFrame, *order: str, rows: int = 20) -> DataFrame:
    """The first rows in an order: each task keeps its own first rows before they meet."""
    return df.orderBy(*order).limit(rows)


def profile_table(df: DataFrame) -> DataFrame:
    """Rows, columns, rows that repeat another row, and missing cells.

    Rows are grouped by their values, long texts by digest, which bounds what is shuffled of each.
    """
    missing = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("bigint") for c in df.columns])
    keys = [value_key(df, name).alias(f"key_{at}") for at, name in enumerate(df.columns)]
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_rows"), F.sum(missing).alias("group_missing"))
    return groups.agg(
        F.coalesce(F.sum("group_rows"), F.lit(0)).cast("bigint").alias("row_count"),
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        F.coalesce(F.sum(F.col("group_rows") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"),
        F.coalesce(F.sum("group_missing"), F.lit(0)).cast("bigint").alias("missing_cells"),
    )


def profile_topk(df: DataFrame, columns: Sequence[str], k: int = 10) -> DataFrame:
    """The most frequent values of each column; equal counts are ordered by value.

    Every task keeps only its own first ``k`` before the values meet.
    """
    tops = []
    for column in columns:
        counts = count_values(df, F.col(column)).select(F.col("value").cast("string").alias("value"), "n")
        top = counts.orderBy(F.desc("n"), "value").limit(k)
        tops.append(top.select(F.lit(column).alias("column_name"), "value", "n"))
    order = W.partitionBy("column_name").orderBy(F.desc("n"), "value")
    return reduce(DataFrame.unionByName, tops).withColumn("rank", F.row_number().over(order))


def profile_quantiles(
    df: DataFrame, columns: Sequence[str] | None = None, probs: Sequence[float] = QUANTILES, exact: bool = True
) -> DataFrame:
    """Quantiles of numeric columns; ``exact=False`` takes them from sketches in one pass."""
    columns = list(columns or numeric_columns(df))
    if exact:
        return quantiles(df, columns, probs)
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns]
    sketch = (
        df.select(F.inline(F.array(*cells)))
        .groupBy("column_name")
        .agg(F.percentile_approx("value", [float(p) for p in probs], 10_000).alias("found"))
    )
    listed = F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("prob"), F.col("found").alias("quantile"))
    return sketch.select("column_name", F.inline(listed).alias("prob", "quantile"))


def profile_histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Counts in ``bins`` equally wide ranges from the least to the greatest value, empty ones too.

    The last range holds the greatest value. Values without a place among the ranges (NaN and the
    infinities) have a row of their own, ``bin`` -1 without bounds, if there are any.
    """
    given = F.col(column).cast("double")
    finite = ~F.isnan(given) & (F.abs(given) < F.lit(float("inf")))
    value = F.when(finite, given)
    odd = df.where(~finite).agg(F.count(F.lit(1)).alias("records")).where("records > 0").selectExpr(
        "-1 as bin", "cast(null as double) as low", "cast(null as double) as high", "records"
    )
    low, high = df.agg(F.min(value), F.max(value)).first()
    if low is None:
        return odd
    width = (high - low) / bins
    at = F.lit(0) if width == 0 else F.least(F.floor((value - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
    counts = (
        df.where(value.isNotNull())
        .groupBy(at.cast("int").alias("at"))
        .agg(F.count(F.lit(1)).alias("found"))
    )
    ranges = df.sparkSession.range(1 if width == 0 else bins).select(F.col("id").cast("int").alias("bin"))
    return ranges.join(counts, F.col("bin") == F.col("at"), "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("low"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("high"),
        F.coalesce("found", F.lit(0)).cast("bigint").alias("records"),
    ).unionByName(odd)

