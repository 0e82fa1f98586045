"""Row filters that reach the scan: values are bound as literals of the column's type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.paths import has_suffix


def filter_eq(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose column equals a value; the value is bound, never put into query text."""
    return df.where(F.col(column) == F.lit(value).cast(df.schema[column].dataType))


def filter_between(df: DataFrame, column: str, start, end) -> DataFrame:
    """Rows from start to end, both included; literals take the column's type so the scan can skip."""
    kind = df.schema[column].dataType
    return df.where(F.col(column).between(F.lit(start).cast(kind), F.lit(end).cast(kind)))


def filter_suffix(df: DataFrame, column: str, *suffixes: str) -> DataFrame:
    """Rows whose path ends with one of the suffixes."""
    kept = F.lit(False)
    for suffix in suffixes:
        kept = kept | has_suffix(F.col(column), suffix)
    return df.where(kept)


def split_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row for each line of a text column: the key, ``line_no`` from 1, ``line``."""
    lines = F.posexplode(F.split(F.col(text), "\n", -1)).alias("pos", "line")
    return df.select(key, lines).select(key, (F.col("pos") + 1).alias("line_no"), "line")


def filter_blank_lines(lines: DataFrame, column: str = "line") -> DataFrame:
    """Drop empty lines; a line of spaces is kept."""
    return lines.where(F.col(column) != "")
