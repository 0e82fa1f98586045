"""File sinks. A run writes to its own folder, so a repeated run replaces only its own files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

FORMATS = ("csv", "parquet", "json", "orc")

# Text formats keep times to the microsecond; their default stops at the millisecond.
TEXT_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


# Values are written as they are; the writer's default cuts blanks off their ends. Records end at the
# newline alone on both sides, so that a carriage return stays part of its value.
CSV_OPTIONS = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "lineSep": "\n",
}

# A missing value is written as nothing and an empty text as two quotes. Read back with a null mark
# that no value has, both come back as what they were. A value that equals the mark is refused when
# it is written, since it would come back as missing.
NULL_MARK = "\u0001null 6fd0c1a4\u0001"
ZONE_NULL = {"nullValue": NULL_MARK}


def write_options(fmt: str) -> dict[str, str]:
    return {**(CSV_OPTIONS if fmt == "csv" else {}), **(TEXT_OPTIONS if fmt in ("csv", "json") else {})}


def read_options(fmt: str) -> dict[str, str]:
    """Options with which the engine reads the zones that it has written."""
    return {**write_options(fmt), **(ZONE_NULL if fmt == "csv" else {})}


def without_mark(df: DataFrame) -> DataFrame:
    """``df``, and an error for a text that equals the null mark."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]

    def checked(name: str):
        value = F.col(f"`{name}`")
        message = F.lit(f"column {name} holds the null mark of CSV zones")
        return F.when(value == NULL_MARK, F.raise_error(message)).otherwise(value).alias(name)

    return df.withColumns({name: checked(name) for name in texts}) if texts else df


def sink_csv(df: DataFrame, path: str) -> str:
    return sink_format(df, path, "csv")


def sink_format(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite", **options: str) -> str:
    """Write in one of the served formats; CSV gets a header line. ``options`` go to the writer."""
    if fmt not in FORMATS:
        raise ValueError(f"output format {fmt!r} is not one of {', '.join(FORMATS)}")
    df = without_mark(df) if fmt == "csv" else df
    df.write.format(fmt).mode(mode).options(**{**write_options(fmt), **options}).save(path)
    return path


def sink_partitioned(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    fmt: str = "parquet",
    files_per_value: int | None = None,
    replace: str = "dynamic",
    **options: str,
) -> str:
    """Write one folder per partition value; a rewrite replaces only the partitions it holds, or with
    ``replace="static"`` the whole folder.

    Rows stay in the tasks that made them, so a value that holds a large share of the rows is
    written by many tasks. Where the column has many values that makes many small files:
    ``files_per_value`` gathers the rows of each value into that many tasks first, still never one.
    """
    if not columns:
        return sink_format(df, path, fmt, **options)
    if files_per_value:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_value))
        df = df.repartition(*columns, salt)
    df = without_mark(df) if fmt == "csv" else df
    (
        df.write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", replace)
        .options(**{**write_options(fmt), **options})
        .partitionBy(*columns)
        .save(path)
    )
    return path


def sink_observed(df: DataFrame, path: str, fmt: str = "csv", strict: bool = False) -> int:
    """Write and return the number of rows written, counted by the write itself.

    A task that runs twice can be counted twice; ``strict`` counts the written files instead.
    """
    seen = Observation()
    sink_format(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, fmt)
    if strict:
        return df.sparkSession.read.format(fmt).schema(df.schema).options(header=True).load(path).count()
    return seen.get["rows"]
