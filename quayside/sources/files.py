"""File zones: CSV and Parquet, one file, a glob of part files, or every file under a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CORRUPT_COLUMN = "_corrupt_record"


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    *,
    multi_line: bool = False,
    recursive: bool = False,
    glob: str | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """CSV with a header line.

    With a schema the files are read once and a header in another column order raises; without one
    Spark reads them once more to infer types. ``multi_line`` keeps quoted newlines inside a record
    at the price of one task per file. ``keep_corrupt`` adds the text of lines that do not fit, and
    leaves the header's order unchecked.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        if isinstance(schema, str):
            schema = StructType.fromDDL(schema)
        if keep_corrupt:
            schema = StructType([*schema.fields]).add(CORRUPT_COLUMN, "string")
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        reader = reader.schema(schema).option("enforceSchema", keep_corrupt)
    if multi_line:
        reader = reader.option("multiLine", True)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.csv(path)


def scan_csv_glob(spark: SparkSession, folder: str, schema=None, **options) -> DataFrame:
    """All CSV part files of one folder as one table."""
    return scan_csv(spark, f"{folder.rstrip('/')}/*.csv", schema, **options)


def scan_staged(spark: SparkSession, folder: str, schema=None, **options) -> DataFrame:
    """Files that a transfer has put into a staging folder, at any depth."""
    return scan_csv(spark, folder, schema, recursive=True, glob="*.csv", **options)


def scan_parquet(
    spark: SparkSession, path: str, *, recursive: bool = False, schema: StructType | None = None
) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return reader.parquet(path)


def scan_lines(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """Every line under a folder with the file it came from: ``value``, ``file_path``.

    Lines end at the newline byte alone, so a carriage return stays part of its line.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .option("lineSep", "\n")
        .text(path)
    )
    return lines.select("value", "_metadata.file_path")
