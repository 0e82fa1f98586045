"""What a write has left: its committed files with their rows and contents.

Counters that run inside a write see a task twice when it runs twice. The manifest is made from the files
that the write has committed, so attempts that failed or lost a race are not in it, and it can be
checked against the folder later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quayside.operators.reconcile import SUMS, hash_sums, row_hashes
from quayside.sinks.files import read_options, sink_format

FOLDER = "_manifest"  # readers pass over names with an underscore in front
FIELDS = ("file", "size", "rows", *SUMS)


def read_zone(spark: SparkSession, path: str, schema: StructType, fmt: str, multi_line: bool = False) -> DataFrame:
    """Rows of a zone that the engine has written, with the file that each is in."""
    reader = spark.read.schema(schema).options(**read_options(fmt))
    if fmt in ("csv", "json") and multi_line:
        reader = reader.option("multiLine", True)
    return reader.format(fmt).load(path)


def describe_files(spark: SparkSession, path: str, schema: StructType, fmt: str, multi_line: bool = False) -> DataFrame:
    """``file, size, rows`` and order-free sums of row hashes for each file that holds rows."""
    rows = read_zone(spark, path, schema, fmt, multi_line)
    placed = rows.select(
        "*",
        *row_hashes(rows, schema.names),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_size").alias("_size"),
    )
    # Paths are told from the zone on, so that a zone that was moved keeps its manifest.
    name = F.regexp_replace("_file", "^.*/" + path.rstrip("/").rpartition("/")[2].replace(".", "[.]") + "/", "")
    return placed.groupBy(name.alias("file"), F.col("_size").alias("size")).agg(*hash_sums())


def write_with_manifest(df: DataFrame, path: str, fmt: str = "parquet", multi_line: bool = False) -> DataFrame:
    """Write a zone folder and leave its manifest in it; gives the manifest."""
    spark = df.sparkSession
    sink_format(df, path, fmt)
    describe_files(spark, path, df.schema, fmt, multi_line).write.mode("overwrite").parquet(f"{path}/{FOLDER}")
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{FOLDER}")


def check_manifest(spark: SparkSession, path: str, schema: StructType, fmt: str, multi_line: bool = False) -> DataFrame:
    """Files that are no longer as the manifest says: ``file, change`` (missing, added or changed)."""
    stored = read_manifest(spark, path).select("file", F.struct(*FIELDS[1:]).alias("was"))
    now = describe_files(spark, path, schema, fmt, multi_line).select("file", F.struct(*FIELDS[1:]).alias("now"))
    both = stored.join(now, "file", "full_outer").where(~F.col("was").eqNullSafe(F.col("now")))
    change = F.when(F.col("now").isNull(), "missing").when(F.col("was").isNull(), "added").otherwise("changed")
    return both.select("file", change.alias("change"))
