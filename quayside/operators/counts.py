"""Record counts of queries, time windows and file folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quayside.functions.paths import parent_of
from quayside.operators.filters import filter_between
from quayside.sources.files import scan_lines
from quayside.sources.jdbc import count_text
from quayside.sources.tables import LOAD_TS

# The task types whose folders and whose load windows are counted.
FILE_TASKS = ("rdbms_to_gcs", "rdbms_to_gcs_dataproc", "gcs_to_gcs", "gcs_to_gcs_dataproc")
WAREHOUSE_TASKS = ("rdbms_to_bq", "rdbms_to_bigquery_dataproc")


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("records"))


def scalar_first(df: DataFrame):
    """The first cell of a result of one row."""
    return df.first()[0]


def count_query(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """The number of rows a SQL query gives; ``{name}`` in the query stands for a table."""
    return spark.sql(count_text(query), **tables)


def count_window(df: DataFrame, start, end, task_type: str, column: str = LOAD_TS) -> DataFrame:
    """Rows loaded between a task's start and end; NULL for a task that does not load a warehouse."""
    if task_type not in WAREHOUSE_TASKS:
        return _not_counted(df.sparkSession)
    return count_rows(filter_between(df, column, start, end))


def _not_counted(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.lit(None).cast("bigint").alias("records"))


def csv_line_counts(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are not empty, less one header line, for each CSV file under a folder."""
    lines = scan_lines(spark, path).where(F.col("value") != "")
    return lines.groupBy("file_path").agg((F.count(F.lit(1)) - 1).alias("records"))


_CELL = 62  # lines whose bits fit a positive long


def _with_parity(cells: DataFrame, bits: str, out: str) -> DataFrame:
    """Bit ``i`` of ``out`` says whether the bits up to ``i`` hold an odd number of ones.

    Each step is a projection of its own: as one expression it would repeat itself 64 times.
    """
    cells = cells.withColumn(out, F.col(bits))
    for step in (1, 2, 4, 8, 16, 32):
        cells = cells.withColumn(out, F.col(out).bitwiseXOR(F.shiftleft(out, step)))
    return cells


def csv_quoted_counts(
    spark: SparkSession, path: str, glob: str = "*.csv", escape: str = "\\", header: bool = True, sep: str = ","
) -> DataFrame:
    """``file_path, records, line_count`` of each CSV file, with quoted line ends inside records, over split files.

    A record ends at a line end behind which the number of quotes is even. Each task packs two bits
    of a line, whether its quotes are odd and whether it has text, into one number for 62 lines, so less
    than a byte a line is shuffled. Prefix parities are then taken inside those numbers, over the numbers
    of a file block, and over the blocks of a file: no file is read by one task as ``multiLine`` needs it,
    and no window sees more than a block's numbers or a file's blocks.

    Quotes that count stand at the beginning or the end of a value, next to ``sep`` or the line's end: one inside
    an unquoted value is a character like others. ``escape`` in front of a character takes its meaning,
    and two quotes in a row are one inside a value. Empty lines outside quotes are no records, nor is each
    file's header.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("lineSep", "\n").text(path)
        .select("value", "_metadata.file_path", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    )
    pairs = '""' if escape == '"' else f'\\{escape}.|""'
    near = f"(?:^|\\Q{sep}\\E)\"|\"(?=\\Q{sep}\\E|\\r?$)"
    bare = F.regexp_replace("value", pairs, "")
    odd = F.when(F.contains("value", F.lit('"')), F.regexp_count(bare, F.lit(near))).otherwise(F.lit(0)).cast("long")
    row = F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    bit = F.lit(1).cast("long")
    place = F.pmod(row, F.lit(_CELL)).cast("int")
    packed = lines.select(
        "file_path",
        "block",
        F.floor(row / _CELL).alias("cell"),
        F.call_function("shiftleft", odd.bitwiseAND(F.lit(1).cast("long")), place).alias("odd"),
        F.when(F.col("value").rlike("[^\\x00-\\x20]"), F.call_function("shiftleft", bit, place)).otherwise(F.lit(0)).alias("text"),
        F.call_function("shiftleft", bit, place).alias("there"),
    )
    cells = packed.groupBy("file_path", "block", "cell").agg(
        F.sum("odd").alias("odd"), F.sum("text").alias("text"), F.sum("there").alias("there")
    )
    cells, upto = _with_parity(cells, "odd", "upto"), F.col("upto")
    both = lambda bits, other: F.bit_count(bits.bitwiseAND(other)).cast("long")
    told = cells.select(
        "file_path",
        "block",
        "cell",
        F.bit_count("there").cast("long").alias("lines"),
        F.bit_count("odd").bitwiseAND(F.lit(1)).alias("flip"),
        # Records that end here if the cell begins outside quotes, and if it begins inside.
        both(F.bitwise_not(upto), F.col("text")).alias("outside"),
        both(upto, F.col("text")).alias("inside"),
    )
    before = lambda *keys: W.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(W.unboundedPreceding, -1)
    parity = lambda window: F.pmod(F.coalesce(F.sum("flip").over(window), F.lit(0)), F.lit(2))
    in_block = told.withColumn("start", parity(before("file_path", "block", "cell")))
    open_ = F.col("start") == 1
    blocks = in_block.groupBy("file_path", "block").agg(
        F.sum("lines").alias("lines"),
        F.pmod(F.sum("flip"), F.lit(2)).alias("flip"),
        F.sum(F.when(open_, F.col("inside")).otherwise(F.col("outside"))).alias("outside"),
        F.sum(F.when(open_, F.col("outside")).otherwise(F.col("inside"))).alias("inside"),
    )
    ended = blocks.withColumn("start", parity(before("file_path", "block")))
    return ended.groupBy("file_path").agg(
        F.sum(F.when(open_, F.col("inside")).otherwise(F.col("outside"))).alias("records"),
        F.sum("lines").alias("line_count"),
        F.pmod(F.sum("flip"), F.lit(2)).alias("unclosed"),
    ).select(
        "file_path",
        # A quote that is never closed makes one record of the rest of its file.
        F.greatest(F.col("records") + F.col("unclosed") - F.lit(int(header)), F.lit(0)).cast("bigint").alias("records"),
        "line_count",
    )


def count_csv_quoted(spark: SparkSession, path: str, **options) -> DataFrame:
    """Records of all CSV files under a folder, however their quoted line ends fall: one row, ``records``."""
    return total(csv_quoted_counts(spark, path, **options))


def parquet_row_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows of each Parquet file under a folder. No column is read, so only footers are."""
    files = (
        spark.read.schema(StructType([]))
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .parquet(path)
        .select("_metadata.file_path")
    )
    return files.groupBy("file_path").agg(F.count(F.lit(1)).alias("records"))


def count_by_file(spark: SparkSession, path: str) -> DataFrame:
    """Records of each CSV and Parquet file under a folder; other files are left out."""
    csv = csv_line_counts(spark, path).withColumn("format", F.lit("csv"))
    parquet = parquet_row_counts(spark, path).withColumn("format", F.lit("parquet"))
    return csv.unionByName(parquet)


def total(counts: DataFrame) -> DataFrame:
    """The sum of per-file counts; 0 for an empty folder."""
    return counts.agg(F.coalesce(F.sum("records"), F.lit(0)).cast("bigint").alias("records"))


def count_csv_records(spark: SparkSession, path: str) -> DataFrame:
    return total(csv_line_counts(spark, path))


def count_parquet_rows(spark: SparkSession, path: str) -> DataFrame:
    return total(parquet_row_counts(spark, path))


def count_folder(spark: SparkSession, path: str, task_type: str, parent: bool = False) -> DataFrame:
    """Records of all CSV and Parquet files under a folder: one row, ``records``.

    ``parent`` counts the folder above, sibling files included. NULL for a task type that does not
    move files.
    """
    if task_type not in FILE_TASKS:
        return _not_counted(spark)
    return total(count_by_file(spark, parent_of(path) if parent else path))


def reconcile_counts(source: DataFrame, destination: DataFrame, *keys: str) -> DataFrame:
    """Source and destination counts side by side for each key, with their difference.

    Both sides are counted before they meet, so the join sees one row for each key.
    """
    left = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("source_records"))
    right = destination.groupBy(*keys).agg(F.count(F.lit(1)).alias("destination_records"))
    return pair_counts(left, right, *keys)


def pair_counts(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Pair two count tables; a key that one side lacks counts as 0 there."""
    right = right.select(*[F.col(k).alias(f"right_{k}") for k in keys], "destination_records")
    same = [F.col(k).eqNullSafe(F.col(f"right_{k}")) for k in keys]
    source: Column = F.coalesce("source_records", F.lit(0).cast("bigint"))
    landed: Column = F.coalesce("destination_records", F.lit(0).cast("bigint"))
    return left.join(right, same, "full_outer").select(
        *[F.coalesce(k, f"right_{k}").alias(k) for k in keys],
        source.alias("source_records"),
        landed.alias("destination_records"),
        (source - landed).alias("diff"),
        (source == landed).alias("match"),
    )
