"""Warehouse tables and configuration tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOAD_TS = "insertion_timestamp"


def scan_warehouse(spark: SparkSession, table: str, fmt: str | None = None) -> DataFrame:
    """A table by name, or a folder of files when a format is given."""
    return spark.read.format(fmt).load(table) if fmt else spark.table(table)


def lookup_config(conf: DataFrame, code_column: str, order_column: str, code: str | None = None) -> DataFrame:
    """The newest configuration row of each code, or of one code.

    ``order_column`` decides which row counts when a code has several.
    """
    if code is not None:
        conf = conf.where(F.col(code_column) == F.lit(code))
    newest = F.max_by(F.struct(*conf.columns), F.col(order_column)).alias("row")
    return conf.groupBy(code_column).agg(newest).select("row.*")
