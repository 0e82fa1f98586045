"""Warehouse append, switched by the run's load flag."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.sources.tables import LOAD_TS


def add_load_timestamp(df: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Stamp every row with the time of its load, the column that load counts look at."""
    return df.withColumn(LOAD_TS, F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz"))


def sink_warehouse_gated(
    df: DataFrame,
    table: str,
    load_flag: str,
    fmt: str = "parquet",
    by_name: bool = False,
    load_column: str | None = None,
    **options: str,
) -> bool:
    """Append when the flag is exactly ``'True'``; says whether it wrote.

    ``table`` is a folder, or a table name when ``by_name`` is set. ``options`` go to the connector,
    such as the bucket it stages through. With ``load_column`` the table is partitioned by it, and
    a load that is repeated replaces its own rows instead of adding them again.
    """
    if load_flag != "True":
        return False
    writer = df.write.mode("append").format(fmt).options(**options)
    if load_column:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(load_column)
    if by_name:
        writer.saveAsTable(table)
    else:
        writer.save(table)
    return True
