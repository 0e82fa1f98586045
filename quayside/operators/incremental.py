"""Incremental loads by a growing column."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from quayside.sinks.commits import CommitLog

INCREMENT = "_increment"


def filter_incremental(df: DataFrame, column: str, last) -> DataFrame:
    """Rows past the stored value; an empty column name loads everything.

    The stored value is cast to the column's type, so the filter reaches the scan. Rows without a
    value in the column are not loaded.
    """
    if not column:
        return df
    if last is None or last == "":
        return df.where(F.col(column).isNotNull())
    return df.where(F.col(column) > F.lit(last).cast(df.schema[column].dataType))


def next_watermark(loaded: DataFrame, column: str, last) -> DataFrame:
    """The value to store for the next load; the old one when nothing was loaded."""
    kind = loaded.schema[column].dataType
    newest = F.coalesce(F.max(column), F.lit(last).cast(kind))
    return loaded.agg(newest.alias("incremental_column_value"))


def split_increment(df: DataFrame, column: str, last) -> DataFrame:
    """``df`` with ``_increment``: what the stored value says of each row.

    ``new`` is past it, ``tied`` equal to it, ``old`` below it, and ``none`` has no value. Without a
    stored value every row that has one is new.
    """
    value = F.col(column)
    if last is None or last == "":
        return df.withColumn(INCREMENT, F.when(value.isNull(), "none").otherwise("new"))
    stored = F.lit(last).cast(df.schema[column].dataType)
    kind = F.when(value.isNull(), "none").when(value > stored, "new").when(value == stored, "tied").otherwise("old")
    return df.withColumn(INCREMENT, kind)


def increment_counts(df: DataFrame, column: str, last) -> DataFrame:
    """How many rows are ``new``, ``tied``, ``old`` and without a value: one row."""
    kinds = split_increment(df, column, last)
    return kinds.agg(*[F.count_if(F.col(INCREMENT) == kind).alias(kind) for kind in ("new", "tied", "old", "none")])



class KeyLedger:
    """Digests of loaded rows near the stored value of their growing column, in an append-only folder.

    A load of the rows past the stored value loses rows that tie with it, or lie below it, and arrive
    later. With a ledger a load also looks at an overlap below the stored value and takes from it what the
    ledger does not have. Equal rows are counted, so one that really comes twice is loaded twice.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.commits = CommitLog(spark, f"{self.path}/_commits")

    def _known(self, since, kind: DataType) -> DataFrame | None:
        folders = [f"{self.path}/{body['folder']}" for body in self.commits.bodies()]
        if not folders:
            return None
        # Only entries of the overlap are read: the filter reaches the scan.
        return self.spark.read.parquet(*folders).where(F.col("value") >= F.lit(since).cast(kind))

    def unseen(self, rows: DataFrame, column: str, since) -> DataFrame:
        """Those of ``rows`` that no load has had; all of them have values from ``since`` on.

        Rows and ledger are counted by digest before they meet, so no group of equal rows is gathered.
        """
        whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
        mine = rows.groupBy(_digest(rows).alias("digest")).agg(F.count(F.lit(1)).alias("copies"), F.first(whole).alias("row"))
        known = self._known(since, rows.schema[column].dataType)
        if known is None:
            return rows
        had = known.groupBy("digest").agg(F.sum("copies").alias("had"))
        left = mine.join(had, "digest", "left").withColumn("fresh", F.col("copies") - F.coalesce("had", F.lit(0)))
        copies = F.sequence(F.lit(1).cast("long"), F.col("fresh"))
        return left.where("fresh > 0").select(F.explode(copies), "row").select("row.*")

    def record(self, loaded: DataFrame, column: str, since) -> None:
        """Remember the loaded rows that a later overlap can reach, those from ``since`` on."""
        kind = loaded.schema[column].dataType
        near = loaded.where(F.col(column) >= F.lit(since).cast(kind))
        folder = f"keys-{uuid.uuid4()}"
        entries = near.groupBy(_digest(near).alias("digest"), F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("copies"))
        entries.write.parquet(f"{self.path}/{folder}")
        while not self.commits.commit(self.commits.newest() + 1, {"folder": folder}):
            pass  # another load was first: take the next number


def _digest(rows: DataFrame) -> Column:
    return F.unhex(F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {"ignoreNullFields": "false"}), 256))


def overlap_start(spark: SparkSession, last, overlap: str, kind: DataType):
    """The stored value less the overlap, a number or an interval such as ``interval 1 day``: the least value looked at."""
    stored = F.lit(last).cast(kind)
    if not overlap:
        return last
    return spark.range(1).select((stored - F.expr(overlap)).cast(kind).alias("since")).first()["since"]
