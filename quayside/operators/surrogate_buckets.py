"""Surrogate keys for several columns at once, from maps that are bucketed by the digest of the value.

A map keeps digests and numbers, no texts. A value's bucket follows from its digest, and every bucket has
numbers of its own: the k-th value of bucket ``b`` of ``B`` is number ``k * B + b + 1``. So new values are
numbered bucket by bucket, with no order over all of them and no total to share.

All columns of a table go through one exchange of narrow rows (row, column, digest), whatever the length
of the texts and however often a value occurs, and the rows themselves are exchanged once, to meet
their numbers.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayside.operators.values import attach_by_value, value_table
from quayside.session import durable
from quayside.sinks.commits import CommitLog

MAP_SCHEMA = "digest binary, bucket int, surrogate_id bigint"


def digest_of(value: Column) -> Column:
    """SHA-256 of the value's text; NULL stays NULL."""
    return F.unhex(F.sha2(value.cast("string"), 256))


class BucketedMap:
    """Digests known so far and their numbers, in an append-only folder that several writers may share."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 256):
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = buckets
        self.commits = CommitLog(spark, f"{self.path}/_commits")

    def read(self, version: int | None = None) -> DataFrame:
        newest = self.commits.newest() if version is None else version
        folders = [f"{self.path}/{self.commits.body(n)['folder']}" for n in range(1, newest + 1)]
        if not folders:
            return self.spark.createDataFrame([], MAP_SCHEMA)
        return self.spark.read.schema(MAP_SCHEMA).parquet(*folders)

    def _bucket(self, digest: Column) -> Column:
        return F.pmod(F.conv(F.substring(F.hex(digest), 1, 8), 16, 10).cast("long"), F.lit(self.buckets)).cast("int")

    def extend(self, digests: DataFrame) -> DataFrame:
        """Number the digests that are new; gives the known map, with them in it.

        ``digests`` has each digest once. Where another writer commits first, its numbers stand and
        only what is new beside them is numbered.
        """
        named = digests.select("digest", self._bucket(F.col("digest")).alias("bucket"))
        while True:
            version = self.commits.newest()
            known = self.read(version)
            # One row for each bucket.
            taken = known.groupBy("bucket").agg(F.count(F.lit(1)).alias("taken"))
            fresh = named.join(known.select("digest"), "digest", "left_anti").join(F.broadcast(taken), "bucket", "left")
            place = F.row_number().over(W.partitionBy("bucket").orderBy("digest")) - 1 + F.coalesce("taken", F.lit(0))
            numbered = fresh.select("digest", "bucket", (place * self.buckets + F.col("bucket") + 1).cast("long").alias("surrogate_id"))
            folder = f"part-{uuid.uuid4()}"
            numbered.write.parquet(f"{self.path}/{folder}")
            if self.commits.commit(version + 1, {"folder": folder, "buckets": self.buckets}):
                return self.read(version + 1)


def attach_surrogates(df: DataFrame, maps: Mapping[str, BucketedMap]) -> DataFrame:
    """``df`` with the columns that ``maps`` names replaced by their surrogates; NULL stays NULL.

    Columns that share a map share its numbers.
    """
    columns = list(maps)
    places = {path: at for at, path in enumerate(dict.fromkeys(m.path for m in maps.values()))}
    row = "_row"
    while row.lower() in {c.lower() for c in df.columns}:
        row = f"_{row}"
    # Row numbers must be the same wherever the rows are read.
    stored = durable(df.withColumn(row, F.monotonically_increasing_id()), "rows")
    key = lambda c: F.concat(F.lit(bytes([places[maps[c].path]])), digest_of(F.col(f"`{c}`")))
    cells = F.array(*[F.struct(F.lit(at).alias("at"), key(c).alias("key")) for at, c in enumerate(columns)])
    narrow = stored.select(row, F.inline(cells)).where(F.col("key").isNotNull())
    counted = durable(narrow.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "digests")
    tables = []
    for m in {m.path: m for m in maps.values()}.values():
        mark = F.lit(bytes([places[m.path]]))
        own = counted.where(F.substring("key", 1, 1) == mark)
        numbers = m.extend(own.select(F.expr("substring(key, 2)").alias("digest")))
        tables.append(own.join(numbers.select(F.concat(mark, F.col("digest")).alias("key"), "surrogate_id"), "key"))
    table = value_table(reduce(DataFrame.unionByName, tables).select(F.col("key").alias("value"), "n", "surrogate_id"))
    found = attach_by_value(narrow, F.col("key"), table, "surrogate_id")
    one = found.groupBy(row).agg(
        *[F.max(F.when(F.col("at") == at, F.col("surrogate_id"))).alias(f"{row}{at}") for at, _ in enumerate(columns)]
    )
    joined = stored.join(one, row, "left")
    return joined.select(*[F.col(f"{row}{columns.index(c)}").alias(c) if c in maps else F.col(f"`{c}`") for c in df.columns])
