"""Reconciliation by content: which rows differ between two tables, without moving those that do not.

Each side is summed up in buckets of its keys: how many rows a bucket holds, and sums of two 64-bit hashes
of each row, which do not depend on order and count repeated rows. The sums of buckets add up to those
of coarser ones, so two sides are compared from a root down, and only what differs is looked into. Rows
of buckets that differ are then counted by content on both sides, and what is in excess is told.

Digests are small tables that can be stored with a load and compared later, when the rows are elsewhere.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.session import durable

BITS = 16
STEP = 4
SUMS = ("first_high", "first_low", "second_high", "second_low")
_LOW = (1 << 32) - 1


def _flat(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Columns in a form that hashes tell apart: nested values as JSON, zeros with one sign, and which ones are NULL."""
    out = []
    for name in columns:
        value, kind = F.col(f"`{name}`"), df.schema[name].dataType
        if isinstance(kind, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            value = F.to_json(F.struct(value), {"ignoreNullFields": "false"})
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            value = F.when(value == 0, F.lit(0).cast(kind)).otherwise(value)
        out.append(value)
    # A hash passes over NULL, so (1, NULL) and (NULL, 1) would be one.
    return [*out, F.concat(*[F.when(F.col(f"`{c}`").isNull(), "0").otherwise("1") for c in columns])]


def row_hashes(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Two hashes of a row, ``_first`` and ``_second``."""
    row = _flat(df, columns)
    return [F.xxhash64(*row).alias("_first"), F.xxhash64(F.lit("second"), *row).alias("_second")]


def hash_sums() -> list[Column]:
    """``rows``, and sums of the halves of both hashes, so that two thousand million rows cannot overflow them."""
    halves = [part for h in ("_first", "_second") for part in (F.shiftrightunsigned(h, 32), F.col(h).bitwiseAND(F.lit(_LOW)))]
    return [F.count(F.lit(1)).alias("rows"), *[F.sum(half).alias(name) for half, name in zip(halves, SUMS)]]


def _hashed(df: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """``df`` with ``_bucket`` of its keys and two hashes of the whole row."""
    bucket = F.shiftrightunsigned(F.xxhash64(*_flat(df, keys)), 64 - bits)
    return df.select("*", bucket.alias("_bucket"), *row_hashes(df, df.columns))


def content_digest(df: DataFrame, keys: Sequence[str], bits: int = BITS) -> DataFrame:
    """``bucket``, its ``rows`` and sums, for each of at most ``2 ** bits`` buckets of the keys."""
    return _hashed(df, keys, bits).groupBy(F.col("_bucket").alias("bucket")).agg(*hash_sums())


def differing_buckets(source: DataFrame, destination: DataFrame, bits: int = BITS, step: int = STEP) -> DataFrame:
    """Buckets of two digests that differ, found from the root down: below a node that agrees nothing is compared."""
    open_, above = None, 0
    for depth in [*range(step, bits, step), bits]:

        def sums(digest: DataFrame, side: str, depth: int = depth, above: int = above) -> DataFrame:
            if open_ is not None:
                parent = F.shiftrightunsigned("bucket", bits - above).alias("parent")
                digest = digest.select("*", parent).join(open_.withColumnRenamed("node", "parent"), "parent", "left_semi")
            node = F.shiftrightunsigned("bucket", bits - depth).alias("node")
            added = digest.groupBy(node).agg(*[F.sum(c).alias(c) for c in ("rows", *SUMS)])
            return added.select("node", F.struct("rows", *SUMS).alias(side))

        met = sums(source, "a").join(sums(destination, "b"), "node", "full_outer")
        open_, above = durable(met.where(~F.col("a").eqNullSafe(F.col("b"))).select("node"), "differing"), depth
        if open_.isEmpty():
            break
    return open_.withColumnRenamed("node", "bucket")


def reconcile_content(
    source: DataFrame, destination: DataFrame, keys: Sequence[str], bits: int = BITS, step: int = STEP
) -> DataFrame:
    """Rows that one side has more often than the other: the row, ``side``, ``copies`` in excess, and ``change``.

    ``change`` is ``changed`` where the row's key is in excess on both sides, else ``missing`` (from the
    destination) or ``added`` (to it). NULL keys are keys like others. Both sides have the same columns
    and types; each is read twice, the second time for its rows in buckets that differ.
    """
    if [(f.name, f.dataType) for f in source.schema.fields] != [(f.name, f.dataType) for f in destination.schema.fields]:
        raise ValueError("source and destination have different columns")
    digests = [durable(content_digest(side, keys, bits), "digest") for side in (source, destination)]
    buckets = differing_buckets(*digests, bits, step)

    def rows(side: DataFrame, sign: int) -> DataFrame:
        # At most one row for each bucket; Spark broadcasts it if it is small.
        near = _hashed(side, keys, bits).join(buckets.withColumnRenamed("bucket", "_bucket"), "_bucket", "left_semi")
        return near.select(F.struct(*[F.col(f"`{c}`") for c in side.columns]).alias("row"), "_first", "_second", F.lit(sign).alias("sign"))

    both = rows(source, 1).unionByName(rows(destination, -1))
    excess = both.groupBy("_first", "_second").agg(F.sum("sign").alias("copies"), F.first("row").alias("row")).where("copies <> 0")
    excess = durable(excess.select("row.*", "copies"), "excess")
    key = [F.col(f"`{c}`").alias(f"key_{at}") for at, c in enumerate(keys)]
    sides = excess.groupBy(*key).agg((F.min("copies") * F.max("copies") < 0).alias("both"))
    same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"key_{at}")) for at, c in enumerate(keys)])
    here = F.col("copies") > 0
    return excess.join(sides, same).select(
        *[F.col(f"`{c}`") for c in source.columns],
        F.when(here, "source").otherwise("destination").alias("side"),
        F.abs("copies").alias("copies"),
        F.when(F.col("both"), "changed").when(here, "missing").otherwise("added").alias("change"),
    )
