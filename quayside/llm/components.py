"""Connected components of a table of links, by rounds of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.session import durable, release


def _both_ways(links: DataFrame) -> DataFrame:
    return links.union(links.select("v", "u")).toDF("u", "v")


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Every vertex hangs its larger (or smaller) neighbours under the least one it knows.

    The least neighbour is an aggregate, so no neighbourhood is gathered in one place.
    """
    ways = _both_ways(links) if large else links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = ways.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    met = ways.join(least, "u")
    if large:
        new = met.where(F.col("v") > F.col("u")).select("v", F.col("low").alias("u"))
    else:
        hung = met.select("v", F.col("low").alias("u"))
        new = hung.union(least.select(F.col("u").alias("v"), F.col("low").alias("u")))
    return new.where(F.col("u") != F.col("v")).select("u", "v").distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``v, c``: each linked vertex that is not the least of its component, and that least vertex.

    ``links`` has two columns ``u, v`` of one type. Each round is written to the shared folder, so
    lost executors cost one round at most; the rounds grow with the logarithm of the longest chain.
    """
    now = durable(links.select("u", "v").where(F.col("u") != F.col("v")).distinct(), "links")
    seen = None
    for _ in range(rounds):
        before, now = now, durable(_star(_star(now, True), False), "links")
        release(before)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("v"), F.col("u").alias("c"))
        seen = state
    raise RuntimeError(f"components did not settle in {rounds} rounds")
