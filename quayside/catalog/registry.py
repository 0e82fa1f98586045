"""The list of queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables of one folder, read when they are asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """A query text in which ``{name}`` stands for a table."""
        return self.spark.sql(text, **{name: getattr(self, name) for name in TABLES if f"{{{name}}}" in text})


def for_oracle(text: str) -> str:
    """The same text with plain table names."""
    for name in TABLES:
        text = text.replace(f"{{{name}}}", name)
    return text


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, tables)`` under a name, with the SQL that gives the same rows."""

    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, Tables(spark, folder))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = for_oracle(sql)
        return fn

    return register
