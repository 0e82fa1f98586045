"""Relational sources through Spark's JDBC reader.

The driver jar and the login are the caller's. The query runs at the source; big reads are split
over a numeric or time column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Part of the driver name -> URL scheme and driver class.
FAMILIES = {
    "postgre": ("postgresql", "org.postgresql.Driver"),
    "mysql": ("mysql", "com.mysql.cj.jdbc.Driver"),
}


@dataclass(frozen=True)
class Split:
    """How a read is cut into parallel queries."""

    column: str
    lower: str
    upper: str
    parts: int


def family(driver_name: str) -> tuple[str, str]:
    for part, found in FAMILIES.items():
        if part in driver_name:
            return found
    raise ValueError(f"no relational source for driver {driver_name!r}")


def jdbc_url(driver_name: str, host: str, port: int | str, database: str) -> str:
    return f"jdbc:{family(driver_name)[0]}://{host}:{int(port)}/{database}"


def count_text(query: str) -> str:
    """The query that counts another query's rows at its source."""
    return f"select count(*) as records from ({query}) a"


def jdbc_options(
    url: str, query: str, driver_name: str, user: str, password: str, split: Split | None = None
) -> dict[str, str]:
    """Reader options; a split read names the query as a derived table, as Spark asks for."""
    options = {"url": url, "user": user, "password": password, "driver": family(driver_name)[1]}
    if split is None:
        return {**options, "query": query}
    return {
        **options,
        "dbtable": f"({query}) a",
        "partitionColumn": split.column,
        "lowerBound": split.lower,
        "upperBound": split.upper,
        "numPartitions": str(split.parts),
    }


def scan_jdbc_query(
    spark: SparkSession,
    url: str,
    query: str,
    driver_name: str,
    user: str,
    password: str,
    split: Split | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    options = jdbc_options(url, query, driver_name, user, password, split)
    return spark.read.format("jdbc").options(**options).option("fetchsize", fetch_size).load()


def count_jdbc_query(
    spark: SparkSession, url: str, query: str, driver_name: str, user: str, password: str
) -> DataFrame:
    """The number of rows of a query, counted by the source: one row, ``records``."""
    return scan_jdbc_query(spark, url, count_text(query), driver_name, user, password)
