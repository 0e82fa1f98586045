"""Run queries on Spark and their SQL on DuckDB over the same tables and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

from quayside.catalog.registry import TABLES

TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
}


def connect(folder: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(row[i]) for i in order) for row in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """What differs, or None."""
    relation = con.sql(sql)
    left = {n.lower(): t for n, t in spark_df.dtypes}
    right = {n.lower(): str(t) for n, t in zip(relation.columns, relation.types)}
    if list(sorted(spark_df.columns)) != list(sorted(relation.columns)):
        return f"columns {sorted(spark_df.columns)} != {sorted(relation.columns)}"
    types = [f"{n}: {t} != {right[n]}" for n, t in left.items() if TYPES.get(t, t) != right[n]]
    if types:
        return f"types {types}"
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    want = rows_of(relation.columns, relation.fetchall())
    if got != want:
        return (
            f"rows {sum(got.values())} != {sum(want.values())}; "
            f"only spark {list((got - want).items())[:3]}; only sql {list((want - got).items())[:3]}"
        )
    return None


def main() -> None:
    from quayside.catalog import ORACLES, QUERIES
    from quayside.session import build_session

    folder = sys.argv[1]
    names = sys.argv[2:] or list(QUERIES)
    conf = {"sql__shuffle__partitions": "8", "ui__enabled": "false", "ui__showConsoleProgress": "false"}
    spark = build_session("local[8]", **{f"spark__{name}": value for name, value in conf.items()})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names:
        began = time.time()
        try:
            df = QUERIES[name](spark, folder)
            found = difference(df, con, ORACLES[name]) if name in ORACLES else f"NO SQL rows={df.count()}"
        except Exception as error:  # noqa: BLE001
            found = f"ERROR {type(error).__name__} {str(error)[:600]}"
        bad += bool(found) and not found.startswith("NO SQL")
        print(f"{'ok ' if not found else '-- ' if found.startswith('NO SQL') else 'BAD'} {name} {time.time() - began:.1f}s {found or ''}", flush=True)
    print(f"{len(names)} queries, {bad} bad")
    spark.stop()


if __name__ == "__main__":
    main()
