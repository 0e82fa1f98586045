"""Paths, scalars and relational reader options."""

import pytest
from pyspark.sql import functions as F

from quayside.functions import paths, scalars
from quayside.sources import jdbc


def ask(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "path, bucket, prefix, parent",
    [
        ("store://b/x/y", "b", "x/y/", "store://b/x"),
        ("store://b/x", "b", "x/", "store://b"),
        ("store://b", "b", "", "store:/"),
        ("store://b/b/x", "b", "b/x/", "store://b/b"),
        ("plain", None, "", "plain"),
    ],
)
def test_paths(spark, path, bucket, prefix, parent):
    col = F.lit(path)
    assert ask(spark, paths.path_bucket(col)) == bucket
    assert ask(spark, paths.path_prefix(col)) == prefix
    assert ask(spark, paths.path_parent(col)) == parent == paths.parent_of(path)


def test_folders(spark):
    when = F.lit("2024-01-02 03:04:05").cast("timestamp_ntz")
    landing = paths.landing_folder("store://land", "7", when)
    assert ask(spark, landing) == "store://land/dataproc/7_20240102T030405"
    assert ask(spark, paths.item_folder("z", "src", "Grp1DE", when)) == "z/dataproc/srcgrp1de20240102T030405/"
    secured = "store://safe/dlp_output/dataproc/7_20240102T030405"
    assert ask(spark, paths.secured_folder(landing, "store://land", "store://safe")) == secured
    assert ask(spark, paths.secured_folder(landing, "store://else", "store://safe")) is None
    for flag, want in (("True", f"{secured}/*.csv"), ("true", "store://land/dataproc/7_20240102T030405/*.csv")):
        assert ask(spark, paths.quality_source(F.lit(flag), landing, "store://land", "store://safe")) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("2024-01-02 03:04:05.000006+00:00", "2024-01-02 03:04:05.000006"),
        ("2024-01-02 03:04:05+05:30", "2024-01-02 03:04:05"),
        ("2024-01-02 03:04:05.5", "2024-01-02 03:04:05.500000"),
        ("soon", None),
    ],
)
def test_task_times(spark, text, want):
    assert ask(spark, scalars.ts_text(scalars.parse_task_ts(F.lit(text)))) == want


@pytest.mark.parametrize("seconds, text", [(90.0, "90.0"), (0.000001, "0.000001"), (12345678.5, "12345678.5"), (0.0, "0.0")])
def test_seconds(spark, seconds, text):
    assert ask(spark, scalars.seconds_text(F.lit(seconds))) == text


def test_small_ones(spark):
    assert ask(spark, scalars.driver_kind(F.lit("org.postgresql.Driver"))) == "postgresql"
    assert ask(spark, scalars.driver_kind(F.lit("oracle"))) is None
    assert ask(spark, scalars.to_int(F.lit("5432"))) == 5432 and ask(spark, scalars.to_int(F.lit("x"))) is None
    assert ask(spark, scalars.url_quote(F.lit("a b+c:d"))) == "a%20b%2Bc%3Ad"
    assert ask(spark, scalars.json_field(F.lit('{"password": "p"}'), "$.password")) == "p"
    assert ask(spark, scalars.lower_group(F.lit("Grp1DE"))) == "grp1de"


def test_jdbc_options():
    plain = jdbc.jdbc_options("jdbc:x", "select 1", "postgresql", "u", "p")
    assert plain["query"] == "select 1" and plain["driver"] == "org.postgresql.Driver"
    split = jdbc.jdbc_options("jdbc:x", "select 1", "mysql", "u", "p", jdbc.Split("id", "0", "100", 8))
    assert split["dbtable"] == "(select 1) a" and "query" not in split and split["numPartitions"] == "8"
    assert jdbc.jdbc_url("postgresql", "h", "5432", "d") == "jdbc:postgresql://h:5432/d"
    assert jdbc.count_text("select 1") == "select count(*) as records from (select 1) a"
    with pytest.raises(ValueError, match="oracle"):
        jdbc.family("oracle")
