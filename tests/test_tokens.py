"""Tokens, templates and surrogate keys."""

import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from quayside.functions import tokens
from quayside.operators.surrogates import SurrogateMap
from quayside.operators.tokenize import apply_row_template, apply_template
from quayside.operators.values import attach_by_value, number_values, value_table

KEY, OTHER = b"one key", b"x" * 100
VALUES = ["a", "b", "a", None, "", "ünï", "long " * 50]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(list(enumerate(VALUES)), "id int, v string")


def column(df, name="t"):
    return [r[name] for r in df.orderBy("id").collect()]


@pytest.mark.parametrize("key", [KEY, OTHER])
def test_hmac_is_the_standard_one(rows, key):
    got = column(rows.select("id", tokens.hmac_token(F.col("v"), key).alias("t")))
    assert got == [None if v is None else hmac.new(key, v.encode(), hashlib.sha256).hexdigest() for v in VALUES]


def test_sealed_tokens_open_only_with_their_key(rows):
    sealed = rows.withColumn("t", tokens.seal_token(F.col("v"), KEY))
    got = column(sealed)
    assert [t is None for t in got] == [v is None for v in VALUES]
    assert got[0] == got[2] and len(set(got)) == len(set(VALUES))
    assert column(sealed.withColumn("t", tokens.open_token(F.col("t"), KEY))) == VALUES
    assert set(column(sealed.withColumn("t", tokens.open_token(F.col("t"), OTHER)))) == {None}
    assert got != column(rows.withColumn("t", tokens.seal_token(F.col("v"), OTHER)))


def test_long_values_show_no_equal_blocks(spark):
    df = spark.range(1).select("id", tokens.seal_token(F.lit("0123456789abcdef" * 4), KEY).alias("t"))
    import base64

    body = base64.b64decode(df.first()["t"])[12:-16]
    blocks = [body[i : i + 16] for i in range(0, len(body), 16)]
    assert len(set(blocks)) == len(blocks) == 4


def test_mask_and_redact(rows):
    assert column(rows.select("id", tokens.mask(F.col("v"), 2).alias("t")))[:6] == ["a", "b", "a", None, "", "*nï"]
    assert column(rows.select("id", tokens.redact(F.col("v")).alias("t")))[3] is None


def test_key_comes_from_the_session(spark, monkeypatch):
    monkeypatch.delenv(tokens.KEY_ENV, raising=False)
    with pytest.raises(ValueError, match="no token key"):
        tokens.token_key(spark)
    monkeypatch.setenv(tokens.KEY_ENV, "00ff")
    assert tokens.token_key(spark) == b"\x00\xff"


def test_key_does_not_show_in_plans(rows, capsys):
    inner, outer = tokens.hmac_pads(KEY)
    cipher = tokens.derive_key(KEY, "cipher")
    rows.select(tokens.hmac_token(F.col("v"), KEY), tokens.seal_token(F.col("v"), KEY)).explain("extended")
    shown = capsys.readouterr().out.lower()
    for secret in (inner, outer, cipher):
        assert secret.hex()[:32] not in shown
    assert "redacted" in shown


def test_template_keeps_columns_and_rejects_mistakes(rows):
    out = apply_row_template(rows.withColumn("w", F.col("v")), {"v": "hash"}, KEY)
    assert out.columns == ["id", "v", "w"] and column(out, "w") == VALUES
    with pytest.raises(ValueError, match="lacks: nope"):
        apply_row_template(rows, {"nope": "hash"}, KEY)
    with pytest.raises(ValueError, match="not one of"):
        apply_row_template(rows, {"v": "rot13"}, KEY)
    with pytest.raises(ValueError, match="needs a key"):
        apply_row_template(rows, {"v": "hash"})
    with pytest.raises(ValueError, match="surrogate map"):
        apply_template(rows, {"v": "surrogate"})


def test_surrogates_stay_and_grow(spark, folder):
    known = SurrogateMap(spark, f"{folder}/map")
    first = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "b")], "id int, v string")
    assert column(known.attach(first, "v", "t")) == [2, 1, None, 2]
    second = spark.createDataFrame([(1, "a"), (2, "0"), (3, "c"), (4, "b")], "id int, v string")
    assert column(known.attach(second, "v", "t")) == [1, 3, 4, 2]
    assert column(known.attach(second, "v", "t")) == [1, 3, 4, 2]
    assert known.read().count() == 4


def test_numbering_over_many_partitions(spark):
    values = spark.range(5000).selectExpr("sha2(cast(id as string), 256) v").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["v"]: r["at"] for r in number_values(values, "v", "at").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {v: n for n, v in enumerate(sorted(got), 1)} and len(got) == 5000


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_lookup_with_hot_and_missing_values(spark, broadcast):
    facts = spark.range(30_000).selectExpr(
        "id",
        "case when id % 3 = 0 then 'hot' when id % 3 = 1 then null when id % 11 = 0 then '' "
        "when id % 13 = 0 then 'gone' else concat('k', id % 4000) end v",
    )
    counted = facts.where("v is not null and v <> 'gone'").groupBy("v").count().selectExpr("v value", "count n")
    table = value_table(counted.withColumn("size", F.length("value")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        joined = attach_by_value(facts, F.col("v"), table, "size")
        assert joined.columns == ["id", "v", "size"]
        want = F.when(F.col("v").isNotNull() & (F.col("v") != "gone"), F.length("v"))
        assert joined.count() == 30_000 == joined.select("id").distinct().count()
        assert joined.where(~F.col("size").eqNullSafe(want)).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_copies_of_one_row_are_spread_too(spark):
    facts = spark.range(0, 40_000, 1, 64).selectExpr("'hot' v")
    table = value_table(spark.sql("select 'hot' value, 40000L n, 1 size"))
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = attach_by_value(facts, F.col("v"), table, "size")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert joined.where("size = 1").count() == 40_000 == sum(sizes)
        assert len(sizes) == 8 and max(sizes) < 40_000 / 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_hot_rows_are_spread_over_tasks(spark):
    """Two thirds of the rows share one value or have none: the sorted join still gets even tasks."""
    facts = spark.range(40_000).selectExpr("id", "case when id % 3 < 2 then 'hot' else concat('k', id) end v")
    facts = facts.withColumn("v", F.when(F.col("id") % 5 != 0, F.col("v")))
    counted = facts.where("v is not null").groupBy("v").count().selectExpr("v value", "count n", "1 size")
    table = value_table(counted)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = attach_by_value(facts, F.col("v"), table, "size")
        assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 40_000 and max(sizes) < 2 * 40_000 / len(sizes)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", old)
