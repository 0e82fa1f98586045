"""Whole runs: switches, increments, state, and what is written where."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from quayside.operators.surrogates import SurrogateMap
from quayside.plans.landing import RunConfig, land, verdict
from quayside.plans.stages import stage_plan, stages_for
from quayside.sinks.state import StateTable, mark_processed

RUN_TS = dt.datetime(2024, 6, 1, 12, 0, 0)
KEY = b"test key"
CHECKS = ["expect_column_to_exist('card')", "expect_column_values_to_be_not_null('id')"]


def config(folder, **settings):
    base = {
        "asset_id": "1001",
        "source_path": f"{folder}/raw",
        "landing_zone": f"{folder}/landing",
        "secured_zone": f"{folder}/secured",
        "audit_path": f"{folder}/audit",
        "warehouse_table": f"{folder}/warehouse",
        "suite": CHECKS,
        "template": {"card": "hash"},
    }
    return RunConfig(**{**base, **settings})


def raw(folder, text="id,card,at\n1,4111,2024-01-01\n2,4222,2024-01-02\n3,,2024-01-03\n"):
    os.makedirs(f"{folder}/raw/deep", exist_ok=True)
    with open(f"{folder}/raw/deep/a.csv", "w") as out:
        out.write(text)


FLAGS = [("True", "True"), ("False", "True"), ("True", "False"), ("False", "False"), ("true", "True"), ("True", "")]


def test_stage_choice(spark):
    df = spark.createDataFrame(FLAGS, "t string, q string")
    got = [r["s"] for r in df.select(stage_plan(F.col("t"), F.col("q"), F.lit("9")).alias("s")).collect()]
    token, check, close = "TOKENIZATION_JOB9", "DQ9", "DELETE_DATAPROC_CLUSTER"
    assert got == [[token, check, close], [check, close], [token, close], [close], [close], [close]]
    assert [stages_for(*f) for f in FLAGS] == [(token in s, check in s) for s in got]


@pytest.mark.parametrize("tokenize, check", FLAGS[:4])
def test_switches(spark, folder, tokenize, check):
    raw(folder)
    settings = config(folder, tokenization_check=tokenize, data_quality_check=check, dw_load_ind="False")
    report = land(spark, settings, RUN_TS, KEY)
    assert (report.secured is not None) == (tokenize == "True") == os.path.exists(f"{folder}/secured")
    assert (report.quality is not None) == (check == "True")
    assert not os.path.exists(f"{folder}/warehouse")
    assert report.counts.match and report.counts.source_records == 3
    assert report.audit.count() == (2 if check == "True" else 1)
    assert report.landing == f"{folder}/landing/dataproc/1001_20240601T120000"


def test_checks_read_the_protected_copy(spark, folder):
    raw(folder)
    suite = ["expect_column_value_lengths_to_equal('card', 64)"]
    on = config(folder, tokenization_check="True", data_quality_check="True", suite=suite)
    assert land(spark, on, RUN_TS, KEY).quality.first()["success"] is True
    off = config(folder, data_quality_check="True", suite=suite)
    assert land(spark, off, RUN_TS, KEY).quality.first()["success"] is False


def test_rerun_replaces_files_and_adds_no_record(spark, folder):
    raw(folder)
    settings = config(folder, data_quality_check="True")
    for _ in range(2):
        report = land(spark, settings, RUN_TS, KEY)
    assert report.counts.destination_records == 3
    assert spark.read.parquet(f"{folder}/audit").count() == 2
    assert verdict(report).first()["passed"] == 2


def test_increments_and_watermark(spark, folder):
    raw(folder)
    settings = config(folder, schema="id int, card string, at date", incremental_column="at", incremental_column_value="2024-01-01")
    report = land(spark, settings, RUN_TS)
    assert report.counts.source_records == report.counts.destination_records == 2
    assert report.watermark.first()[0] == dt.date(2024, 1, 3)


def test_watermark_is_stored_for_the_next_load(spark, folder):
    raw(folder)
    state = StateTable(spark, f"{folder}/state")
    columns = "asset_id string, is_processed string, incremental_column_value string"
    state.replace(spark.createDataFrame([("1001", "false", "2024-01-01"), ("1002", "true", "x")], columns))
    settings = config(
        folder,
        schema="id int, card string, at date",
        incremental_column="at",
        incremental_column_value="2024-01-01",
        state_path=f"{folder}/state",
    )
    land(spark, settings, RUN_TS)
    got = sorted(map(tuple, state.read().collect()))
    assert got == [("1001", "Success", "2024-01-03"), ("1002", "true", "x")]


def test_warehouse_copy_carries_the_load_time(spark, folder):
    raw(folder)
    land(spark, config(folder, dw_load_ind="True"), RUN_TS)
    rows = spark.read.parquet(f"{folder}/warehouse")
    assert rows.count() == 3 and {r[0] for r in rows.select("insertion_timestamp").collect()} == {RUN_TS}


def test_quoted_newlines_survive_with_multi_line(spark, folder):
    raw(folder, 'id,card\n1,"a\nb"\n2,c\n')
    report = land(spark, config(folder, multi_line=True, data_quality_check="True"), RUN_TS)
    assert report.counts.match and report.counts.source_records == 2


def test_partitioned_and_parquet_landing(spark, folder):
    raw(folder)
    settings = config(folder, output_format="parquet", column_partition="at", data_quality_check="True")
    report = land(spark, settings, RUN_TS)
    assert report.counts.match and os.path.exists(f"{report.landing}/at=2024-01-02")
    assert verdict(report).first()["passed"] == 2


def test_surrogates_in_a_run(spark, folder):
    raw(folder)
    maps = {"card": SurrogateMap(spark, f"{folder}/map")}
    settings = config(folder, tokenization_check="True", template={"card": "surrogate"}, data_quality_check="True")
    report = land(spark, settings, RUN_TS, surrogates=maps)
    back = spark.read.option("header", True).csv(report.secured)
    assert sorted((r["id"], r["card"]) for r in back.collect()) == [("1", "1"), ("2", "2"), ("3", None)]


def test_asset_is_marked_after_the_counts_agree(spark, folder):
    raw(folder)
    state = StateTable(spark, f"{folder}/state")
    state.replace(spark.createDataFrame([("1001", "false"), ("1002", "false")], "asset_id string, is_processed string"))
    for flag, want in (("true", "false"), ("false", "Success")):
        land(spark, config(folder, state_path=f"{folder}/state", is_processed=flag), RUN_TS)
        got = {r["asset_id"]: r["is_processed"] for r in state.read().collect()}
        assert got == {"1001": want, "1002": "false"}


def test_state_versions(spark, folder):
    state = StateTable(spark, f"{folder}/state")
    with pytest.raises(LookupError):
        state.read()
    rows = spark.createDataFrame(
        [("a", "false"), ("b", "true"), ("c", "Success")], "asset_id string, is_processed string"
    )
    state.replace(rows)
    assert state.update_processed("a", "true") is None and state.version() == 1
    assert state.update_processed("missing", "false")["type"] == "success"
    for _ in range(2):
        assert state.update_processed("a", "false") == {"result": "Task updated successfully", "type": "success"}
    got = sorted((r["asset_id"], r["is_processed"]) for r in state.read().collect())
    assert got == [("a", "Success"), ("b", "true"), ("c", "Success")] and state.version() == 4


def test_busy_asset_does_not_repeat_state_rows(spark):
    state = spark.createDataFrame([("a", "x"), ("b", "y")], "asset_id string, is_processed string")
    runs = spark.range(1000).selectExpr("'a' asset_id", "'false' is_processed")
    assert sorted(map(tuple, mark_processed(state, runs).collect())) == [("a", "Success"), ("b", "y")]


def test_unfinished_version_is_not_read(spark, folder):
    state = StateTable(spark, f"{folder}/state")
    state.replace(spark.createDataFrame([("a", "x")], "asset_id string, is_processed string"))
    spark.range(5).write.parquet(f"{folder}/state/version=2")  # a write whose commit never came
    assert state.read().count() == 1
    state.replace(spark.createDataFrame([("b", "x")], "asset_id string, is_processed string"))
    assert [r["asset_id"] for r in state.read().collect()] == ["b"]
