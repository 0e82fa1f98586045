"""Values that formats, suites and reports used to lose or to stumble over."""

import datetime as dt
import json

import pytest

from quayside.operators.audit import audit_record
from quayside.operators.profile import profile_columns, profile_histogram
from quayside.operators.quality import run_suite, time_pattern
from quayside.operators.suites import read_suite
from quayside.plans.landing import RunConfig, land
from quayside.sinks.audit_log import append_audit, read_audit
from quayside.sources.files import scan_csv

RUN_TS = dt.datetime(2024, 6, 1, 12, 0, 0)


def settings(folder, **more):
    return RunConfig(
        asset_id="7",
        source_path=f"{folder}/raw",
        landing_zone=f"{folder}/landing",
        secured_zone=f"{folder}/secured",
        audit_path=f"{folder}/audit",
        **more,
    )


def raw(folder, text):
    import os

    os.makedirs(f"{folder}/raw", exist_ok=True)
    with open(f"{folder}/raw/a.csv", "w") as out:
        out.write(text)


def test_literal_runs_of_time_formats_are_quoted(spark):
    assert time_pattern("[%Y]") == "'['yyyy']'" and time_pattern("#%Y") == "'#'yyyy" and time_pattern("it's %d") == "'it''s 'dd"
    rows = spark.createDataFrame([("[2024]",), ("2024",), ("",)], "s string")
    assert run_suite(rows, ["expect_match_strftime_format('s', '[%Y]')"]).first()["unexpected_count"] == 2


def test_suites_that_hold_lists_and_nested_checks():
    suite = {"calls": ["expect_column_to_exist('a')"], "column_max_to_be_between": {"columns": ["b", [1, 2]]}, "odd": 3}
    got = [(e.name, e.column, e.error is not None) for e in read_suite(json.dumps(suite))]
    assert got == [("expect_column_to_exist", "a", False), ("expect_column_max_to_be_between", "b", False), ("odd", None, True)]


def test_entries_that_are_no_columns_give_a_row(spark):
    suite = {"column_max_to_be_between": {"columns": ["b", [1, 2], [3, 4], 5]}}
    got = read_suite(json.dumps(suite))
    assert [(e.column, e.error is not None) for e in got] == [("b", False), (None, True), (None, True)]
    failed = run_suite(spark.sql("select 1 as b"), json.dumps(suite)).collect()
    assert [r["success"] for r in failed].count(False) == 2


def test_dates_within_text_bounds(spark):
    rows = spark.sql("select date '2024-01-02' as d")
    assert run_suite(rows, ["expect_column_max_to_be_between('d', '2024-01-01', '2024-02-01')"]).first()["success"] is True


def test_profiles_of_odd_values(spark):
    rows = spark.sql("select * from values (1.0d, map('a', 1)), (2.0d, null), (double('NaN'), null), (double('Infinity'), null) as t(x, m)")
    got = {r["column_name"]: r for r in profile_columns(rows).collect()}
    assert got["m"]["min_value"] is None and got["m"]["null_count"] == 3
    bins = {r["bin"]: r["records"] for r in profile_histogram(rows, "x", 2).collect()}
    assert bins == {-1: 2, 0: 1, 1: 1}


def test_audit_records_of_checks_and_doubles(spark, folder):
    run = spark.sql(
        "select 'd' as dag_id, 's' as source_name, 'success' as state, timestamp_ntz '2024-06-01 12:00:00' as execution_date, "
        "timestamp_ntz '2024-06-01 12:00:00' as start_date, timestamp_ntz '2024-06-01 12:00:00' as end_date, 1 as try_number"
    )
    record = audit_record(run, "dq", RUN_TS, task_name="Data_Quality_", asset_id="7")
    append_audit(record.union(record), f"{folder}/audit")
    append_audit(record, f"{folder}/audit")
    assert read_audit(spark, f"{folder}/audit").count() == 1


def test_lines_that_do_not_fit_are_kept_and_no_match(spark, folder):
    raw(folder, 'id,a,at\n1,x,2024-01-01\nxx,a,notadate\n2,"b\nc",2024-01-02\n3,  y  ,2024-01-03\n')
    config = settings(folder, schema="id int, a string, at date")
    report = land(spark, config, RUN_TS)
    assert not report.counts.match and report.rejected == 3 and report.counts.destination_records == 2
    assert spark.read.text(f"{report.landing}_rejected").count() == 3
    assert spark.read.option("header", True).csv(report.landing).where("id = 3").first()["a"] == "  y  "
    assert read_audit(spark, config.audit_path).first()["job_status"] == "Ingestion_failed"


def test_a_failed_run_leaves_a_record(spark, folder):
    raw(folder, "id,a\n1,x\n")
    config = settings(folder, tokenization_check="True", template={"absent": "hash"})
    with pytest.raises(Exception):  # noqa: B017
        land(spark, config, RUN_TS, b"key")
    assert [r["job_status"] for r in read_audit(spark, config.audit_path).collect()] == ["Ingestion_failed"]


def test_a_repeat_over_a_changed_source_replaces_partitions(spark, folder):
    schema = "id int, a string"
    for text in ("id,a\n1,x\n2,y\n", "id,a\n1,x\n"):
        raw(folder, text)
        config = settings(folder, schema=schema, column_partition="a", dw_load_ind="True", warehouse_table=f"{folder}/w")
        report = land(spark, config, RUN_TS)
    assert report.counts.match and report.counts.destination_records == 1
    assert spark.read.parquet(f"{folder}/w").count() == 1
    counts = sorted(r["source_number_of_records"] for r in read_audit(spark, config.audit_path).collect())
    assert counts == [1, 2]


def test_a_schema_is_left_as_it_was(spark, folder):
    raw(folder, "id\n1\n")
    schema = spark.createDataFrame([], "id int").schema
    scan_csv(spark, f"{folder}/raw", schema, keep_corrupt=True).collect()
    assert schema.names == ["id"]
