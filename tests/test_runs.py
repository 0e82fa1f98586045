"""Runs: what they refuse, count, resume and remember."""

import csv
import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from quayside.operators.counts import csv_quoted_counts
from quayside.operators.incremental import KeyLedger, increment_counts
from quayside.plans import landing
from quayside.plans.landing import land
from quayside.sinks.audit_log import read_audit
from quayside.sinks.files import NULL_MARK, read_options, sink_csv
from quayside.sinks.state import StateTable
from tests.test_landing import config, raw

RUN_TS = dt.datetime(2024, 6, 1, 12, 0, 0)


@pytest.mark.parametrize("block", ["48", "300", "1000000"])
def test_quoted_counts_over_split_files(spark, folder, block):
    rng, want = random.Random(5), {}
    for k in range(5):
        records = rng.randrange(0, 200) if k else 0
        with open(f"{folder}/f{k}.csv", "w", newline="") as out:
            writer = csv.writer(out, lineterminator="\n")
            writer.writerow(["a", "b"])
            for i in range(records):
                writer.writerow([i, "".join(rng.choice('ab\n" ,') for _ in range(rng.randrange(1, 40)))])
                if rng.random() < 0.1:
                    out.write("  \n")  # an empty line between records
        want[f"f{k}.csv"] = records
    open(f"{folder}/none.csv", "w").close()
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(name) for name in names]
    try:
        spark.conf.set(names[0], block), spark.conf.set(names[1], "1")
        got = {r["file_path"].split("/")[-1]: r["records"] for r in csv_quoted_counts(spark, folder, escape='"').collect()}
    finally:
        for name, value in zip(names, old):
            spark.conf.set(name, value)
    assert got == want


def test_quotes_that_are_escaped_or_never_closed(spark, folder):
    with open(f"{folder}/a.csv", "w") as out:
        out.write('a\n"x \\" y\nz"\n"\\\\"\nopen "\nrest\n')
    assert csv_quoted_counts(spark, folder).first()["records"] == 3


def test_quotes_inside_unquoted_values(spark, folder):
    with open(f"{folder}/a.csv", "w") as out:
        out.write('a,b\n5" pipe,x\n1,"6"" pipe\nsecond line"\nit"s,"""quoted"" start"\n2,""\n"",3\n"end\n","\n,x"\n')
    assert csv_quoted_counts(spark, folder).first()["records"] == 6
    assert spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(folder).count() == 6


def test_no_window_sees_lines(spark, folder):
    """Lines are packed before anything is shuffled: rows that leave the scan's tasks are cells."""
    sink_csv(spark.range(20_000).withColumn("t", F.lit("x")).coalesce(1), folder)
    counts = csv_quoted_counts(spark, folder)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") == 2 and "partial_sum" in plan and "Python" not in plan
    assert counts.first()["records"] == 20_000


def test_a_run_without_a_schema_keeps_what_does_not_fit(spark, folder):
    raw(folder, 'id,card\n1,x\n2,"a\nb"\n3,y,extra\n')
    report = land(spark, config(folder), RUN_TS)
    assert not report.counts.match and report.source_lines == 3 and report.rejected == 2
    assert sorted(r[0] for r in spark.read.text(f"{report.landing}_rejected").collect()) == ["3,y,extra", 'b"']
    assert [r["job_status"] for r in read_audit(spark, f"{folder}/audit").collect()] == ["Ingestion_failed"]


def test_values_that_zones_used_to_change(spark, folder):
    values = ["\u0001", "x\ry", "\r", "", None, " a ", '"', "a,b"]
    rows = spark.createDataFrame(list(enumerate(values)), "id int, v string")
    back = spark.read.schema(rows.schema).options(**read_options("csv")).csv(sink_csv(rows, f"{folder}/zone"))
    assert [r["v"] for r in back.orderBy("id").collect()] == values
    with pytest.raises(Exception, match="null mark"):
        sink_csv(spark.createDataFrame([(NULL_MARK,)], "v string"), f"{folder}/marked")


def test_a_cut_off_run_goes_on_where_it_stopped(spark, folder, monkeypatch):
    raw(folder)
    settings = config(folder, data_quality_check="True", dw_load_ind="True", record_states=True)
    monkeypatch.setattr(landing, "_reports", lambda *a: 1 / 0)
    for _ in range(2):
        with pytest.raises(ZeroDivisionError):
            land(spark, settings, RUN_TS)
    assert not os.path.exists(f"{folder}/warehouse")
    monkeypatch.undo()
    parses = []
    parse = landing._parse
    monkeypatch.setattr(landing, "_parse", lambda *a: parses.append(1) or parse(*a))
    report = land(spark, settings, RUN_TS)
    assert report.counts.match and report.resumed and report.attempt == 3 and parses == []
    assert report.quality.count() == 2 and spark.read.parquet(f"{folder}/warehouse").count() == 3
    told = [(r["no_of_retries"], r["job_status"]) for r in read_audit(spark, f"{folder}/audit").collect()]
    states = [(n, s) for n in (1, 2, 3) for s in ("Ingestion_Starting...", "Ingestion_running")]
    assert sorted(told) == sorted(
        [*states, (1, "Ingestion_failed"), (2, "Ingestion_failed"), (3, "Ingestion_success"), (3, "Data_Quality_success")]
    )
    again = land(spark, settings, RUN_TS)
    assert again.attempt == 3 and again.counts == report.counts and read_audit(spark, f"{folder}/audit").count() == len(told)


def test_nothing_is_loaded_before_counts_agree(spark, folder):
    raw(folder, 'id,card,at\n1,x,2024-01-01\n2,y\n')
    report = land(spark, config(folder, dw_load_ind="True"), RUN_TS)
    assert not report.counts.match and not os.path.exists(f"{folder}/warehouse")


def test_missing_sources_leave_one_record_for_each_attempt(spark, folder):
    for _ in range(2):
        with pytest.raises(Exception):  # noqa: B017
            land(spark, config(folder), RUN_TS)
    assert sorted(r["no_of_retries"] for r in read_audit(spark, f"{folder}/audit").collect()) == [1, 2]


LOADS = [
    "id,at\n1,2024-01-01\n2,2024-01-05\n2,2024-01-05\n9,\n",
    # A tie with the stored value, a late row within two days, one that is too late, one more copy, a new row.
    "id,at\n1,2024-01-01\n2,2024-01-05\n2,2024-01-05\n2,2024-01-05\n3,2024-01-05\n4,2024-01-04\n5,2024-01-02\n6,2024-01-06\n9,\n",
    "id,at\n6,2024-01-06\n7,2024-01-06\n",
]


def test_ties_and_late_rows_are_loaded_once(spark, folder):
    state = StateTable(spark, f"{folder}/state")
    state.replace(spark.createDataFrame([("1001", "false", None)], "asset_id string, is_processed string, incremental_column_value string"))
    skipped = []
    for hour, text in enumerate(LOADS):
        raw(folder, text)
        settings = config(
            folder, schema="id int, at date", incremental_column="at", incremental_overlap="interval 2 days",
            state_path=f"{folder}/state", ledger_path=f"{folder}/ledger", dw_load_ind="True",
        )
        skipped.append(dict(land(spark, settings, RUN_TS.replace(hour=hour)).skipped))
    got = sorted((r["id"], r["insertion_timestamp"].hour) for r in spark.read.parquet(f"{folder}/warehouse").collect())
    assert got == [(1, 0), (2, 0), (2, 0), (2, 1), (3, 1), (4, 1), (6, 1), (7, 2)]
    assert skipped == [{"none": 1}, {"none": 1, "tied": 4, "old": 3, "late": 3}, {"tied": 2, "late": 1}]


def test_increment_counts_and_an_empty_ledger(spark, folder):
    rows = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "v int")
    assert tuple(increment_counts(rows, "v", 2).first()) == (1, 2, 1, 1)
    ledger = KeyLedger(spark, f"{folder}/ledger")
    assert ledger.unseen(rows.where("v >= 2"), "v", 2).count() == 3
    ledger.record(rows.where("v is not null"), "v", 2)
    assert ledger.unseen(rows.where("v >= 2"), "v", 2).count() == 0
    more = spark.createDataFrame([(2,), (2,), (2,), (4,)], "v int")
    assert sorted(r["v"] for r in ledger.unseen(more, "v", 2).collect()) == [2, 4]
