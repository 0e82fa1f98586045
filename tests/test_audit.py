"""Audit records: every profile in every state, against a table written out by hand."""

import datetime as dt

import pytest

from quayside.operators import audit

RUN_TS = dt.datetime(2024, 6, 1, 12, 0, 0, 250000)
NOW = "2024-06-01 12:00:00.250000"
START, END = "2024-01-02 03:04:05.000006", "2024-01-02 03:05:35.000006"
STATES = ("success", "failed", "running", None, "queued")
OUT = "zone/out"

BATCH = {
    "job_start_time": (START, START, START, NOW, None),
    "job_end_time": (END, NOW, "None", None, None),
    "Task_Duration": ("90.0", "None", "None", None, None),
    "source_number_of_records": (12, -1, -1, -1, None),
    "destination_number_of_records": (11, -1, -1, -1, None),
    "destination": (OUT, "None", OUT, None, None),
    "job_id": ("job7", "job7", "job7", "Loading...", None),
}
STREAM = {
    "job_start_time": (START, "None", START, NOW, None),
    "job_end_time": (END, "None", "None", "None", None),
    "Task_Duration": ("90.0", "None", "None", "None", None),
    "source_number_of_records": (-1, -1, -1, -1, None),
    "destination_number_of_records": (-1, -1, -1, -1, None),
    "destination": (OUT, "None", OUT, "None", None),
    "job_id": ("job7", "job7", "job7", "Loading...", None),
}
PLAIN = ("success", "failed", "running", "Starting...", None)
NAMED = ("T_success", "T_failed", "T_running", "T_Starting...", None)
STREAMING = ("success", "failed", "Streaming", "Starting...", None)
EXPECTED = {
    "rdbms_to_warehouse": {**BATCH, "job_status": PLAIN},
    "rdbms_to_files": {
        **BATCH,
        "job_status": NAMED,
        "destination": (OUT, "None", f"{OUT}/outputsrcgrp1de20240102T030000", None, None),
    },
    "files_to_files": {**BATCH, "job_status": NAMED},
    "stream_to_warehouse": {**STREAM, "job_status": STREAMING},
    "stream_to_files": {**STREAM, "job_status": STREAMING},
    "sftp": {**STREAM, "job_status": PLAIN},
    "dq": {
        "job_start_time": (START + "+00:00", START + "+00:00", START + "+00:00", NOW, "0"),
        "job_end_time": (END + "+00:00", END + "+00:00", "None", "0", "0"),
        "Task_Duration": ("90.0", "90.0", "None", "None", "None"),
        "job_id": ("job7", "job7", "job7", "Loading...", "None"),
        "profiling_path": ("p", "None as job got failed", "p", "Loading...", "p"),
        "expectations_ui_path": ("e", "None as job failed", "e", "Loading...", "e"),
        "job_status": ("T_success", "T_failed", "T_running", "T_Running", "T_queued"),
    },
}
FIXED = {
    "rdbms_to_warehouse": ("Dataproc Rdbms to bigquery", "h", "db", "t"),
    "rdbms_to_files": ("Dataproc Rdbms to gcs", "h", "db", "t"),
    "files_to_files": ("Dataproc gcs to gcs", "GCS bucket", "db", ""),
    "stream_to_warehouse": ("Dataproc Pubsub to bigquery", "NA", "NA", "NA"),
    "stream_to_files": ("Dataproc Pubsub to gcs", "NA", "NA", "NA"),
    "sftp": ("Dataproc sftp_to_gcs", "h", "NA", "NA"),
}
WIDTH = {"rdbms_to_warehouse": 21, "stream_to_warehouse": 21, "stream_to_files": 21, "dq": 18}


@pytest.fixture(scope="module")
def runs(spark):
    rows = [
        (at, s, "2024-01-02 03:00:00", START + "+00:00", END + "+00:00" if s in ("success", "failed") else None)
        for at, s in enumerate(STATES)
    ]
    return spark.createDataFrame(
        rows, "at int, state string, execution_date string, start_date string, end_date string"
    ).selectExpr("*", "'dag' dag_id", "'src' source_name", "2 try_number")


CONSTANTS = dict(
    asset_id="a1", task_name="T_", task_type="sftp_to_gcs", job_type="Dataproc", group_name="grp1DE", host="h",
    database="db", table_name="t", destination=OUT, source_count=12, destination_count=11, job_id="job7",
    project="proj", source="s", source_type="files", profiling_path="p", expectations_path="e",
)


@pytest.mark.parametrize("profile", sorted(EXPECTED))
def test_matrix(runs, profile):
    made = audit.audit_record(runs, profile, RUN_TS, keep=["at"], **CONSTANTS).orderBy("at").collect()
    for name, cells in EXPECTED[profile].items():
        assert tuple(r[name] for r in made) == cells, name
    assert len(made[0]) - 1 == WIDTH.get(profile, 22)
    for r in made:
        assert r["audit_id"] == ("20240102030000dag" if profile == "dq" else "20240102030000dagsrc")
        assert r["log_url"] == "/graph?dag_id=dag&root=&execution_date=2024-01-02%2003%3A00%3A00%2B00%3A00"
        assert (r["ingestion_date"], r["no_of_retries"], r["dag_id"], r["project"]) == ("2024-06-01", 2, "dag", "proj")
        if profile in FIXED:
            got = (r["job_type"], r["host"], r["source_database"], r["source_table"])
            assert got == FIXED[profile]
            assert (r["audit_dataset"], r["audit_table"]) == ("dataset_to_replace", "table_to_replace")
        else:
            assert (r["dataset_id"], r["table_id"]) == ("dqaudit_dataset_replace", "dqaudit_table_replace")


def test_text_none_is_the_absent_state(runs):
    made = audit.audit_record(runs.selectExpr("* except(state)", "'None' state"), "sftp", RUN_TS, **CONSTANTS)
    assert {r["job_status"] for r in made.collect()} == {"Starting..."}


def test_job_id_needs_a_known_job_type(runs):
    for job_type, want in (("DATAFLOW", "job7"), ("dataproc", "job7"), ("cron", "None")):
        made = audit.audit_record(runs, "sftp", RUN_TS, **{**CONSTANTS, "job_type": job_type})
        assert {r["job_id"] for r in made.where("job_status = 'success'").collect()} == {want}


def test_stored_counts(spark):
    records = spark.createDataFrame(
        [(1, 5, 5), (2, -1, -1), (3, None, 5)],
        "at int, source_number_of_records bigint, destination_number_of_records bigint",
    )
    got = [tuple(r) for r in audit.stored_counts(records).orderBy("at").collect()]
    assert got == [(1, 5, 5, "ok"), (2, None, None, "unknown"), (3, None, 5, "error")]


def test_latest_keeps_one_record_for_a_hot_key(spark):
    rows = spark.range(10_000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id)) k", "id as seq", "id % 7 as ts")
    newest = audit.latest_audit(rows, ["k"], ["ts", "seq"])
    hot = newest.where("k = 'hot'").collect()
    assert len(hot) == 1 and (hot[0]["ts"], hot[0]["seq"]) == (6, max(i for i in range(0, 10_000, 3) if i % 7 == 6))
    assert newest.count() == 1 + sum(1 for i in range(10_000) if i % 3)
    assert "Window" not in newest._jdf.queryExecution().executedPlan().toString()


def test_append_is_idempotent_and_null_safe(spark, folder):
    from quayside.sinks.audit_log import append_audit, read_audit

    rows = spark.createDataFrame([("a", None, 1), ("b", "x", 2)], "audit_id string, job_status string, n int")
    for _ in range(3):
        append_audit(rows, f"{folder}/audit", ["audit_id", "job_status"])
    more = spark.createDataFrame([("a", "done", 3)], "audit_id string, job_status string, n int")
    append_audit(more, f"{folder}/audit", ["audit_id", "job_status"])
    assert sorted(r["n"] for r in read_audit(spark, f"{folder}/audit").collect()) == [1, 2, 3]
