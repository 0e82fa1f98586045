"""Audit records of every profile, and what is asked of the audit table."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.catalog.fixtures import RUN_TIME, TASK_RUNS
from quayside.catalog.function_queries import text_of
from quayside.catalog.registry import query
from quayside.operators.audit import (
    PROFILES,
    audit_record,
    audit_summary,
    latest_audit,
    stored_counts,
    union_audit,
)
from quayside.session import run_folder
from quayside.sinks.audit_log import AuditLog, append_audit, read_audit

NOW = text_of(f"timestamp '{RUN_TIME}'")
START, END = text_of("start_date"), text_of("end_date")
LOG_URL = f"'/graph?dag_id=' || dag_id || '&root=&execution_date=' || url_encode({text_of('execution_date')} || '+00:00')"
SECONDS = "cast((epoch_us(end_date) - epoch_us(start_date)) / 1e6 as varchar)"
STAMP = "strftime(execution_date, '%Y%m%d%H%M%S')"


def _by_state(success: str, failed: str, running: str, absent: str) -> str:
    return (
        f"case when state = 'success' then {success} when state = 'failed' then {failed} "
        f"when state = 'running' then {running} when state is null then {absent} end"
    )


JOB_ID = (
    "case when state is null then 'Loading...' when lower(job_type) in ('dataproc', 'dataflow') "
    "then coalesce(job_id, 'None') else 'None' end"
)
TAIL = f"""try_number as no_of_retries, {LOG_URL} as log_url, '2024-06-01' as ingestion_date, dag_id,
  'dataset_to_replace' as audit_dataset, 'table_to_replace' as audit_table, project"""


def _batch_sql(kind: str, host: str, table: str, running_destination: str, task: str, asset: str) -> str:
    return f"""
    select {STAMP} || dag_id || source_name as audit_id, {asset} group_name, {JOB_ID} as job_id,
      job_type || ' {kind}' as job_type, {host} as host, database as source_database, {table} as source_table,
      cast({_by_state('source_count', '-1', '-1', '-1')} as bigint) as source_number_of_records,
      {_by_state('destination', "'None'", running_destination, 'null')} as destination,
      cast({_by_state('destination_count', '-1', '-1', '-1')} as bigint) as destination_number_of_records,
      {_by_state(START, START, START, NOW)} as job_start_time,
      {_by_state(END, NOW, "'None'", 'null')} as job_end_time,
      {_by_state(SECONDS, "'None'", "'None'", 'null')} as Task_Duration,
      {task}{_by_state("'success'", "'failed'", "'running'", "'Starting...'")} as job_status, {TAIL}
    from ({TASK_RUNS}) r"""


def _stream_sql(kind: str, host: str, running: str, asset: str) -> str:
    return f"""
    select {STAMP} || dag_id || source_name as audit_id, {asset} group_name, {JOB_ID} as job_id,
      job_type || ' ' || {kind} as job_type, {host} as host, 'NA' as source_database, 'NA' as source_table,
      cast(-1 as bigint) as source_number_of_records,
      {_by_state('destination', "'None'", 'destination', "'None'")} as destination,
      cast(-1 as bigint) as destination_number_of_records,
      {_by_state(START, "'None'", START, NOW)} as job_start_time,
      {_by_state(END, "'None'", "'None'", "'None'")} as job_end_time,
      {_by_state(SECONDS, "'None'", "'None'", "'None'")} as Task_Duration,
      {_by_state("'success'", "'failed'", running, "'Starting...'")} as job_status, {TAIL}
    from ({TASK_RUNS}) r"""


RUN_FOLDER = (
    "destination || '/output' || source_name || lower(group_name) || strftime(execution_date, '%Y%m%dT%H%M%S')"
)
ASSET = "asset_id,"
SQL = {
    "rdbms_to_warehouse": _batch_sql("Rdbms to bigquery", "host", "table_name", "destination", "", ""),
    "rdbms_to_files": _batch_sql("Rdbms to gcs", "host", "table_name", RUN_FOLDER, "task_name || ", ASSET),
    "files_to_files": _batch_sql("gcs to gcs", "'GCS bucket'", "''", "destination", "task_name || ", ASSET),
    "stream_to_warehouse": _stream_sql("'Pubsub to bigquery'", "'NA'", "'Streaming'", ""),
    "stream_to_files": _stream_sql("'Pubsub to gcs'", "'NA'", "'Streaming'", ""),
    "sftp": _stream_sql("task_type", "host", "'running'", ASSET),
}
QUALITY_SQL = f"""
select {STAMP} || dag_id as audit_id, asset_id,
  case when state is null then 'Loading...' else coalesce(job_id, 'None') end as job_id, source, source_type,
  case when state is null then 'Loading...' when state = 'failed' then 'None as job got failed'
    else profiling_path end as profiling_path,
  case when state is null then 'Loading...' when state = 'failed' then 'None as job failed'
    else expectations_path end as expectations_ui_path,
  case when state is null then {NOW} else {START} || '+00:00' end as job_start_time,
  case when state is null then '0' else coalesce({END} || '+00:00', 'None') end as job_end_time,
  case when state is null then 'None' else coalesce({SECONDS}, 'None') end as Task_Duration,
  task_name || coalesce(state, 'Running') as job_status, try_number as no_of_retries, {LOG_URL} as log_url,
  '2024-06-01' as ingestion_date, dag_id, project, 'dqaudit_dataset_replace' as dataset_id,
  'dqaudit_table_replace' as table_id
from ({TASK_RUNS}) r"""


def _register_profiles() -> None:
    for name in (*PROFILES, "dq"):

        def run(spark, t, profile=name):
            return audit_record(t.sql(TASK_RUNS), profile, RUN_TIME)

        query(f"audit_{name}", SQL.get(name, QUALITY_SQL))(run)


_register_profiles()


@query("audit_project", f"select audit_id, job_status, destination from ({SQL['files_to_files']}) a")
def _audit_project(spark, t):
    return audit_record(t.sql(TASK_RUNS), "files_to_files", RUN_TIME).select("audit_id", "job_status", "destination")


ALL_PROFILES = (*PROFILES, "dq")


def all_records(t):
    """Records of every task run under every profile, with the profile and the run that tell them apart."""
    runs = t.sql(TASK_RUNS)
    return union_audit(
        *[audit_record(runs, name, RUN_TIME, keep=["run_id"]).withColumn("profile", F.lit(name)) for name in ALL_PROFILES]
    )


@query("sink_audit", " union all by name ".join(f"select * from ({SQL.get(name, QUALITY_SQL)}) a" for name in ALL_PROFILES))
def _sink_audit(spark, t):
    path = run_folder(spark, "audit")
    records = all_records(t)
    for _ in range(2):  # the second call adds nothing
        append_audit(records, path, ["profile", "run_id"], keep_identity=False)
    return read_audit(spark, path)


@query(
    "audit_compacted",
    f"select count(*) as records, count(distinct audit_id) as ids, count(distinct ingestion_date) as folders from ({SQL['sftp']}) a",
)
def _audit_compacted(spark, t):
    """Three appends of one day by three writers, the last of them a repeat, swapped for one folder."""
    log = AuditLog(spark, run_folder(spark, "audit"))
    records = audit_record(t.sql(TASK_RUNS), "sftp", RUN_TIME, keep=["run_id"])
    for part in ("run_id % 2 = 0", "run_id % 2 = 1", "true"):
        log.append(records.where(part), ["run_id"], keep_identity=False)
    for day in {name.split("/")[0].partition("=")[2] for name in log.files()}:
        log.compact(day)
    return log.read().agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("audit_id").alias("ids"),
        F.lit(len(log.files())).cast("bigint").alias("folders"),
    )


FILES = SQL["files_to_files"]


@query(
    "audit_stored_counts",
    f"""select * replace (nullif(source_number_of_records, -1) as source_number_of_records,
          nullif(destination_number_of_records, -1) as destination_number_of_records),
        case when source_number_of_records = -1 then 'unknown' else 'ok' end as count_status from ({FILES}) a""",
)
def _stored(spark, t):
    return stored_counts(audit_record(t.sql(TASK_RUNS), "files_to_files", RUN_TIME))


@query("union_audit", " union all by name ".join(f"select * from ({sql}) a" for sql in SQL.values()))
def _union_audit(spark, t):
    runs = t.sql(TASK_RUNS)
    return union_audit(*[audit_record(runs, name, RUN_TIME) for name in PROFILES])


@query(
    "audit_summary",
    f"""
    select asset_id, job_status, count(*) as runs,
      cast(sum(source_number_of_records) filter (where source_number_of_records <> -1) as bigint) as source_records,
      cast(sum(destination_number_of_records) filter (where destination_number_of_records <> -1) as bigint)
        as destination_records,
      cast(sum(try_cast(Task_Duration as decimal(24,6))) as double) as total_seconds,
      cast(max(try_cast(Task_Duration as decimal(24,6))) as double) as max_seconds
    from ({FILES}) a group by 1, 2
    """,
)
def _audit_summary(spark, t):
    return audit_summary(audit_record(t.sql(TASK_RUNS), "files_to_files", RUN_TIME))


@query(
    "latest_audit",
    """select user_id, event_type, event_id, ts, value, props from {events}
       qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1""",
)
def _latest_audit(spark, t):
    return latest_audit(t.events, ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "latest_audit_record",
    f"""
    select * from (
      select r.run_id, a.* exclude (place) from (select *, row_number() over () as place from ({FILES}) x) a
      join (select run_id, row_number() over () as place from ({TASK_RUNS}) y) r on a.place = r.place) z
    qualify row_number() over (partition by audit_id order by run_id desc) = 1
    """,
)
def _latest_record(spark, t):
    records = audit_record(t.sql(TASK_RUNS), "files_to_files", RUN_TIME, keep=["run_id"])
    return latest_audit(records, ["audit_id"], ["run_id"])
