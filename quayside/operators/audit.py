"""Audit records: one flat record for each state of each task run.

A profile says which fields a kind of task records and what each field holds in each state. One
projection builds the records of all runs in a table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions import scalars
from quayside.functions.paths import ts_nodash

SUCCESS, FAILED, RUNNING, ABSENT = "success", "failed", "running", None

# Texts and numbers that stand in the records.
NO_TEXT = "None"
LOADING = "Loading..."
STARTING = "Starting..."
STREAMING = "Streaming"
NOT_APPLICABLE = "NA"
UNKNOWN_COUNT = -1
NO_TIME = "0"
JOB_TYPES_WITH_ID = ("dataflow", "dataproc")
FILE_HOST = "GCS bucket"
AUDIT_DATASET = "dataset_to_replace"
AUDIT_TABLE = "table_to_replace"
QUALITY_DATASET = "dqaudit_dataset_replace"
QUALITY_TABLE = "dqaudit_table_replace"
QUALITY_FAILED_REPORT = "None as job failed"
QUALITY_FAILED_PROFILE = "None as job got failed"
QUALITY_RUNNING = "Running"

# The record's fields in order.
RECORD_FIELDS = (
    "audit_id",
    "asset_id",
    "group_name",
    "job_id",
    "job_type",
    "host",
    "source_database",
    "source_table",
    "source_number_of_records",
    "destination",
    "destination_number_of_records",
    "job_start_time",
    "job_end_time",
    "Task_Duration",
    "job_status",
    "no_of_retries",
    "log_url",
    "ingestion_date",
    "dag_id",
    "audit_dataset",
    "audit_table",
    "project",
)
QUALITY_FIELDS = (
    "audit_id",
    "asset_id",
    "job_id",
    "source",
    "source_type",
    "profiling_path",
    "expectations_ui_path",
    "job_start_time",
    "job_end_time",
    "Task_Duration",
    "job_status",
    "no_of_retries",
    "log_url",
    "ingestion_date",
    "dag_id",
    "project",
    "dataset_id",
    "table_id",
)

# Cells of the state tables below that are taken from the run.
START, END, NOW, DURATION, SOURCE_COUNT, DESTINATION_COUNT, DESTINATION, RUN_DESTINATION, JOB_ID = (
    f"<{name}>"
    for name in "start end now duration source_count destination_count destination run_destination job_id".split()
)

# What each field holds in each state. A state that is not listed gives NULL.
BATCH_STATES = {
    "job_id": {SUCCESS: JOB_ID, FAILED: JOB_ID, RUNNING: JOB_ID, ABSENT: LOADING},
    "source_number_of_records": {
        SUCCESS: SOURCE_COUNT,
        FAILED: UNKNOWN_COUNT,
        RUNNING: UNKNOWN_COUNT,
        ABSENT: UNKNOWN_COUNT,
    },
    "destination": {SUCCESS: DESTINATION, FAILED: NO_TEXT, RUNNING: DESTINATION},
    "destination_number_of_records": {
        SUCCESS: DESTINATION_COUNT,
        FAILED: UNKNOWN_COUNT,
        RUNNING: UNKNOWN_COUNT,
        ABSENT: UNKNOWN_COUNT,
    },
    "job_start_time": {SUCCESS: START, FAILED: START, RUNNING: START, ABSENT: NOW},
    "job_end_time": {SUCCESS: END, FAILED: NOW, RUNNING: NO_TEXT},
    "Task_Duration": {SUCCESS: DURATION, FAILED: NO_TEXT, RUNNING: NO_TEXT},
    "job_status": {SUCCESS: SUCCESS, FAILED: FAILED, RUNNING: RUNNING, ABSENT: STARTING},
}
UNCOUNTED_STATES = {
    **BATCH_STATES,
    "source_number_of_records": dict.fromkeys((SUCCESS, FAILED, RUNNING, ABSENT), UNKNOWN_COUNT),
    "destination": {SUCCESS: DESTINATION, FAILED: NO_TEXT, RUNNING: DESTINATION, ABSENT: NO_TEXT},
    "destination_number_of_records": dict.fromkeys((SUCCESS, FAILED, RUNNING, ABSENT), UNKNOWN_COUNT),
    "job_start_time": {SUCCESS: START, FAILED: NO_TEXT, RUNNING: START, ABSENT: NOW},
    "job_end_time": {SUCCESS: END, FAILED: NO_TEXT, RUNNING: NO_TEXT, ABSENT: NO_TEXT},
    "Task_Duration": {SUCCESS: DURATION, FAILED: NO_TEXT, RUNNING: NO_TEXT, ABSENT: NO_TEXT},
}
STREAM_STATES = {
    **UNCOUNTED_STATES,
    "job_status": {**BATCH_STATES["job_status"], RUNNING: STREAMING},
}
RUN_FOLDER_STATES = {
    **BATCH_STATES,
    "destination": {SUCCESS: DESTINATION, FAILED: NO_TEXT, RUNNING: RUN_DESTINATION},
}


@dataclass(frozen=True)
class Profile:
    """How one kind of task is recorded."""

    states: Mapping[str, Mapping]
    kind: str | None = None  # follows the job type; None takes the run's task type
    fixed: Mapping[str, str] = field(default_factory=dict)
    names_asset: bool = True
    names_task: bool = False  # the status carries the task's name in front


# The text that follows the job type, and fields that do not come from the run.
_STREAM_SOURCE = {"host": NOT_APPLICABLE, "source_database": NOT_APPLICABLE, "source_table": NOT_APPLICABLE}
PROFILES = {
    "rdbms_to_warehouse": Profile(BATCH_STATES, "Rdbms to bigquery", names_asset=False),
    "rdbms_to_files": Profile(RUN_FOLDER_STATES, "Rdbms to gcs", names_task=True),
    "files_to_files": Profile(
        BATCH_STATES, "gcs to gcs", {"host": FILE_HOST, "source_table": ""}, names_task=True
    ),
    "stream_to_warehouse": Profile(STREAM_STATES, "Pubsub to bigquery", _STREAM_SOURCE, names_asset=False),
    "stream_to_files": Profile(STREAM_STATES, "Pubsub to gcs", _STREAM_SOURCE, names_asset=False),
    "sftp": Profile(
        UNCOUNTED_STATES, None, {"source_database": NOT_APPLICABLE, "source_table": NOT_APPLICABLE}
    ),
}
DQ = "dq"

# Columns that task runs may leave out, and their types.
OPTIONAL = {
    "asset_id": "string",
    "task_name": "string",
    "task_type": "string",
    "job_type": "string",
    "group_name": "string",
    "host": "string",
    "database": "string",
    "table_name": "string",
    "destination": "string",
    "source_count": "bigint",
    "destination_count": "bigint",
    "job_id": "string",
    "project": "string",
    "source": "string",
    "source_type": "string",
    "profiling_path": "string",
    "expectations_path": "string",
    "duration": "double",
}
TIMES = ("execution_date", "start_date", "end_date")


def _prepare(runs: DataFrame, constants: Mapping[str, object]) -> DataFrame:
    """Task runs with every column that a profile may read; constants fill columns of all rows."""
    extra = {n: F.lit(v).cast(OPTIONAL.get(n, "string")) for n, v in constants.items()}
    for name, kind in OPTIONAL.items():
        if name not in runs.columns and name not in extra:
            extra[name] = F.lit(None).cast(kind)
    for name in TIMES:
        given = F.col(name)
        is_text = runs.schema[name].dataType.simpleString() == "string"
        extra[name] = scalars.parse_task_ts(given) if is_text else given.cast("timestamp_ntz")
    state = F.when(F.col("state") != NO_TEXT, F.col("state"))
    seconds = scalars.task_seconds(extra["start_date"], extra["end_date"])
    known = F.col("duration") if "duration" in runs.columns else F.lit(None).cast("double")
    extra["duration"] = F.coalesce(known, seconds)
    return runs.withColumns({**extra, "state": state})


def _choose(cells: Mapping, sources: Mapping[str, Column], kind: str) -> Column:
    """The cell of the run's state."""
    state = F.col("state")

    def cell(value) -> Column:
        found = sources.get(value) if isinstance(value, str) else None
        return (F.lit(value) if found is None else found).cast(kind)

    def same(name) -> Column:
        return state.isNull() if name is None else state == name

    names = list(cells)
    rest = [(same(n), cell(cells[n])) for n in names[1:]]
    return reduce(lambda chain, arm: chain.when(*arm), rest, F.when(same(names[0]), cell(cells[names[0]])))


def _now(run_ts) -> Column:
    if isinstance(run_ts, Column):
        return run_ts.cast("timestamp_ntz")
    text = run_ts.isoformat(sep=" ") if isinstance(run_ts, dt.datetime) else str(run_ts)
    return F.lit(text).cast("timestamp_ntz")


def _common(run_ts) -> dict[str, Column]:
    dag = F.col("dag_id")
    return {
        "no_of_retries": F.col("try_number").cast("int"),
        "log_url": scalars.log_url(dag, F.col("execution_date")),
        "ingestion_date": scalars.ingestion_date(_now(run_ts)),
        "dag_id": dag,
        "project": F.col("project"),
    }


def audit_record(runs: DataFrame, profile: str, run_ts, keep: Sequence[str] = (), **constants) -> DataFrame:
    """Records of task runs under a profile.

    ``runs`` has ``dag_id, source_name, state, execution_date, start_date, end_date, try_number`` and
    any of ``OPTIONAL``; ``constants`` give columns that are the same for all runs. ``run_ts`` stands
    for the present. ``keep`` names columns of ``runs`` to carry along in front.
    """
    runs = _prepare(runs, constants)
    if profile == DQ:
        return _quality_record(runs, run_ts, keep)
    spec = PROFILES[profile]
    with_id = F.lower("job_type").isin(*JOB_TYPES_WITH_ID)
    destination = F.col("destination")
    sources = {
        START: scalars.ts_text(F.col("start_date")),
        END: scalars.ts_text(F.col("end_date")),
        NOW: scalars.ts_text(_now(run_ts)),
        DURATION: scalars.seconds_text(F.col("duration")),
        SOURCE_COUNT: F.col("source_count"),
        DESTINATION_COUNT: F.col("destination_count"),
        DESTINATION: destination,
        RUN_DESTINATION: F.concat(
            destination,
            F.lit("/output"),
            F.col("source_name"),
            scalars.lower_group(F.col("group_name")),
            ts_nodash(F.col("execution_date")),
        ),
        JOB_ID: F.when(with_id, F.coalesce("job_id", F.lit(NO_TEXT))).otherwise(F.lit(NO_TEXT)),
    }
    counts = ("source_number_of_records", "destination_number_of_records")
    by_state = {
        name: _choose(cells, sources, "bigint" if name in counts else "string") for name, cells in spec.states.items()
    }
    if spec.names_task:
        by_state["job_status"] = F.concat(F.col("task_name"), by_state["job_status"])
    values = {
        **_common(run_ts),
        **by_state,
        "audit_id": scalars.audit_id(F.col("execution_date"), F.col("dag_id"), F.col("source_name")),
        "asset_id": F.col("asset_id"),
        "group_name": F.col("group_name"),
        "job_type": scalars.job_type_text(
            F.col("job_type"), F.col("task_type") if spec.kind is None else F.lit(spec.kind)
        ),
        "host": F.col("host"),
        "source_database": F.col("database"),
        "source_table": F.col("table_name"),
        "audit_dataset": F.lit(AUDIT_DATASET),
        "audit_table": F.lit(AUDIT_TABLE),
        **{name: F.lit(text) for name, text in spec.fixed.items()},
    }
    fields = [name for name in RECORD_FIELDS if spec.names_asset or name != "asset_id"]
    return runs.select(*keep, *[values[name].alias(name) for name in fields])


def _quality_record(runs: DataFrame, run_ts, keep: Sequence[str]) -> DataFrame:
    """Records of quality tasks: times keep their offset, and any state gives a status."""
    state = F.col("state")
    listed = state.isin(SUCCESS, FAILED, RUNNING)

    def or_none(text: Column) -> Column:
        return F.coalesce(text, F.lit(NO_TEXT))

    def when_listed(value: Column, other: str) -> Column:
        return F.when(listed, or_none(value)).otherwise(F.lit(other))

    def report(path: str, failed: str) -> Column:
        return (
            F.when(state.isNull(), LOADING).when(state == FAILED, failed).otherwise(or_none(F.col(path)))
        )

    start = when_listed(scalars.ts_text(F.col("start_date"), "+00:00"), NO_TIME)
    values = {
        **_common(run_ts),
        "audit_id": scalars.audit_id(F.col("execution_date"), F.col("dag_id")),
        "asset_id": F.col("asset_id"),
        "job_id": F.when(state.isNull(), LOADING).otherwise(when_listed(F.col("job_id"), NO_TEXT)),
        "source": or_none(F.col("source")),
        "source_type": or_none(F.col("source_type")),
        "profiling_path": report("profiling_path", QUALITY_FAILED_PROFILE),
        "expectations_ui_path": report("expectations_path", QUALITY_FAILED_REPORT),
        "job_start_time": F.when(state.isNull(), scalars.ts_text(_now(run_ts))).otherwise(start),
        "job_end_time": when_listed(scalars.ts_text(F.col("end_date"), "+00:00"), NO_TIME),
        "Task_Duration": when_listed(scalars.seconds_text(F.col("duration")), NO_TEXT),
        "job_status": F.concat(F.col("task_name"), F.coalesce(state, F.lit(QUALITY_RUNNING))),
        "dataset_id": F.lit(QUALITY_DATASET),
        "table_id": F.lit(QUALITY_TABLE),
    }
    return runs.select(*keep, *[values[name].alias(name) for name in QUALITY_FIELDS])


def stored_counts(records: DataFrame) -> DataFrame:
    """Records with NULL for a count that is not known, and ``count_status``: ok, unknown or error."""
    source, landed = F.col("source_number_of_records"), F.col("destination_number_of_records")
    unknown = (source == UNKNOWN_COUNT) | (landed == UNKNOWN_COUNT)
    failed = source.isNull() | landed.isNull()
    status = F.when(unknown, "unknown").when(failed, "error").otherwise("ok")
    return records.withColumns(
        {
            "source_number_of_records": F.nullif(source, F.lit(UNKNOWN_COUNT).cast("bigint")),
            "destination_number_of_records": F.nullif(landed, F.lit(UNKNOWN_COUNT).cast("bigint")),
            "count_status": status,
        }
    )


def union_audit(*records: DataFrame) -> DataFrame:
    """Records of several profiles as one table; fields that a profile lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), records)


def latest_audit(records: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest record for each key.

    An aggregate, not a window: every task keeps one candidate for each key before the shuffle, so
    a key that holds a large share of the records is no load.
    """
    newest = F.max_by(F.struct(*records.columns), F.struct(*order)).alias("record")
    return records.groupBy(*[F.col(k).alias(f"key_{k}") for k in keys]).agg(newest).select("record.*")


def audit_summary(records: DataFrame) -> DataFrame:
    """Runs, counts and time for each asset and status."""
    seconds = F.col("Task_Duration").try_cast("decimal(24,6)")
    counted = F.col("source_number_of_records") != UNKNOWN_COUNT
    landed = F.col("destination_number_of_records") != UNKNOWN_COUNT
    return records.groupBy("asset_id", "job_status").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum(F.when(counted, F.col("source_number_of_records"))).alias("source_records"),
        F.sum(F.when(landed, F.col("destination_number_of_records"))).alias("destination_records"),
        F.sum(seconds).cast("double").alias("total_seconds"),
        F.max(seconds).cast("double").alias("max_seconds"),
    )
