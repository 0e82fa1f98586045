"""One run from the source files to the audit table, stage by stage, resumable.

What a stage has finished is in the run's manifest and its files are in the run's own folders, so a run
that was cut off goes on with its first unfinished stage, on this driver or another one:

=========  ==================================================================================
parse      the source as a columnar copy, lines that do not fit, and two counts: records as
           parsed, and records as line ends and quotes alone say
select     the rows past the stored value, and those of the overlap that no load has had
land       the landing zone, counted from its files
protect    the secured zone by the template, counted too
check      quality report and profile, stored
load       the warehouse, only when all counts agree
state      the processed mark, the new stored value, and the ledger of loaded rows
=========  ==================================================================================
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import hashlib
import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quayside.functions.paths import RUN_PARENT, SECURED_PARENT
from quayside.operators.audit import DQ, audit_record, union_audit
from quayside.operators.counts import count_csv_quoted, count_parquet_rows, scalar_first
from quayside.operators.incremental import (
    INCREMENT,
    KeyLedger,
    filter_incremental,
    next_watermark,
    overlap_start,
    split_increment,
)
from quayside.operators.profile import profile_columns
from quayside.operators.quality import run_suite, summarize
from quayside.operators.surrogates import SurrogateMap
from quayside.operators.tokenize import apply_template
from quayside.plans.manifest import RunManifest
from quayside.plans.stages import stages_for
from quayside.session import together
from quayside.sinks.audit_log import append_audit
from quayside.sinks.files import sink_format, sink_partitioned
from quayside.sinks.state import StateTable, store_watermark
from quayside.sinks.warehouse import add_load_timestamp, sink_warehouse_gated
from quayside.sources.files import CORRUPT_COLUMN, scan_csv
from quayside.sources.tables import LOAD_TS

#: What tells the records of runs apart: a record is one state of one attempt.
RECORD_IDENTITY = ("audit_id", "asset_id", "job_status", "no_of_retries")


@dataclass(frozen=True)
class RunConfig:
    """The settings of one run. Switches are the texts ``'True'`` and ``'False'``."""

    asset_id: str
    source_path: str
    landing_zone: str
    secured_zone: str
    audit_path: str
    output_format: str = "csv"
    task_type: str = "gcs_to_gcs"
    job_type: str = "dataproc"
    group_name: str = ""
    project: str = ""
    dag_id: str = "landing"
    schema: StructType | str | None = None
    multi_line: bool = False
    tokenization_check: str = "False"
    data_quality_check: str = "False"
    dw_load_ind: str = "False"
    warehouse_table: str = ""
    incremental_column: str = ""
    incremental_column_value: str = ""  # empty: the one in the state table
    incremental_overlap: str = ""  # how far below the stored value late rows are looked for: a number or an interval
    ledger_path: str = ""  # digests of loaded rows; needed for an overlap and for rows that tie with the stored value
    column_partition: str = ""
    is_processed: str = "false"
    state_path: str = ""
    record_states: bool = False  # record the start and the running of an attempt as well as its outcome
    template: Mapping[str, object] = field(default_factory=dict)
    suite: object = ()


@dataclass(frozen=True)
class RunReport:
    """What a run made: folders, and tables to read or show."""

    landing: str
    secured: str | None
    counts: Row
    quality: DataFrame | None
    profile: DataFrame | None
    watermark: DataFrame | None
    audit: DataFrame
    rejected: int = 0  # lines that did not fit the schema; their texts are in ``<landing>_rejected``
    attempt: int = 1
    resumed: bool = False  # whether stages of an earlier attempt were taken over
    source_lines: int = 0  # records of the source by line ends and quotes alone, whatever the parser made of them
    skipped: Mapping[str, int] = field(default_factory=dict)  # rows an incremental load left out, by reason


def folders(config: RunConfig, run_ts: dt.datetime) -> tuple[str, str]:
    run = f"{config.asset_id}_{run_ts.strftime('%Y%m%dT%H%M%S')}"
    return f"{config.landing_zone}{RUN_PARENT}{run}", f"{config.secured_zone}{SECURED_PARENT}{RUN_PARENT}{run}"


def _write(df: DataFrame, path: str, config: RunConfig) -> int:
    """Write a zone folder and count what stands in its files, apart from what wrote them."""
    spark = df.sparkSession
    if config.column_partition:
        # The folder is the run's own: partitions of an earlier attempt must not stay.
        sink_partitioned(df, path, [config.column_partition], config.output_format, replace="static")
    else:
        sink_format(df, path, config.output_format)
    if config.output_format == "csv":
        return scalar_first(count_csv_quoted(spark, path))
    if config.output_format == "parquet":
        return scalar_first(count_parquet_rows(spark, path))
    return spark.read.format(config.output_format).schema(df.schema).load(path).count()


def _task_run(spark: SparkSession, config: RunConfig, run_ts: dt.datetime, state: str | None, attempt: int) -> DataFrame:
    now = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
    return spark.range(1).select(
        F.lit(config.dag_id).alias("dag_id"),
        F.lit(config.asset_id).alias("source_name"),
        F.lit(state).cast("string").alias("state"),
        now.alias("execution_date"),
        now.alias("start_date"),
        now.alias("end_date"),
        F.lit(attempt).alias("try_number"),
    )


def _settings(config: RunConfig) -> dict[str, str]:
    return {
        "asset_id": config.asset_id,
        "job_type": config.job_type,
        "task_type": config.task_type,
        "group_name": config.group_name,
        "project": config.project,
    }


def _ingestion_record(
    spark: SparkSession, config: RunConfig, run_ts: dt.datetime, state: str | None, attempt: int, read: int = -1, wrote: int = -1
) -> DataFrame:
    return audit_record(
        _task_run(spark, config, run_ts, state, attempt),
        "files_to_files",
        run_ts,
        task_name="Ingestion_",
        database=config.landing_zone,
        destination=folders(config, run_ts)[0],
        source_count=read,
        destination_count=wrote,
        **_settings(config),
    )


def _source_options(config: RunConfig) -> dict:
    return {"recursive": True, "glob": "*.csv", "multi_line": config.multi_line}


def _fingerprint(spark: SparkSession, config: RunConfig) -> str:
    """What the run reads and how: its settings, and names, lengths and times of its files, listed by Spark."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
        .load(config.source_path).select("path", "length", "modificationTime")
    )
    seen = files.agg(F.count(F.lit(1)), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()
    settings = sorted((f.name, repr(getattr(config, f.name))) for f in dataclasses.fields(config))
    return hashlib.sha256(repr((settings, *seen)).encode()).hexdigest()


def _parse(spark: SparkSession, config: RunConfig, landing: str, copy: str) -> dict:
    """The source's records as a columnar copy, beside the text of lines that do not fit its schema.

    Both halves of a record that a newline has split are such lines, and so is one with more or fewer
    fields than the schema. Without a schema one is inferred first and then kept to like any other.
    Records are also counted by line ends and quotes alone: if the parser made more or fewer of them,
    the run is no match.
    """
    options = _source_options(config)
    schema = config.schema
    if schema is None:
        schema = scan_csv(spark, config.source_path, None, **options).schema
    else:
        # Read once as it was before, for its check of the header's order.
        scan_csv(spark, config.source_path, schema, **options).take(1)
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    source = scan_csv(spark, config.source_path, schema, keep_corrupt=True, **options)
    _, lines = together(
        lambda: source.write.mode("overwrite").parquet(copy),
        lambda: scalar_first(count_csv_quoted(spark, config.source_path)),
    )
    parsed = spark.read.schema(StructType([*schema.fields]).add(CORRUPT_COLUMN, "string")).parquet(copy)
    broken = parsed.where(F.col(CORRUPT_COLUMN).isNotNull()).select(F.col(CORRUPT_COLUMN).alias("value"))
    rows, rejected = parsed.agg(F.count(F.lit(1)), F.count(CORRUPT_COLUMN)).first()
    if rejected:
        broken.write.mode("overwrite").text(f"{landing}_rejected")
    return {"schema": schema.json(), "rejected": rejected, "parsed": rows, "lines": lines}


def _stored_value(spark: SparkSession, config: RunConfig) -> str | None:
    """The value the next load starts from: the configured one, or the one in the state table."""
    if config.incremental_column_value or not config.state_path:
        return config.incremental_column_value or None
    state = StateTable(spark, config.state_path)
    if not state.version() or "incremental_column_value" not in state.read().columns:
        return None
    found = state.read().where(F.col("asset_id") == config.asset_id).select("incremental_column_value").first()
    return found[0] if found else None


def _select(spark: SparkSession, config: RunConfig, parsed: DataFrame, path: str) -> dict:
    """Write the rows that this load takes, and count the others by why they are left out."""
    column = config.incremental_column
    last = _stored_value(spark, config)
    kind = parsed.schema[column].dataType
    wanted = filter_incremental(parsed, column, last)
    counts = split_increment(parsed, column, last).groupBy(INCREMENT).count().collect()
    skipped = {r[INCREMENT]: r["count"] for r in counts if r[INCREMENT] != "new"}
    late = 0
    if config.ledger_path and last is not None:
        since = overlap_start(spark, last, config.incremental_overlap, kind)
        value = F.col(column)
        overlap = parsed.where((value >= F.lit(since).cast(kind)) & (value <= F.lit(last).cast(kind)))
        found = KeyLedger(spark, config.ledger_path).unseen(overlap, column, since)
        wanted = wanted.unionByName(found)
    wanted.write.mode("overwrite").parquet(path)
    stored = spark.read.schema(parsed.schema).parquet(path)
    read = stored.count()
    if config.ledger_path and last is not None:
        late = stored.where(F.col(column) <= F.lit(last).cast(kind)).count()
    newest = scalar_first(next_watermark(stored, column, last))
    return {"read": read, "late": late, "skipped": skipped, "newest": None if newest is None else str(newest)}


def _reports(checked: DataFrame, config: RunConfig, path: str) -> dict:
    together(
        lambda: run_suite(checked, config.suite).write.mode("overwrite").parquet(f"{path}/checks"),
        lambda: profile_columns(checked).write.mode("overwrite").parquet(f"{path}/profile"),
    )
    return {"checks": f"{path}/checks", "profile": f"{path}/profile"}


def _store_state(spark: SparkSession, config: RunConfig, wanted: DataFrame, newest: str | None) -> dict:
    if config.ledger_path and newest is not None:
        kind = wanted.schema[config.incremental_column].dataType
        since = overlap_start(spark, newest, config.incremental_overlap, kind)
        KeyLedger(spark, config.ledger_path).record(wanted, config.incremental_column, since)
    if config.state_path:
        state = StateTable(spark, config.state_path)
        state.update_processed(config.asset_id, config.is_processed)
        if newest is not None and "incremental_column_value" in state.read().columns:
            state.update(lambda rows: store_watermark(rows, config.asset_id, newest))
    return {}


def land(
    spark: SparkSession,
    config: RunConfig,
    run_ts: dt.datetime,
    key: bytes | None = None,
    surrogates: Mapping[str, SurrogateMap] | None = None,
) -> RunReport:
    """One run (see ``_land``); an attempt that fails leaves a record that says so, and the error is raised."""
    manifest = RunManifest(spark, f"{folders(config, run_ts)[0]}_run")
    try:
        return _land(spark, config, run_ts, manifest, key, surrogates)
    except Exception:
        append_audit(_ingestion_record(spark, config, run_ts, "failed", manifest.attempt), config.audit_path, RECORD_IDENTITY)
        raise


def _begin(spark: SparkSession, config: RunConfig, manifest: RunManifest) -> bool:
    try:
        found = _fingerprint(spark, config)
    except Exception:
        manifest.begin("no readable source")  # a failed attempt is one too
        raise
    return manifest.begin(found)


def _land(
    spark: SparkSession,
    config: RunConfig,
    run_ts: dt.datetime,
    manifest: RunManifest,
    key: bytes | None,
    surrogates: Mapping[str, SurrogateMap] | None,
) -> RunReport:
    """Land the source, protect it, check it, count both sides, load it and record the run.

    The text of source and zones is parsed once; what follows reads columnar copies, and zones are
    counted from their files. Warehouse, state and stored value change only after all counts agree.
    A repeat of a run that ended well over the same files does nothing and gives its report.
    """
    tokenizes, checks = stages_for(config.tokenization_check, config.data_quality_check)
    landing, secured = folders(config, run_ts)
    work, reports = f"{landing}_work", f"{landing}_reports"
    runs = _begin(spark, config, manifest)

    def record(state: str | None, *counts: int) -> DataFrame:
        return _ingestion_record(spark, config, run_ts, state, manifest.attempt, *counts)

    if runs and config.record_states:
        append_audit(record(None), config.audit_path, RECORD_IDENTITY)

    source = manifest.stage("parse", lambda: _parse(spark, config, landing, f"{work}/parsed"))
    schema = StructType.fromJson(json.loads(source["schema"]))
    copy = spark.read.schema(StructType([*schema.fields]).add(CORRUPT_COLUMN, "string")).parquet(f"{work}/parsed") if runs else None
    wanted = copy.where(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN) if runs else None
    picked = {"read": source["parsed"] - source["rejected"], "late": 0, "skipped": {}, "newest": None}
    if config.incremental_column:
        picked = manifest.stage("select", lambda: _select(spark, config, wanted, f"{work}/wanted"))
        wanted = spark.read.schema(schema).parquet(f"{work}/wanted") if runs else None

    if runs and config.record_states:
        append_audit(record("running"), config.audit_path, RECORD_IDENTITY)

    def protect() -> dict:
        protected = apply_template(wanted, config.template, key, surrogates)
        if checks:
            # Read several times from here on, most of it a few columns.
            protected.write.mode("overwrite").parquet(f"{work}/protected")
            protected = spark.read.schema(protected.schema).parquet(f"{work}/protected")
        return {"rows": _write(protected, secured, config)}

    zones = [lambda: manifest.stage("land", lambda: {"rows": _write(wanted, landing, config)})["rows"]]
    if tokenizes:
        zones.append(lambda: manifest.stage("protect", protect)["rows"])
    wrote, *others = together(*zones)
    kept = others[0] if others else wrote
    checked = wanted
    if tokenizes:
        checked = spark.read.parquet(f"{work}/protected") if checks and runs else None
    if checks:
        manifest.stage("check", lambda: _reports(checked, config, reports))

    read = picked["read"]
    whole = source["parsed"] == source["lines"] and not source["rejected"]
    row = Row(
        asset_id=config.asset_id,
        source_records=read,
        destination_records=wrote,
        diff=read - wrote,
        match=whole and read == wrote == kept,
    )
    if row["match"]:
        if config.dw_load_ind == "True":

            def load() -> dict:
                rows = add_load_timestamp(wanted, run_ts)
                sink_warehouse_gated(rows, config.warehouse_table, config.dw_load_ind, load_column=LOAD_TS)
                return {}

            manifest.stage("load", load)
        manifest.stage("state", lambda: _store_state(spark, config, wanted, picked["newest"]))

    outcome = "success" if row["match"] else "failed"
    records = [record(outcome, row["source_records"], row["destination_records"])]
    if checks:
        records.append(
            audit_record(
                _task_run(spark, config, run_ts, "success", manifest.attempt),
                DQ,
                run_ts,
                task_name="Data_Quality_",
                source=secured if tokenizes else landing,
                source_type="files",
                profiling_path=f"{reports}/profile",
                expectations_path=f"{reports}/checks",
                **_settings(config),
            )
        )
    audit = union_audit(*records)
    append_audit(audit, config.audit_path, RECORD_IDENTITY)
    if runs:
        manifest.end(outcome)
        manifest.log.delete(work)
    newest = None
    if config.incremental_column:
        stored = F.lit(picked["newest"]).cast(schema[config.incremental_column].dataType)
        newest = spark.range(1).select(stored.alias("incremental_column_value"))
    return RunReport(
        landing,
        secured if tokenizes else None,
        row,
        spark.read.parquet(f"{reports}/checks") if checks else None,
        spark.read.parquet(f"{reports}/profile") if checks else None,
        newest,
        audit,
        source["rejected"],
        manifest.attempt,
        manifest.resumed,
        source["lines"],
        picked["skipped"] | ({"late": picked["late"]} if picked["late"] else {}),
    )


def verdict(report: RunReport) -> DataFrame:
    """Did it land whole, and is it clean: the counts of the run beside the outcome of its checks."""
    kinds = {"asset_id": "string", "match": "boolean"}
    counts = [F.lit(v).cast(kinds.get(n, "bigint")).alias(n) for n, v in report.counts.asDict().items()]
    return summarize(report.quality).select(*counts, "*")
