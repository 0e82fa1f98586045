"""Whole runs: their records, increments, reports, failures and what they refuse."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.catalog.file_queries import DEMO_KEY, LIVE_CHECKS, RUN_TS, hmac_sql
from quayside.catalog.fixtures import COMPLEX_TYPES
from quayside.catalog.registry import query
from quayside.plans.landing import RunConfig, land
from quayside.session import run_folder
from quayside.sinks.audit_log import read_audit
from quayside.sinks.files import sink_csv
from quayside.sinks.state import StateTable


def settings(base: str, asset: str, **more) -> RunConfig:
    return RunConfig(
        asset_id=asset,
        source_path=f"{base}/raw",
        landing_zone=f"{base}/landing",
        secured_zone=f"{base}/secured",
        audit_path=f"{base}/audit",
        warehouse_table=f"{base}/warehouse",
        **more,
    )


def protected_settings(spark, t, **more) -> RunConfig:
    """A run over the table with a sensitive column: tokens, checks and load."""
    base = run_folder(spark, "run")
    rows = t.sql(COMPLEX_TYPES)
    sink_csv(rows, f"{base}/raw")
    switches = {name: "True" for name in ("tokenization_check", "data_quality_check", "dw_load_ind")}
    return settings(base, "1001", schema=rows.schema, template={"masterCard": "hash"}, suite=LIVE_CHECKS, **switches, **more)


# Texts of the records of one landing run, as every profile writes them.
STARTED = "2024-06-01 12:00:00"
INGESTION = f"""
select '20240601120000landing1001' as audit_id, '1001' as asset_id, '' as group_name,
  case when status = 'Starting...' then 'Loading...' else 'None' end as job_id, 'dataproc gcs to gcs' as job_type,
  'GCS bucket' as host, '' as source_table,
  cast(case when status = 'success' then n else -1 end as bigint) as source_number_of_records,
  cast(case when status = 'success' then n else -1 end as bigint) as destination_number_of_records,
  case status when 'Starting...' then null when 'failed' then 'None' else '/dataproc/1001_20240601T120000' end as destination,
  '{STARTED}' as job_start_time, case status when 'Starting...' then null when 'running' then 'None' else '{STARTED}' end as job_end_time,
  case status when 'success' then '0.0' when 'Starting...' then null else 'None' end as Task_Duration,
  'Ingestion_' || status as job_status, attempt as no_of_retries, '2024-06-01' as ingestion_date, 'landing' as dag_id, '' as project
"""
QUALITY = """
select '20240601120000landing' as audit_id, '1001' as asset_id, 'None' as job_id, 'files' as source_type, 'checks' as expectations_ui_path,
  'profile' as profiling_path, '2024-06-01 12:00:00+00:00' as job_start_time, '2024-06-01 12:00:00+00:00' as job_end_time, '0.0' as Task_Duration,
  'Data_Quality_success' as job_status, attempt as no_of_retries, '2024-06-01' as ingestion_date, 'landing' as dag_id, '' as project
"""


def _told(spark, config: RunConfig):
    """The audit table; folders by what follows the zone, and without what names the run's folder."""
    records = read_audit(spark, config.audit_path)
    return records.withColumns(
        {
            "destination": F.regexp_replace("destination", "^.*/landing", ""),
            "expectations_ui_path": F.regexp_extract("expectations_ui_path", "([a-z]+)$", 1),
            "profiling_path": F.regexp_extract("profiling_path", "([a-z]+)$", 1),
        }
    ).withColumns(
        {
            name: F.when(F.col("host").isNull(), F.col(name)).otherwise(F.lit(None).cast("string"))
            for name in ("expectations_ui_path", "profiling_path")
        }
    ).drop("log_url", "source", "source_database", "audit_dataset", "audit_table", "dataset_id", "table_id")


@query(
    "landing_run_audit",
    f"""select * from (with r as (select count(*) as n, 'success' as status, 1 as attempt from {{orders}}) {INGESTION} from r) a
        union all by name select * from (with r as (select 1 as attempt) {QUALITY} from r) b""",
)
def _landing_audit(spark, t):
    config = protected_settings(spark, t)
    land(spark, config, RUN_TS, DEMO_KEY)
    return _told(spark, config)


@query(
    "landing_run_failed",
    f"""select * from (with r as (
          select n, status, attempt from (select count(*) as n from {{orders}}) o,
            (values ('Starting...', 1), ('running', 1), ('failed', 1), ('Starting...', 2), ('running', 2), ('success', 2)) s(status, attempt))
          {INGESTION}, attempt = 2 as resumed from r) a
        union all by name select * from (with r as (select 2 as attempt) {QUALITY}, true as resumed from r) b""",
)
def _landing_failed(spark, t):
    """A run that fails at the secured zone, and is taken up there by a second attempt: every state is recorded."""
    config = protected_settings(spark, t, record_states=True)
    try:
        land(spark, config, RUN_TS, None)  # hashed columns need a key
    except ValueError:
        report = land(spark, config, RUN_TS, DEMO_KEY)
    return _told(spark, config).withColumn("resumed", (F.col("no_of_retries") == report.attempt) & F.lit(report.resumed))


@query(
    "landing_reports",
    f"""
    with p as (select row_id, "int", case when masterCard is null then null else {hmac_sql('masterCard')} end as masterCard from ({COMPLEX_TYPES}) c)
    select 'row_id' as column_name, count(*) as row_count, count(*) - count(row_id) as null_count, count(distinct row_id) as distinct_count,
      cast(min(row_id) as varchar) as min_value, cast(max(row_id) as varchar) as max_value from p
    union all select 'int', count(*), count(*) - count("int"), count(distinct "int"), cast(min("int") as varchar), cast(max("int") as varchar) from p
    union all select 'masterCard', count(*), count(*) - count(masterCard), count(distinct masterCard), min(masterCard), max(masterCard) from p
    """,
)
def _landing_reports(spark, t):
    """The stored profile, found by the path in the run's quality record."""
    config = protected_settings(spark, t)
    land(spark, config, RUN_TS, DEMO_KEY)
    path = read_audit(spark, config.audit_path).where("profiling_path is not null").first()["profiling_path"]
    return spark.read.parquet(path).select("column_name", "row_count", "null_count", "distinct_count", "min_value", "max_value")


FIRST_LOAD = "ts <= timestamp '2024-01-15' and event_id % 50 <> 7"


@query(
    "landing_incremental",
    f"""select * from {{events}} where ({FIRST_LOAD})
        or ts >= (select max(ts) from {{events}} where {FIRST_LOAD}) - interval 1 day""",
)
def _landing_incremental(spark, t):
    """Two loads by the stored value. Rows that tie with it or lie up to a day below it come late, and are not lost."""
    base = run_folder(spark, "incremental")
    schema = t.events.schema
    state = StateTable(spark, f"{base}/state")
    state.replace(spark.createDataFrame([("7", "false", None)], "asset_id string, is_processed string, incremental_column_value string"))
    config = settings(
        base,
        "7",
        schema=schema,
        dw_load_ind="True",
        incremental_column="ts",
        incremental_overlap="interval 1 day",
        state_path=f"{base}/state",
        ledger_path=f"{base}/ledger",
    )
    for hour, rows in ((0, t.events.where(FIRST_LOAD)), (1, t.events)):
        sink_csv(rows, f"{base}/raw")
        land(spark, config, RUN_TS.replace(hour=hour))
    return spark.read.parquet(config.warehouse_table).select(*schema.names)


@query(
    "landing_rejected_inferred",
    """select count(*) as source_lines, count(*) filter (where o_orderkey % 10 <> 3) as destination_records,
         count(*) filter (where o_orderkey % 10 in (3, 4)) as rejected, count(*) filter (where o_orderkey % 10 in (3, 4)) = 0 as match,
         case when count(*) filter (where o_orderkey % 10 in (3, 4)) = 0 then 'Ingestion_success' else 'Ingestion_failed' end as job_status
       from {orders}""",
)
def _landing_rejected_inferred(spark, t):
    """Without a schema too: fields too many are kept apart, and a split record shows in the count by quotes."""
    base = run_folder(spark, "rejected")
    line = (
        F.when(F.col("o_orderkey") % 10 == 3, F.array(F.concat_ws(",", "o_orderkey", "o_orderstatus", F.lit("more"))))
        .when(F.col("o_orderkey") % 10 == 4, F.array(F.concat("o_orderkey", F.lit(',"a')), F.lit('b"')))
        .otherwise(F.array(F.concat_ws(",", "o_orderkey", "o_orderstatus")))
    )
    lines = t.orders.select(F.explode(line).alias("o_orderkey,o_orderstatus"))
    # Each line as it is: neither comma nor quote means anything to this writer.
    lines.write.option("header", True).option("sep", "\u0001").option("quote", "\u0002").csv(f"{base}/raw")
    config = settings(base, "1002")
    report = land(spark, config, RUN_TS)
    return read_audit(spark, config.audit_path).select(
        F.lit(report.source_lines).cast("bigint").alias("source_lines"),
        F.lit(report.counts.destination_records).cast("bigint").alias("destination_records"),
        F.lit(spark.read.text(f"{report.landing}_rejected").count()).cast("bigint").alias("rejected"),
        F.lit(report.counts.match).alias("match"),
        "job_status",
    )
