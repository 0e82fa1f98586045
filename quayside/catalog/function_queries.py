"""Filters, stage choice, paths and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quayside.catalog.fixtures import TASK_RUNS
from quayside.catalog.registry import query
from quayside.functions import paths, scalars
from quayside.operators.filters import filter_between, filter_blank_lines, filter_eq, filter_suffix, split_lines
from quayside.operators.incremental import filter_incremental, next_watermark
from quayside.plans.stages import stage_plan


def text_of(ts: str) -> str:
    """SQL for a time as text, with a fraction only where there is one."""
    return (
        f"(case when date_trunc('second', {ts}) = {ts} then strftime({ts}, '%Y-%m-%d %H:%M:%S') "
        f"else strftime({ts}, '%Y-%m-%d %H:%M:%S.%f') end)"
    )


# --- filters ----------------------------------------------------------------------------------


@query("filter_eq", "select * from {customer} where c_mktsegment = 'BUILDING'")
def _filter_eq(spark, t):
    return filter_eq(t.customer, "c_mktsegment", "BUILDING")


@query(
    "filter_between",
    "select * from {orders} where o_orderdate between timestamp '1996-01-01' and timestamp '1996-06-30'",
)
def _filter_between(spark, t):
    return filter_between(t.orders, "o_orderdate", "1996-01-01", "1996-06-30")


@query(
    "filter_blank_lines",
    """
    select doc_id, cast(line_no as int) as line_no, line
    from (select doc_id, unnest(string_split(text, chr(10))) as line,
            generate_subscripts(string_split(text, chr(10)), 1) as line_no from {documents}) d
    where line <> ''
    """,
)
def _filter_blank_lines(spark, t):
    return filter_blank_lines(split_lines(t.documents, "doc_id", "text"))


@query("filter_suffix", "select page_id, url from {pages} where url like '%.html' or url like '%#top'")
def _filter_suffix(spark, t):
    return filter_suffix(t.pages.select("page_id", "url"), "url", ".html", "#top")


@query("filter_incremental", "select * from {events} where ts > timestamp '2024-01-10 12:00:00'")
def _filter_incremental(spark, t):
    return filter_incremental(t.events, "ts", "2024-01-10 12:00:00")


@query(
    "next_watermark",
    "select max(ts) as incremental_column_value from {events} where ts > timestamp '2024-01-10 12:00:00'",
)
def _next_watermark(spark, t):
    loaded = filter_incremental(t.events, "ts", "2024-01-10 12:00:00")
    return next_watermark(loaded, "ts", "2024-01-10 12:00:00")


@query(
    "next_watermark_unchanged",
    """select coalesce(max(ts), timestamp '2030-01-01') as incremental_column_value
       from {events} where ts > timestamp '2030-01-01'""",
)
def _next_watermark_unchanged(spark, t):
    return next_watermark(filter_incremental(t.events, "ts", "2030-01-01"), "ts", "2030-01-01")


# --- stages and paths -------------------------------------------------------------------------

FLAGS = """
select doc_id, case when quality = 1 then 'True' when doc_id % 11 = 0 then 'true' else 'False' end as token_flag,
 case when toxic = 1 then 'False' else 'True' end as check_flag from {labels}
"""


@query(
    "stage_plan",
    f"""
    select doc_id, case
      when token_flag = 'True' and check_flag = 'True'
        then 'TOKENIZATION_JOB' || doc_id || ',DQ' || doc_id || ',DELETE_DATAPROC_CLUSTER'
      when token_flag = 'False' and check_flag = 'True' then 'DQ' || doc_id || ',DELETE_DATAPROC_CLUSTER'
      when token_flag = 'True' and check_flag = 'False'
        then 'TOKENIZATION_JOB' || doc_id || ',DELETE_DATAPROC_CLUSTER'
      else 'DELETE_DATAPROC_CLUSTER' end as stages
    from ({FLAGS}) f
    """,
)
def _stage_plan(spark, t):
    stages = stage_plan(F.col("token_flag"), F.col("check_flag"), F.col("doc_id").cast("string"))
    return t.sql(FLAGS).select("doc_id", F.array_join(stages, ",").alias("stages"))


@query(
    "select_dq_source",
    f"""
    select doc_id, case when token_flag = 'True'
      then 'store://secured/dlp_output/dataproc/' || doc_id || '/*.csv'
      else 'store://landing/dataproc/' || doc_id || '/*.csv' end as dq_source
    from ({FLAGS}) f
    """,
)
def _select_dq_source(spark, t):
    landing = F.concat(F.lit("store://landing/dataproc/"), F.col("doc_id").cast("string"))
    source = paths.quality_source(F.col("token_flag"), landing, "store://landing", "store://secured")
    return t.sql(FLAGS).select("doc_id", source.alias("dq_source"))


@query(
    "derive_paths",
    f"""
    select run_id,
      'store://landing/dataproc/' || asset_id || '_' || strftime(execution_date, '%Y%m%dT%H%M%S') as landing,
      'store://secured/dlp_output/dataproc/' || asset_id || '_' || strftime(execution_date, '%Y%m%dT%H%M%S') as secured,
      'store://landing/dataproc/' || source_name || lower(group_name) || strftime(execution_date, '%Y%m%dT%H%M%S')
        || '/' as item
    from ({TASK_RUNS}) r
    """,
)
def _derive_paths(spark, t):
    zone, when = "store://landing", F.col("execution_date")
    landing = paths.landing_folder(zone, F.col("asset_id"), when)
    return t.sql(TASK_RUNS).select(
        "run_id",
        landing.alias("landing"),
        paths.secured_folder(landing, zone, "store://secured").alias("secured"),
        paths.item_folder(zone, F.col("source_name"), F.col("group_name"), when).alias("item"),
    )


@query("path_bucket", "select page_id, nullif(regexp_extract(url, '//([^/]+)', 1), '') as bucket from {pages}")
def _path_bucket(spark, t):
    return t.pages.select("page_id", paths.path_bucket(F.col("url")).alias("bucket"))


@query(
    "path_prefix",
    """select page_id, case when substr(rest, strpos(rest, '/') + 1) = '' then ''
         else substr(rest, strpos(rest, '/') + 1) || '/' end as prefix
       from (select page_id, substr(url, strpos(url, '//') + 2) as rest from {pages}) p""",
)
def _path_prefix(spark, t):
    return t.pages.select("page_id", paths.path_prefix(F.col("url")).alias("prefix"))


@query("path_parent", "select page_id, regexp_replace(url, '/[^/]*$', '') as parent from {pages}")
def _path_parent(spark, t):
    return t.pages.select("page_id", paths.path_parent(F.col("url")).alias("parent"))


# --- scalars ----------------------------------------------------------------------------------


@query(
    "audit_id",
    "select event_id, strftime(ts, '%Y%m%d%H%M%S') || 'dag' || event_type as audit_id from {events}",
)
def _audit_id(spark, t):
    made = scalars.audit_id(F.col("ts"), F.lit("dag"), F.col("event_type"))
    return t.events.select("event_id", made.alias("audit_id"))


@query(
    "log_url",
    f"""select event_id, '/graph?dag_id=' || event_type || '&root=&execution_date='
        || url_encode({text_of('ts')} || '+00:00') as log_url from {{events}}""",
)
def _log_url(spark, t):
    return t.events.select("event_id", scalars.log_url(F.col("event_type"), F.col("ts")).alias("log_url"))


@query(
    "parse_task_ts",
    """select event_id, ts as with_fraction, date_trunc('second', ts) as whole,
       try_cast(event_type as timestamp) as not_a_time from {events}""",
)
def _parse_task_ts(spark, t):
    second = F.date_trunc("second", "ts").cast("timestamp_ntz")
    fraction = F.concat(scalars.ts_text(F.col("ts")), F.lit("+00:00"))
    whole = F.concat(scalars.ts_text(second), F.lit("+05:30"))
    return t.events.select(
        "event_id",
        scalars.parse_task_ts(fraction).alias("with_fraction"),
        scalars.parse_task_ts(whole).alias("whole"),
        scalars.parse_task_ts(F.col("event_type")).alias("not_a_time"),
    )


@query(
    "task_duration",
    """select event_id, (epoch_us(ts) - epoch_us(date_trunc('hour', ts))) / 1e6 as seconds from {events}""",
)
def _task_duration(spark, t):
    start = F.date_trunc("hour", "ts")
    return t.events.select("event_id", scalars.task_seconds(start, F.col("ts")).alias("seconds"))


@query("ingestion_date", "select event_id, strftime(ts, '%Y-%m-%d') as ingestion_date from {events}")
def _ingestion_date(spark, t):
    return t.events.select("event_id", scalars.ingestion_date(F.col("ts")).alias("ingestion_date"))


@query("ts_nodash", "select event_id, strftime(ts, '%Y%m%dT%H%M%S') as stamp from {events}")
def _ts_nodash(spark, t):
    return t.events.select("event_id", paths.ts_nodash(F.col("ts")).alias("stamp"))


DRIVERS = """
select s_suppkey, case s_nationkey % 3 when 0 then 'org.postgresql.Driver' when 1 then 'com.mysql.cj.jdbc.Driver'
 else s_name end as driver_name from {supplier}
"""


@query(
    "driver_kind",
    f"""select s_suppkey, case when contains(driver_name, 'postgre') then 'postgresql'
        when contains(driver_name, 'mysql') then 'mysql' end as kind from ({DRIVERS}) d""",
)
def _driver_kind(spark, t):
    return t.sql(DRIVERS).select("s_suppkey", scalars.driver_kind(F.col("driver_name")).alias("kind"))


@query(
    "to_int",
    """select p_partkey, try_cast(substr(p_brand, 7) as int) as brand_number,
       try_cast(p_name as int) as not_a_number from {part}""",
)
def _to_int(spark, t):
    return t.part.select(
        "p_partkey",
        scalars.to_int(F.substr("p_brand", F.lit(7))).alias("brand_number"),
        scalars.to_int(F.col("p_name")).alias("not_a_number"),
    )


@query(
    "json_field",
    "select event_id, props->>'$.k' as k, props->>'$.missing' as missing from {events}",
)
def _json_field(spark, t):
    props = F.col("props")
    return t.events.select(
        "event_id", scalars.json_field(props, "$.k").alias("k"), scalars.json_field(props, "$.missing").alias("missing")
    )


@query(
    "json_record",
    """select event_id, cast(to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type}) as varchar)
       as record from {events}""",
)
def _json_record(spark, t):
    return t.events.select("event_id", scalars.json_record("event_id", "user_id", "event_type").alias("record"))


@query("lower_group", "select p_partkey, lower(p_brand) as group_name from {part}")
def _lower_group(spark, t):
    return t.part.select("p_partkey", scalars.lower_group(F.col("p_brand")).alias("group_name"))


@query("concat_job_type", "select p_partkey, p_type || ' gcs to gcs' as job_type from {part}")
def _concat_job_type(spark, t):
    return t.part.select("p_partkey", scalars.job_type_text(F.col("p_type"), F.lit("gcs to gcs")).alias("job_type"))
