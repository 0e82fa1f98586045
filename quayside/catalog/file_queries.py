"""Sources, sinks, counts, streams and whole runs: written to a run's own folder and read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quayside.catalog.fixtures import COMPLEX_TYPES
from quayside.catalog.registry import query
from quayside.functions.paths import SECURED_PARENT
from quayside.functions.tokens import hmac_pads
from quayside.operators.counts import (
    count_by_file,
    count_csv_records,
    count_folder,
    count_parquet_rows,
    count_query,
    count_rows,
    count_window,
    csv_quoted_counts,
    pair_counts,
    reconcile_counts,
)
from quayside.operators.reconcile import SUMS, hash_sums, reconcile_content, row_hashes
from quayside.operators.tokenize import apply_template
from quayside.plans.landing import RunConfig, land, verdict
from quayside.session import run_folder
from quayside.sinks.file_manifest import check_manifest, write_with_manifest
from quayside.sinks.files import FORMATS, read_options, sink_csv, sink_format, sink_observed, sink_partitioned
from quayside.sinks.planned import sink_planned
from quayside.sinks.state import StateTable, mark_processed, store_watermark
from quayside.sinks.warehouse import add_load_timestamp, sink_warehouse_gated
from quayside.sources.files import scan_csv, scan_csv_glob, scan_parquet, scan_staged
from quayside.sources.tables import LOAD_TS, lookup_config, scan_warehouse
from quayside.streaming.ingest import read_batches, read_stream_audit, stream_audit, stream_files, stream_ingest

RUN_TS = dt.datetime(2024, 6, 1, 12, 0, 0)
DEMO_KEY = b"quayside demonstration key"


def hmac_sql(value: str, key: bytes = DEMO_KEY) -> str:
    inner, outer = (pad.hex() for pad in hmac_pads(key))
    return f"sha256(from_hex('{outer}') || from_hex(sha256(from_hex('{inner}') || encode({value}))))"


# --- sources ----------------------------------------------------------------------------------


@query("scan_csv", "select * from {orders}")
def _scan_csv(spark, t):
    path = sink_csv(t.orders, run_folder(spark, "scan-csv"))
    return scan_csv(spark, path, t.orders.schema)


@query(
    "scan_csv_inferred",
    "select cast(s_suppkey as int) as s_suppkey, s_name, s_nationkey, s_acctbal from {supplier}",
)
def _scan_csv_inferred(spark, t):
    return scan_csv(spark, sink_csv(t.supplier, run_folder(spark, "scan-inferred")))


@query("scan_csv_glob", "select * from {customer}")
def _scan_csv_glob(spark, t):
    path = sink_csv(t.customer.repartition(4, "c_custkey"), run_folder(spark, "scan-glob"))
    return scan_csv_glob(spark, path, t.customer.schema)


@query("scan_parquet", "select * from {lineitem}")
def _scan_parquet(spark, t):
    return scan_parquet(spark, f"{t.folder}/lineitem.parquet")


@query("scan_recursive", "select * from {orders}")
def _scan_recursive(spark, t):
    """Folders at two depths; their names are no columns here, so the values stand in the files too."""
    path = run_folder(spark, "scan-recursive")
    foldered = t.orders.withColumns({"by_status": F.col("o_orderstatus"), "by_priority": F.col("o_orderpriority")})
    sink_partitioned(foldered, path, ["by_status", "by_priority"], "csv")
    return scan_csv(spark, path, t.orders.schema, recursive=True, glob="*.csv")


@query("scan_staged", "select * from {supplier}")
def _scan_staged(spark, t):
    path = run_folder(spark, "staged")
    sink_csv(t.supplier, f"{path}/2024/06")
    return scan_staged(spark, path, t.supplier.schema)


@query("scan_warehouse", "select *, timestamp '2024-06-01 12:00:00' as insertion_timestamp from {orders}")
def _scan_warehouse(spark, t):
    path = run_folder(spark, "warehouse")
    sink_warehouse_gated(add_load_timestamp(t.orders, RUN_TS), path, "True")
    return scan_warehouse(spark, path, "parquet")


CONFIG = """
select cast(s_nationkey as {text}) as cluster_code, concat('zone-', s_suppkey % 3) as zone,
 cast(2 + s_suppkey % 7 as int) as num_workers, s_suppkey as updated_at
from {{supplier}}
"""


def _newest_config(where: str = "") -> str:
    view = CONFIG.format(text="varchar")
    return f"""
    select cluster_code, zone, num_workers, updated_at from ({view}) c {where}
    qualify row_number() over (partition by cluster_code order by updated_at desc) = 1
    """


@query("lookup_config", _newest_config("where cluster_code = '7'"))
def _lookup_config(spark, t):
    return lookup_config(t.sql(CONFIG.format(text="string")), "cluster_code", "updated_at", "7")


@query("lookup_config_all", _newest_config())
def _lookup_config_all(spark, t):
    return lookup_config(t.sql(CONFIG.format(text="string")), "cluster_code", "updated_at")


@query("stream_files", "select * from {events}")
def _stream_files(spark, t):
    base = run_folder(spark, "stream-files")
    t.events.write.parquet(f"{base}/in")
    stream = stream_files(spark, f"{base}/in", t.events.schema)
    stream_ingest(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(t.events.schema).parquet(f"{base}/out")


# --- sinks ------------------------------------------------------------------------------------


@query("sink_csv", "select * from {lineitem}")
def _sink_csv(spark, t):
    path = sink_csv(t.lineitem, run_folder(spark, "sink-csv"))
    return scan_csv(spark, path, t.lineitem.schema)


@query("sink_warehouse_gated", "select * from {supplier} union all select * from {supplier}")
def _sink_warehouse(spark, t):
    path = run_folder(spark, "gated")
    for flag in ("True", "False", "True", "true"):
        sink_warehouse_gated(t.supplier, path, flag)
    return scan_warehouse(spark, path, "parquet")


@query("sink_format", " union all ".join(f"select '{f}' as format, * from {{part}}" for f in FORMATS))
def _sink_format(spark, t):
    out = None
    for fmt in FORMATS:
        path = sink_format(t.part, run_folder(spark, f"sink-{fmt}"), fmt)
        rows = spark.read.format(fmt).schema(t.part.schema).option("header", True).load(path)
        rows = rows.select(F.lit(fmt).alias("format"), "*")
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "sink_partitioned",
    "select * replace (case when l_returnflag = 'R' then l_quantity * 2 else l_quantity end as l_quantity) from {lineitem}",
)
def _sink_partitioned(spark, t):
    path = run_folder(spark, "partitioned")
    rows = t.lineitem
    sink_partitioned(rows, path, ["l_returnflag"])
    again = rows.where(F.col("l_returnflag") == "R").withColumn("l_quantity", F.col("l_quantity") * 2)
    sink_partitioned(again, path, ["l_returnflag"])
    return spark.read.schema(rows.schema).parquet(path)


SKEWED = "select *, case when l_orderkey % 3 = 0 then 'hot' else concat('k', l_suppkey) end as slot from {lineitem}"


@query("sink_planned", f"select l.*, true as sized from ({SKEWED}) l")
def _sink_planned(spark, t):
    """Whole rows by a skewed value, a third of them under one: no file is much larger than planned, and rare values have one."""
    rows, path = t.sql(SKEWED), run_folder(spark, "planned")
    target = max(rows.count() // 40, 1)
    plan = sink_planned(rows, path, ["slot"], rows_per_file=target)
    back = spark.read.schema(rows.schema).parquet(path)
    files = back.groupBy(F.col("_metadata.file_path").alias("file"), "slot").agg(F.count(F.lit(1)).alias("n"))
    sizes = files.groupBy("slot").agg(F.count(F.lit(1)).alias("files"), F.max("n").alias("largest")).join(plan, "slot")
    good = sizes.agg(F.min((F.col("files") <= F.col("pieces")) & (F.col("largest") <= 1.5 * target))).first()[0]
    return back.withColumn("sized", F.lit(good))


@query(
    "sink_secured_zone",
    f"select c_custkey, {hmac_sql('c_name')} as c_name, c_nationkey, c_acctbal, c_mktsegment from {{customer}}",
)
def _sink_secured(spark, t):
    path = f"{run_folder(spark, 'secured')}{SECURED_PARENT}/dataproc/customer_run"
    protected = apply_template(t.customer, {"c_name": "hash"}, DEMO_KEY)
    sink_csv(protected, path)
    return scan_csv_glob(spark, path, protected.schema)


STATE = """
select concat('asset_', s_suppkey) as asset_id,
 case when s_suppkey % 3 = 0 then 'true' else 'false' end as is_processed,
 'ts' as incremental_column, cast(s_acctbal as {text}) as incremental_column_value
from {{supplier}}
"""
STATE_RUNS = """
select concat('asset_', l_suppkey) as asset_id,
 case when l_quantity > 49 then 'false' else 'true' end as is_processed
from {lineitem}
"""


@query(
    "update_processed",
    f"""
    select s.asset_id, case when s.asset_id in (select asset_id from ({STATE_RUNS}) r where is_processed = 'false')
      then 'Success' else s.is_processed end as is_processed, s.incremental_column,
      case when s.asset_id = 'asset_1' then '2024-06-01' else s.incremental_column_value end as incremental_column_value
    from ({STATE.format(text="varchar")}) s
    """,
)
def _update_processed(spark, t):
    """Two writers start from the same version; the second finds the first one's commit and merges its own."""
    state = StateTable(spark, run_folder(spark, "state"))
    first = state.replace(t.sql(STATE.format(text="string")))
    marked = mark_processed(state.read(first), t.sql(STATE_RUNS))
    moved = store_watermark(state.read(first), "asset_1", "2024-06-01")
    state.replace(marked, base=first)
    state.replace(moved, base=first)
    return state.read()


@query("add_load_timestamp", "select *, timestamp '2024-06-01 12:00:00' as insertion_timestamp from {customer}")
def _add_load_timestamp(spark, t):
    return add_load_timestamp(t.customer, RUN_TS)


# --- counts -----------------------------------------------------------------------------------


@query("count_query", "select count(*) as records from (select * from {orders} where o_totalprice > 100000) a")
def _count_query(spark, t):
    return count_query(spark, "select * from {orders} where o_totalprice > 100000", orders=t.orders)


@query(
    "count_window",
    """select count(*) as records from {orders}
       where o_orderdate between timestamp '1996-01-01' and timestamp '1996-12-31'""",
)
def _count_window(spark, t):
    loaded = t.orders.withColumnRenamed("o_orderdate", LOAD_TS)
    return count_window(loaded, "1996-01-01", "1996-12-31", "rdbms_to_bq")


@query("count_csv_records", "select count(*) as records from {lineitem}")
def _count_csv(spark, t):
    return count_csv_records(spark, sink_csv(t.lineitem, run_folder(spark, "count-csv")))


@query("count_csv_scan", "select count(*) as records from {documents}")
def _count_csv_scan(spark, t):
    path = f"{run_folder(spark, 'count-quoted')}/in"
    t.documents.write.option("header", True).option("escape", '"').csv(path)
    quoted = spark.read.schema(t.documents.schema).option("header", True).option("multiLine", True)
    return count_rows(quoted.option("escape", '"').csv(path))


@query("count_csv_quoted", "select count(*) as records, cast(count(*) filter (where doc_id % 3 = 0) as bigint) as folded from {documents}")
def _count_csv_quoted(spark, t):
    """Records of texts with quoted line ends and quotes, counted from split files without parsing them."""
    folded = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit('\n"and", then\n\nmore "'))).otherwise(F.col("text"))
    path = sink_csv(t.documents.withColumn("text", folded), f"{run_folder(spark, 'count-folded')}/in")
    counts = csv_quoted_counts(spark, path)
    plain = csv_quoted_counts(spark, sink_csv(t.documents, f"{run_folder(spark, 'count-plain')}/in"))
    # Each folded text has three line ends more, which are no records.
    more = counts.agg(F.sum("line_count").alias("n")).first()["n"] - plain.agg(F.sum("line_count").alias("n")).first()["n"]
    return counts.agg(F.sum("records").alias("records"), F.lit(more // 3).cast("bigint").alias("folded"))


@query("count_parquet_rows", "select (select count(*) from {lineitem}) as records")
def _count_parquet(spark, t):
    return count_parquet_rows(spark, f"{t.folder}/lineitem.parquet")


BY_FOLDER = """
select o_orderstatus as folder, fmt as format, count(*) as records
from {orders}, (values ('csv'), ('parquet')) f(fmt) group by 1, 2
"""


@query("count_by_file", BY_FOLDER)
def _count_by_file(spark, t):
    path = run_folder(spark, "count-by-file")
    for fmt in ("csv", "parquet"):
        sink_partitioned(t.orders, f"{path}/{fmt}", ["o_orderstatus"], fmt)
    folder = F.regexp_extract("file_path", "o_orderstatus=([^/]+)", 1).alias("folder")
    return count_by_file(spark, path).groupBy(folder, "format").agg(F.sum("records").alias("records"))


MIXED = "select (select count(*) from {customer}) + (select count(*) from {supplier}) as records"


def _mixed_zone(spark, t) -> str:
    path = run_folder(spark, "mixed")
    sink_csv(t.customer, f"{path}/landed/csv")
    sink_format(t.supplier, f"{path}/landed/parquet", "parquet")
    sink_format(t.nation, f"{path}/landed/other", "json")
    return path


@query("count_landing", MIXED)
def _count_landing(spark, t):
    return count_folder(spark, f"{_mixed_zone(spark, t)}/landed", "gcs_to_gcs")


@query("count_source_folder", MIXED)
def _count_source(spark, t):
    return count_folder(spark, f"{_mixed_zone(spark, t)}/landed/csv", "gcs_to_gcs", parent=True)


@query("union_counts", "select 'csv' as format, count(*) as records from {customer} "
       "union all select 'parquet', count(*) from {supplier}")
def _union_counts(spark, t):
    counts = count_by_file(spark, f"{_mixed_zone(spark, t)}/landed")
    return counts.groupBy("format").agg(F.sum("records").alias("records"))


@query("observe_counts", "select count(*) as written, count(*) as recounted from {orders}")
def _observe(spark, t):
    base = run_folder(spark, "observe")
    written = sink_observed(t.orders, f"{base}/a")
    recounted = sink_observed(t.orders, f"{base}/b", "parquet", strict=True)
    return spark.range(1).select(F.lit(written).cast("bigint").alias("written"),
                                 F.lit(recounted).cast("bigint").alias("recounted"))


@query(
    "sink_manifest",
    "select count(*) as manifest_rows, count(*) as source_rows, true as same_content, cast(0 as bigint) as changed_files from {orders}",
)
def _sink_manifest(spark, t):
    """The rows of a write as its committed files tell them, and whether they hold what the source does."""
    path = f"{run_folder(spark, 'manifest')}/zone"
    manifest = write_with_manifest(t.orders, path, "csv")
    sums = F.struct(*SUMS).alias("sums")
    told = manifest.agg(*[F.sum(c).alias(c) for c in ("rows", *SUMS)]).select(F.lit("manifest").alias("side"), "rows", sums)
    own = t.orders.select(*row_hashes(t.orders, t.orders.columns)).agg(*hash_sums()).select(F.lit("source").alias("side"), "rows", sums)
    changed = check_manifest(spark, path, t.orders.schema, "csv").count()
    rows = lambda side: F.max(F.when(F.col("side") == side, F.col("rows"))).alias(f"{side}_rows")
    same = (F.count_distinct("sums") == 1).alias("same_content")
    return told.unionByName(own).agg(rows("manifest"), rows("source"), same, F.lit(changed).cast("bigint").alias("changed_files"))


@query(
    "reconcile_counts",
    """
    select coalesce(a.k, b.k) as o_orderpriority, coalesce(a.n, 0) as source_records,
      coalesce(b.n, 0) as destination_records, coalesce(a.n, 0) - coalesce(b.n, 0) as diff,
      coalesce(a.n, 0) = coalesce(b.n, 0) as match
    from (select o_orderpriority k, count(*) n from {orders} group by 1) a
    full join (select o_orderpriority k, count(*) n from {orders}
               where o_orderpriority <> '5-LOW' and (o_orderpriority <> '1-URGENT' or o_orderstatus <> 'P')
               group by 1) b on a.k = b.k
    """,
)
def _reconcile(spark, t):
    arrived = t.orders.where("o_orderpriority <> '5-LOW' and (o_orderpriority <> '1-URGENT' or o_orderstatus <> 'P')")
    return reconcile_counts(t.orders, arrived, "o_orderpriority")


@query(
    "reconcile_landing",
    """select o_orderstatus as folder, count(*) as source_records, count(*) filter (where arrived) as destination_records,
       count(*) filter (where not arrived) as diff, count(*) filter (where not arrived) = 0 as match
       from (select *, o_orderstatus <> 'P' or o_orderkey % 7 <> 0 as arrived from {orders}) o group by 1""",
)
def _reconcile_landing(spark, t):
    path = run_folder(spark, "reconcile")
    sink_partitioned(t.orders.where("o_orderstatus <> 'P' or o_orderkey % 7 <> 0"), path, ["o_orderstatus"], "csv")
    folder = F.regexp_extract("file_path", "o_orderstatus=([^/]+)", 1).alias("folder")
    landed = count_by_file(spark, path).groupBy(folder).agg(F.sum("records").alias("destination_records"))
    source = t.orders.groupBy(F.col("o_orderstatus").alias("folder")).agg(F.count(F.lit(1)).alias("source_records"))
    return pair_counts(source, landed, "folder")


ARRIVED = """
select o_orderkey, o_custkey, o_orderstatus, case when o_orderkey % 89 = 7 then o_totalprice + 1 else o_totalprice end as o_totalprice,
  o_orderdate, case when o_orderkey % 83 = 9 then null else o_orderpriority end as o_orderpriority
from {orders} where o_orderkey % 97 <> 5
union all select o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from {orders} where o_orderkey % 101 = 3
union all select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from {orders} where o_orderkey % 103 = 4
"""


@query(
    "reconcile_content",
    f"""
    with d as ({ARRIVED}), e as (
      select *, 'source' as side from (select * from {{orders}} except all select * from d) a
      union all select *, 'destination' from (select * from d except all select * from {{orders}}) b)
    , g as (select *, count(*) as copies from e group by all), k as (select o_orderkey, count(distinct side) as sides from g group by 1)
    select g.*, case when sides = 2 then 'changed' when side = 'source' then 'missing' else 'added' end as change from g join k using (o_orderkey)
    """,
)
def _reconcile_content(spark, t):
    """Orders that went missing, were changed, added or doubled on the way, found through digests of key buckets."""
    return reconcile_content(t.orders, t.sql(ARRIVED), ["o_orderkey"])


# --- streams ----------------------------------------------------------------------------------


@query("stream_ingest", f"select event_id, ts, user_id, {hmac_sql('event_type')} as event_type, value, props from {{events}}")
def _stream_ingest(spark, t):
    base = run_folder(spark, "stream-ingest")
    t.events.repartition(3, "event_id").write.parquet(f"{base}/in")
    schema = t.events.schema
    for _ in range(2):  # the second start finds nothing new
        stream = stream_files(spark, f"{base}/in", schema, files_per_batch=1)
        stream_ingest(stream, f"{base}/out", f"{base}/checkpoint", {"event_type": "hash"}, DEMO_KEY).awaitTermination()
    return spark.read.schema(schema).parquet(f"{base}/out")


@query(
    "stream_audit",
    """select 'Streaming' as job_status, 'dataflow Pubsub to gcs' as job_type, count(*) as batch_records,
       count(*) as written from {events}""",
)
def _stream_audit(spark, t):
    base = run_folder(spark, "stream-audit")
    t.events.repartition(3, "event_id").write.parquet(f"{base}/in")
    stream = stream_files(spark, f"{base}/in", t.events.schema, files_per_batch=1)
    stream_audit(
        stream, f"{base}/out", f"{base}/audit", f"{base}/checkpoint", RUN_TS, job_type="dataflow"
    ).awaitTermination()
    written = count_rows(read_batches(spark, f"{base}/out")).first()["records"]
    records = read_stream_audit(spark, f"{base}/audit").groupBy("job_status", "job_type")
    return records.agg(F.sum("batch_records").alias("batch_records"), F.lit(written).cast("bigint").alias("written"))


# --- whole runs -------------------------------------------------------------------------------

# The three checks of a live run.
LIVE_CHECKS = [
    "expect_column_values_to_be_null('masterCard')",
    "expect_column_to_exist('masterCard')",
    "expect_column_proportion_of_unique_values_to_be_between('masterCard',1,10)",
]


def _run(spark, t, **settings):
    base = run_folder(spark, "run")
    rows = t.sql(COMPLEX_TYPES)
    sink_csv(rows, f"{base}/raw")
    config = RunConfig(
        asset_id="1001",
        source_path=f"{base}/raw",
        landing_zone=f"{base}/landing",
        secured_zone=f"{base}/secured",
        audit_path=f"{base}/audit",
        warehouse_table=f"{base}/warehouse",
        schema=rows.schema,
        tokenization_check="True",
        data_quality_check="True",
        dw_load_ind="True",
        template={"masterCard": "hash"},
        suite=LIVE_CHECKS,
        **settings,
    )
    return config, land(spark, config, RUN_TS, DEMO_KEY)


@query(
    "landing_run",
    f"""select '1001' as asset_id, n as source_records, n as destination_records, n - n as diff, n = n as match,
       cast(3 as bigint) as evaluated, passed, 3 - passed as failed, 100::double * passed / 3 as success_pct
       from (select count(*) as n, cast((count(masterCard) = 0) as bigint) + 1
               + cast((count(distinct masterCard)::double / count(masterCard) between 1 and 10) as bigint) as passed
             from ({COMPLEX_TYPES}) c) r""",
)
def _landing_run(spark, t):
    return verdict(_run(spark, t)[1])


@query(
    "landing_run_tokens",
    f"""select row_id, "int", case when masterCard is null then null else {hmac_sql('masterCard')} end as masterCard
        from ({COMPLEX_TYPES}) c""",
)
def _landing_tokens(spark, t):
    report = _run(spark, t)[1]
    schema = t.sql(COMPLEX_TYPES).schema
    return scan_csv_glob(spark, report.secured, schema)


PADDED = """select c_custkey, case c_custkey % 8 when 0 then concat('  ', c_name) when 1 then concat(c_name, '  ')
  when 2 then '' when 3 then null when 4 then concat(c_name, chr(13), 'x') when 5 then chr(1) when 6 then chr(13)
  else concat(' ', c_name, ' ') end as padded from {customer}"""


@query("sink_csv_padded", PADDED)
def _sink_csv_padded(spark, t):
    """Blanks at either end, carriage returns, empty texts and missing values come back as what they were."""
    rows = t.sql(PADDED)
    path = sink_csv(rows, run_folder(spark, "padded"))
    return spark.read.schema(rows.schema).options(**read_options("csv")).csv(path)


def _plain_run(spark, base, schema):
    config = RunConfig(
        asset_id="1002",
        source_path=f"{base}/raw",
        landing_zone=f"{base}/landing",
        secured_zone=f"{base}/secured",
        audit_path=f"{base}/audit",
        warehouse_table=f"{base}/warehouse",
        schema=schema,
        dw_load_ind="True",
    )
    return config, land(spark, config, RUN_TS)


@query(
    "landing_rejected",
    """select count(*) filter (where o_orderkey % 10 <> 3) as source_records,
       count(*) filter (where o_orderkey % 10 <> 3) as destination_records,
       count(*) filter (where o_orderkey % 10 = 3) as rejected, count(*) filter (where o_orderkey % 10 = 3) = 0 as match,
       max(case when o_orderkey % 10 = 3 then 'Ingestion_failed' else 'Ingestion_' end) as job_status from {orders}""",
)
def _landing_rejected(spark, t):
    """Lines that do not fit the schema are kept apart and counted, and the run is no match."""
    base = run_folder(spark, "rejected")
    broken = F.when(F.col("o_orderkey") % 10 == 3, "xx").otherwise(F.col("o_orderkey").cast("string"))
    sink_csv(t.orders.withColumn("o_orderkey", broken), f"{base}/raw")
    config, report = _plain_run(spark, base, t.orders.schema)
    values = {
        "source_records": (report.counts.source_records, "bigint"),
        "destination_records": (report.counts.destination_records, "bigint"),
        "rejected": (spark.read.text(f"{report.landing}_rejected").count(), "bigint"),
        "match": (report.counts.match, "boolean"),
    }
    stored = spark.read.parquet(config.audit_path)
    return stored.select(*(F.lit(v).cast(kind).alias(n) for n, (v, kind) in values.items()), "job_status")


@query("landing_rerun", "select * from {orders} where o_orderkey % 2 = 0")
def _landing_rerun(spark, t):
    """A run that is repeated over a smaller source leaves that source's rows alone in the warehouse."""
    base = run_folder(spark, "rerun")
    rows = t.orders
    for source in (rows, rows.where("o_orderkey % 2 = 0")):
        sink_csv(source, f"{base}/raw")
        config, report = _plain_run(spark, base, rows.schema)
    return spark.read.parquet(config.warehouse_table).select(rows.columns)
