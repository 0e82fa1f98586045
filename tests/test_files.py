"""CSV edge cases, counts by file, and sinks."""

import datetime as dt
import os

import pytest

from quayside.operators import counts
from quayside.sinks.files import sink_csv, sink_format, sink_observed, sink_partitioned
from quayside.sinks.warehouse import sink_warehouse_gated
from quayside.sources.files import scan_csv


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as out:
        out.write(text)
    return path


def records(df):
    return df.first()["records"]


def test_quoted_newline_needs_multi_line(spark, folder):
    put(f"{folder}/in/a.csv", 'id,text\n1,one\n2,"two\nlines"\n\n3,three\n')
    whole = scan_csv(spark, f"{folder}/in", "id int, text string", multi_line=True)
    assert sorted((r["id"], r["text"]) for r in whole.collect()) == [(1, "one"), (2, "two\nlines"), (3, "three")]
    # Line counts see the quoted newline as one more line, and no empty line.
    assert records(counts.count_csv_records(spark, f"{folder}/in")) == 4


def test_spaces_and_returns_are_lines(spark, folder):
    put(f"{folder}/in/a.csv", "id\n1\n   \n\n2\r\n\r\n")
    assert records(counts.count_csv_records(spark, f"{folder}/in")) == 4


def test_header_in_another_order_raises_with_a_schema(spark, folder):
    put(f"{folder}/in/b1.csv", "a,b\n1,2\n")
    put(f"{folder}/in/b2.csv", "b,a\n3,4\n")
    with pytest.raises(Exception, match="(?i)header"):
        scan_csv(spark, f"{folder}/in", "a int, b int").collect()


def test_corrupt_lines_are_kept_on_request(spark, folder):
    put(f"{folder}/in/a.csv", "a,b\n1,2\nx,3\n")
    rows = scan_csv(spark, f"{folder}/in", "a int, b int", keep_corrupt=True).collect()
    assert [(r["a"], r["b"]) for r in rows if r["_corrupt_record"] is None] == [(1, 2)]
    assert [r["_corrupt_record"] for r in rows if r["_corrupt_record"]] == ["x,3"]


def test_inferred_types(spark, folder):
    put(
        f"{folder}/in/t.csv",
        "i,l,d,b,day,ts,s\n1,3000000000,1.5,true,2024-01-02,2024-01-02 03:04:05,x\n",
    )
    kinds = dict(scan_csv(spark, f"{folder}/in").dtypes)
    assert kinds == {
        "i": "int",
        "l": "bigint",
        "d": "double",
        "b": "boolean",
        "day": "date",
        "ts": "timestamp",
        "s": "string",
    }


def test_header_only(spark, folder):
    put(f"{folder}/in/h.csv", "a,b\n")
    assert scan_csv(spark, f"{folder}/in").count() == 0
    assert records(counts.count_csv_records(spark, f"{folder}/in")) == 0


def test_mixed_zone_counts(spark, folder):
    put(f"{folder}/in/x/a.csv", "a\n1\n2\n")
    put(f"{folder}/in/y/z/b.csv", "a\n3\n")
    put(f"{folder}/in/y/part.txt", "a\n1\n2\n3\n")
    sink_format(spark.range(7), f"{folder}/in/p", "parquet")
    assert records(counts.count_folder(spark, f"{folder}/in", "gcs_to_gcs")) == 10
    assert records(counts.count_folder(spark, f"{folder}/in/x", "gcs_to_gcs_dataproc")) == 2
    assert records(counts.count_folder(spark, f"{folder}/in/x", "rdbms_to_gcs", parent=True)) == 10
    assert records(counts.count_folder(spark, f"{folder}/in", "rdbms_to_bq")) is None
    by_file = {r["file_path"].rsplit("/", 1)[1]: r["records"] for r in counts.count_by_file(spark, f"{folder}/in").where("format = 'csv'").collect()}
    assert by_file == {"a.csv": 2, "b.csv": 1}


def test_empty_zone_counts_zero(spark, folder):
    os.makedirs(f"{folder}/empty")
    assert records(counts.count_folder(spark, f"{folder}/empty", "gcs_to_gcs")) == 0


def test_window_counts_only_warehouse_tasks(spark):
    rows = spark.range(10).selectExpr("timestamp_ntz'2024-01-01' + make_interval(0,0,0,cast(id as int)) insertion_timestamp")
    args = (rows, "2024-01-02", "2024-01-04")
    assert records(counts.count_window(*args, "rdbms_to_bigquery_dataproc")) == 3
    assert records(counts.count_window(*args, "gcs_to_gcs")) is None


def test_parquet_count_reads_no_column(spark, folder):
    sink_format(spark.range(100).selectExpr("id", "id as b"), f"{folder}/p", "parquet")
    plan = counts.parquet_row_counts(spark, f"{folder}/p")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_filter_reaches_the_scan(spark, folder):
    from quayside.operators.filters import filter_between, filter_eq
    from quayside.operators.incremental import filter_incremental

    path = f"{folder}/p"
    spark.range(10).selectExpr("id", "timestamp_ntz'2024-01-01' ts", "'x' name").write.parquet(path)
    df = spark.read.parquet(path)
    for made in (
        filter_between(df, "ts", "2024-01-01", "2024-01-02"),
        filter_incremental(df, "ts", "2023-01-01"),
        filter_eq(df, "name", "x"),
    ):
        plan = made.select("id")._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [IsNotNull(" in plan
        assert "ReadSchema: struct<id:bigint,ts:timestamp_ntz>" in plan or "ReadSchema: struct<id:bigint,name:string>" in plan


def test_text_sinks_keep_microseconds(spark, folder):
    rows = spark.sql("select 1 id, timestamp_ntz'2024-01-01 00:00:00.123456' n, timestamp'2024-01-01 00:00:00.654321' t")
    for fmt in ("csv", "json"):
        path = sink_format(rows, f"{folder}/{fmt}", fmt)
        back = spark.read.format(fmt).schema(rows.schema).option("header", True).load(path)
        assert back.collect() == rows.collect()


def test_observed_counts(spark, folder):
    rows = spark.range(1234)
    assert sink_observed(rows, f"{folder}/a") == 1234
    assert sink_observed(rows, f"{folder}/b", "parquet", strict=True) == 1234


def test_gate_is_exact(spark, folder):
    rows = spark.range(3)
    assert [sink_warehouse_gated(rows, f"{folder}/w", f) for f in ("True", "true", "False", "", "True")] == [
        True,
        False,
        False,
        False,
        True,
    ]
    assert spark.read.parquet(f"{folder}/w").count() == 6


def test_partitions_of_a_hot_value_are_split(spark, folder):
    rows = spark.range(9000).selectExpr("if(id % 3 = 0, 'hot', concat('v', id % 5)) v", "id")
    # At this size adaptive execution would merge the few small tasks again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sink_partitioned(rows, f"{folder}/p", ["v"], files_per_value=4)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = [f for f in os.listdir(f"{folder}/p/v=hot") if f.endswith(".parquet")]
    assert len(files) > 1
    assert spark.read.parquet(f"{folder}/p").count() == 9000


def test_unknown_format(spark, folder):
    with pytest.raises(ValueError, match="xml"):
        sink_format(spark.range(1), f"{folder}/x", "xml")


def test_csv_null_and_empty_text(spark, folder):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "x")], "id int, s string")
    back = scan_csv(spark, sink_csv(rows, f"{folder}/c"), rows.schema)
    assert sorted((r["id"], r["s"]) for r in back.collect() if r["s"]) == [(3, "x")]
    assert back.count() == 3


def test_load_timestamp(spark):
    from quayside.sinks.warehouse import add_load_timestamp

    when = dt.datetime(2024, 5, 6, 7, 8, 9, 10)
    assert add_load_timestamp(spark.range(1), when).first()["insertion_timestamp"] == when
