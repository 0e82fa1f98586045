"""Streams: every row once, over restarts and new files."""

import datetime as dt

from quayside.streaming.ingest import read_batches, read_stream_audit, stream_audit, stream_files, stream_ingest

RUN_TS = dt.datetime(2024, 6, 1, 12, 0, 0)


def put(spark, folder, start, stop):
    spark.range(start, stop).selectExpr("id", "concat('v', id) v").coalesce(1).write.mode("append").parquet(f"{folder}/in")


def source(spark, folder):
    schema = spark.range(0).selectExpr("id", "concat('v', id) v").schema
    return stream_files(spark, f"{folder}/in", schema, files_per_batch=1)


def test_restart_adds_only_new_files(spark, folder):
    seen = []
    for start, stop in ((0, 10), (10, 10), (10, 25)):
        if stop > start:
            put(spark, folder, start, stop)
        stream_ingest(source(spark, folder), f"{folder}/out", f"{folder}/cp", {"v": "redact"}).awaitTermination()
        seen.append(spark.read.parquet(f"{folder}/out").count())
    assert seen == [10, 10, 25]
    assert {r["v"] for r in spark.read.parquet(f"{folder}/out").collect()} == {"[REDACTED]"}


def test_one_record_for_each_batch(spark, folder):
    sizes = [(0, 3), (3, 8), (8, 20)]
    for start, stop in sizes:
        put(spark, folder, start, stop)
    for _ in range(2):
        stream_audit(
            source(spark, folder), f"{folder}/out", f"{folder}/audit", f"{folder}/cp", RUN_TS, job_type="dataflow"
        ).awaitTermination()
    records = read_stream_audit(spark, f"{folder}/audit").orderBy("batch_id").collect()
    assert sorted(r["batch_records"] for r in records) == [3, 5, 12]
    assert {r["job_status"] for r in records} == {"Streaming"}
    assert {r["destination"] for r in records} == {f"{folder}/out"}
    assert read_batches(spark, f"{folder}/out").count() == 20


def test_repeated_batch_changes_nothing(spark, folder):
    put(spark, folder, 0, 7)
    for checkpoint in ("a", "b"):  # a lost checkpoint: the same batch is written again
        stream_audit(
            source(spark, folder), f"{folder}/out", f"{folder}/audit", f"{folder}/{checkpoint}", RUN_TS
        ).awaitTermination()
    assert read_batches(spark, f"{folder}/out").count() == 7
    assert read_stream_audit(spark, f"{folder}/audit").count() == 1
