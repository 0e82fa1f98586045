"""Files that keep arriving: protected row by row, written, and recorded batch by batch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quayside.operators.audit import STREAMING, audit_record
from quayside.operators.tokenize import apply_row_template


def stream_files(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    """A folder of files as a stream; other formats and topics by ``fmt`` and ``options``."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def stream_ingest(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    template: Mapping[str, object] | None = None,
    key: bytes | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Protect and append all files that are there now, each exactly once over restarts."""
    rows = apply_row_template(stream, template, key) if template else stream
    return (
        rows.writeStream.format(fmt)
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(availableNow=True)
        .start()
    )


def stream_audit(
    stream: DataFrame,
    path: str,
    audit_path: str,
    checkpoint: str,
    run_ts: dt.datetime,
    template: Mapping[str, object] | None = None,
    key: bytes | None = None,
    **constants: str,
) -> StreamingQuery:
    """As :func:`stream_ingest`, with one audit record for each batch that holds its real count.

    A batch writes its own folder and then its own record, both over what an interrupted try left,
    so a repeated batch changes nothing. The count is taken from the written files' footers.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = apply_row_template(batch, template, key) if template else batch
        folder = f"{path}/batch_id={batch_id}"
        rows.write.mode("overwrite").parquet(folder)
        spark = batch.sparkSession
        written = spark.read.schema(rows.schema).parquet(folder).agg(F.count(F.lit(1)).alias("batch_records"))
        now = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
        run = written.select(
            "batch_records",
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            F.lit("running").alias("state"),
            now.alias("execution_date"),
            now.alias("start_date"),
            F.lit(None).cast("timestamp_ntz").alias("end_date"),
            F.lit(1).alias("try_number"),
            *[F.lit(v).alias(n) for n, v in {"dag_id": "stream", "source_name": "", **constants}.items()],
        )
        record = audit_record(run, "stream_to_files", run_ts, keep=("batch_id", "batch_records"), destination=path)
        record.write.mode("overwrite").parquet(f"{audit_path}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The rows that all batches wrote, with their ``batch_id``."""
    return spark.read.parquet(path)


def read_stream_audit(spark: SparkSession, audit_path: str) -> DataFrame:
    """The batch records."""
    return spark.read.parquet(audit_path).drop("batch")


__all__ = ["STREAMING", "read_batches", "read_stream_audit", "stream_audit", "stream_files", "stream_ingest"]
