"""Spark session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}
_TABLES: dict[int, tuple] = {}  # written tables by the frame that reads them

# Binary literals of 16 bytes and more (token keys and their pads) never reach plan text or event logs.
KEY_REDACTION = "(?i)(0x)?[0-9a-f]{32,}"


def build_session(master: str | None = None, app: str = "quayside", **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Shuffle partition numbers are left to the cluster: adaptive execution merges small ones and
    splits skewed ones at run time.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.redaction.string.regex", KEY_REDACTION)
        # Plans with hundreds of expressions are put together twice as fast without call sites.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; on one machine a new folder where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="quayside-")
    return _LOCAL_FOLDERS[context.applicationId]


def run_folder(spark: SparkSession, label: str) -> str:
    """A new folder in the shared folder, for one run alone; it goes when the driver ends.

    What must outlive the driver belongs into a folder of the caller's.
    """
    path = f"{shared_folder(spark)}/quayside/{label}-{uuid.uuid4()}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return path


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage in a way that outlives lost executors, and fixes columns that a recomputed
    partition could give differently.
    """
    path = f"{run_folder(df.sparkSession, label)}/table"
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _TABLES[id(table)] = (weakref.ref(table), path)
    return table


def release(*tables: DataFrame) -> None:
    """Remove tables that :func:`durable` gave, when nothing will read them any more."""
    for table in tables:
        known, path = _TABLES.pop(id(table), (lambda: None, None))
        if known() is table:
            folder = table.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def together(*works: Callable[[], object]) -> list:
    """What the works give, run side by side: Spark jobs that do not wait for each other fill gaps of small stages.

    All of them end before this does; the first error is raised.
    """
    with ThreadPoolExecutor(len(works)) as pool:
        return [future.result() for future in [pool.submit(work) for work in works]]
