"""The append-only audit table: one stored row for each attempt that was recorded.

Records lie in folders by date and, in those, by batch. A commit names the folders of one batch, so an
append looks only at folders of its own dates, and readers see whole batches only. Compaction swaps all
folders of a date for one by a commit that names both; those that it lets go stay for readers that hold
an older list until ``vacuum`` removes them.

What tells records apart is given by whoever records: a run or attempt id. Content cannot be the
identity, since equal records of two runs are two records.

A batch is written to its place once, and whether it may stay is asked of its keys alone: whole records
are moved only where some of them must go.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.session import durable, release
from quayside.sinks.commits import CommitLog

RECORD_KEY = "record_key"  # half of the identity's digest
RECORD_ID = "record_id"  # the whole digest as text, in tables of before
DAY = "record_date"
BATCH = "record_batch"
NO_DAY = "none"
LIST_EVERY = 50  # every so many commits one holds the whole list, so that readers open no more than that
FILE_BYTES = 128 << 20  # what compaction puts into one file, and one task reads for it
CODEC = "zstd"


def _apply(live: dict[str, str], body: dict) -> dict[str, str]:
    for name in body.get("remove", ()):
        live.pop(name, None)
    live.update(body["add"])
    return live


def _key_of(digest: Column) -> Column:
    return F.unhex(F.substring(digest, 1, 32))


def _sums(keys: DataFrame, by: str) -> dict[str, tuple[int, ...]]:
    """What tells sets of keys apart without moving them: how many they are, and two sums of 64-bit hashes."""
    sums = [F.sum(F.xxhash64(F.lit(seed), RECORD_KEY).cast("decimal(20,0)")) for seed in (0, 1)]
    return {name: tuple(map(int, told)) for name, *told in keys.groupBy(by).agg(F.count(F.lit(1)), *sums).collect()}


def _total(sums: Iterable[tuple[int, ...]]) -> tuple[int, ...]:
    return tuple(map(sum, zip(*sums)))


class AuditLog:
    """The audit table under one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.commits = CommitLog(spark, f"{self.path}/_commits")

    def _live(self, newest: int) -> dict[str, str]:
        """Folders of the records that are live at a commit, with their days."""
        start = newest - newest % LIST_EVERY
        live = dict(self.commits.body(start)["all"]) if start else {}
        for number in range(start + 1, newest + 1):
            _apply(live, self.commits.body(number))
        return live

    def files(self, days: Sequence[str] | None = None, after: int = 0) -> list[str]:
        """Live folders, of some days only if they are named, or only those added after a commit."""
        newest = self.commits.newest()
        added = {name for n in range(after + 1, newest + 1) for name in self.commits.body(n)["add"]} if after else None
        live = self._live(newest).items()
        return sorted(name for name, day in live if (days is None or day in days) and (added is None or name in added))

    def _commit(self, number: int, body: dict) -> bool:
        if number % LIST_EVERY == 0:
            body = body | {"all": _apply(self._live(number - 1), body)}
        return self.commits.commit(number, body)

    def _read(self, files: Sequence[str]) -> DataFrame:
        return self.spark.read.option("mergeSchema", True).parquet(*(f"{self.path}/{name}" for name in files))

    def read(self) -> DataFrame:
        """All records; those of different profiles may have different fields."""
        files = self.files()
        if not files:
            raise LookupError(f"no audit records under {self.path}")
        return self._read(files).drop(RECORD_KEY, RECORD_ID)

    def _write(self, records: DataFrame, batch: str) -> dict[str, str]:
        """One folder of the new batch for each day; gives the folders with their days."""
        placed = records.withColumns({DAY: F.coalesce(F.col(DAY), F.lit(NO_DAY)), BATCH: F.lit(batch)})
        placed.write.mode("append").option("compression", CODEC).partitionBy(DAY, BATCH).parquet(self.path)
        names = self.commits.folders(f"{self.path}/{DAY}=*/{BATCH}={batch}")
        return {f"{day}/{BATCH}={batch}": unquote(day.partition("=")[2]) for day in (name.split("/")[-2] for name in names)}

    def _batch(self, added: Sequence[str], schema: T.StructType) -> DataFrame:
        """The records of a written batch, with their days."""
        reader = self.spark.read.schema(schema).option("basePath", self.path)
        return reader.parquet(*(f"{self.path}/{name}" for name in added)).select(*schema.names)

    def _keys(self, files: Sequence[str]) -> DataFrame:
        """``record_key, batch`` of stored records."""
        found = self._read(files)
        kinds = {RECORD_KEY: F.col(RECORD_KEY), RECORD_ID: _key_of(F.col(RECORD_ID))}
        key = F.coalesce(*(kind for name, kind in kinds.items() if name in found.columns))
        return found.select(key.alias(RECORD_KEY), F.regexp_extract("_metadata.file_path", f"{BATCH}=([^/]*)", 1).alias(BATCH))

    def append(self, records: DataFrame, identity: Sequence[str] | None = None, keep_identity: bool = True) -> int:
        """Store the records whose identity is new, each once, and say how many they were.

        ``identity`` names the columns that tell records apart; with ``keep_identity=False`` they are no
        fields of the record and are not stored. Without ``identity`` records are told apart by all
        their fields: none that differs from the others is lost, and equal ones are stored once.
        """
        given = list(identity or records.columns)
        missing = [name for name in given if name not in records.columns]
        if missing:
            raise ValueError(f"records have no column {', '.join(missing)}")
        digest = F.sha2(F.to_json(F.struct(*given), {"ignoreNullFields": "false"}), 256)
        day = F.col("ingestion_date").cast("string") if "ingestion_date" in records.columns else F.lit(None).cast("string")
        fields = [name for name in records.columns if keep_identity or name not in given]
        named = records.select(_key_of(digest).alias(RECORD_KEY), F.coalesce(day, F.lit(NO_DAY)).alias(DAY), *fields)
        known, stored = [], None
        if self.commits.newest():
            told = _sums(named.select(RECORD_KEY, DAY), DAY)
            known = self.files(list(told))
            if known:
                stored = self._keys(known)
                sums = list(_sums(stored, BATCH).values())
                if _total(told.values()) in (*sums, _total(sums)):
                    return 0  # the very records of a batch, or of these days
        # From here on the written batch is asked: input that is read twice could differ.
        added = self._write(named, str(uuid.uuid4()))
        seen = 0
        while added:
            newest = self.commits.newest()
            # The days of one call are as many as the dates of its runs.
            files = self.files(sorted(set(added.values())), after=seen) if newest > seen else []
            if files and files != known:
                known, stored = files, self._keys(files)
            batch = self._batch(added, named.schema)
            added = self._without(batch, stored if files else None, added)
            count = self._batch(added, named.schema).count() if added else 0
            if added and self._commit(newest + 1, {"add": added, "records": count}):
                return count
            seen = newest  # another writer was first: look at what it stored, then try again
        return 0

    def _without(self, batch: DataFrame, stored: DataFrame | None, added: dict[str, str]) -> dict[str, str]:
        """The folders of a batch in which each identity stands once and none is stored already: the same where that holds."""
        keys = batch.select(RECORD_KEY, F.lit(1).alias("new"))
        if stored is not None:
            keys = keys.union(stored.select(RECORD_KEY, F.lit(0)))
        met = keys.groupBy(RECORD_KEY).agg(F.sum("new").alias("n"), (F.min("new") == 0).alias("known"))
        odd = durable(met.where("n > 1 or (known and n > 0)").select(RECORD_KEY, "known"), "audit")
        if not odd.isEmpty():
            once = batch.join(odd.where("not known"), RECORD_KEY, "left_semi").dropDuplicates([RECORD_KEY])
            rest = batch.join(odd, RECORD_KEY, "left_anti").unionByName(once)
            old, added = added, self._write(rest, str(uuid.uuid4()))
            for name in old:  # no commit names them
                self.commits.delete(f"{self.path}/{name}")
        release(odd)
        return added

    def compact(self, day: str, files: int | None = None) -> bool:
        """Swap the files of a day for as few as asked, or as few as ``FILE_BYTES`` allows; False where another commit came in between."""
        newest = self.commits.newest()
        old = self.files([day])
        if len(old) < 2:
            return True
        files = files or max(math.ceil(sum(self.commits.size(f"{self.path}/{name}") for name in old) / FILE_BYTES), 1)
        rows = self._read(old).withColumn(DAY, F.lit(day)).coalesce(files)
        added = self._write(rows, str(uuid.uuid4()))
        return self._commit(newest + 1, {"add": added, "remove": old})

    def vacuum(self) -> list[str]:
        """Remove folders of days that compaction has let go; call it when no reader holds an older list."""
        gone = sorted({name for body in self.commits.bodies() for name in body.get("remove", ())})
        return [name for name in gone if self.commits.delete(f"{self.path}/{name}")]


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The audit table; records of different profiles may have different fields."""
    return AuditLog(spark, path).read()


def append_audit(records: DataFrame, path: str, identity: Sequence[str] | None = None, keep_identity: bool = True) -> str:
    """Append what is new (see ``AuditLog.append``), so that a repeated call adds nothing."""
    AuditLog(records.sparkSession, path).append(records, identity, keep_identity)
    return path
