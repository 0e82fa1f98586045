"""The table of asset states, kept as whole versions.

A change writes the next version to a folder of its own and then commits its name. Readers take the
newest committed version, so they never see a half-written one, and no folder is overwritten while it
is read. Of two writers that started from the same version one commits first; the other merges its
change into what was committed meanwhile, cell by cell, and tries again, so no update is lost.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.sinks.commits import CommitLog

PROCESSED = "Success"  # Fixed value: the mark of a processed asset.
OPEN_FLAG = "false"  # Fixed value: the only flag on which the mark is set.
UPDATED = {"result": "Task updated successfully", "type": "success"}  # Fixed value: the answer.


def mark_processed(state: DataFrame, runs: DataFrame) -> DataFrame:
    """``is_processed`` set to the mark for every asset with a run whose flag is ``'false'``.

    ``runs`` has ``asset_id`` and ``is_processed``; it is reduced to one row per asset first, so a
    busy asset does not repeat state rows.
    """
    done = runs.where(F.col("is_processed") == OPEN_FLAG).select(F.col("asset_id").alias("done_id")).distinct()
    marked: Column = F.when(F.col("done_id").isNotNull(), F.lit(PROCESSED)).otherwise(F.col("is_processed"))
    joined = state.join(done, F.col("asset_id") == F.col("done_id"), "left")
    return joined.withColumn("is_processed", marked).select(*state.columns)


def store_watermark(state: DataFrame, asset_id: str, value) -> DataFrame:
    """The newest loaded value of an asset's growing column, kept as text for its next load."""
    text = F.when(F.col("asset_id") == asset_id, F.lit(str(value))).otherwise(F.col("incremental_column_value"))
    return state.withColumn("incremental_column_value", text)


def merge_changes(base: DataFrame, mine: DataFrame, theirs: DataFrame, key: str = "asset_id") -> DataFrame:
    """``theirs`` with what ``mine`` changed since ``base``: cells that differ, rows that are new, rows that are gone.

    Where both sides changed a cell, mine stands, as if it had come later. A row that they removed
    comes back only if I changed it. Keys are unique in each table.
    """
    columns = mine.columns
    names = lambda df, side: df.select(*[F.col(c).alias(f"{side}_{c}") for c in columns], F.lit(True).alias(side))
    met = names(base, "base").join(names(mine, "mine"), F.col(f"base_{key}").eqNullSafe(F.col(f"mine_{key}")), "full_outer")
    met = met.withColumn("key", F.coalesce(f"mine_{key}", f"base_{key}"))
    met = met.join(names(theirs, "theirs"), F.col("key").eqNullSafe(F.col(f"theirs_{key}")), "full_outer")
    changed = {c: ~F.col(f"mine_{c}").eqNullSafe(F.col(f"base_{c}")) for c in columns}
    any_change = F.lit(False)
    for test in changed.values():
        any_change = any_change | test
    mine_has, base_has, theirs_has = (F.col(side).isNotNull() for side in ("mine", "base", "theirs"))
    stays = F.when(mine_has & base_has, theirs_has | any_change).when(mine_has, F.lit(True)).otherwise(theirs_has & ~base_has)
    cell = lambda c: F.when(mine_has & (~theirs_has | ~base_has | changed[c]), F.col(f"mine_{c}")).otherwise(F.col(f"theirs_{c}"))
    return met.where(stays).select(*[cell(c).alias(c) for c in columns])


class StateTable:
    """Versions of a small table under one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.commits = CommitLog(spark, f"{self.path}/_commits")

    def version(self) -> int:
        """The newest committed version, 0 before the first."""
        return self.commits.newest()

    def read(self, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        if not version:
            raise LookupError(f"no committed version under {self.path}")
        return self.spark.read.parquet(f"{self.path}/{self.commits.body(version)['folder']}")

    def _write(self, rows: DataFrame) -> str:
        folder = f"version-{uuid.uuid4()}"
        rows.write.parquet(f"{self.path}/{folder}")
        return folder

    def replace(self, rows: DataFrame, base: int | None = None, key: str = "asset_id") -> int:
        """Write ``rows`` as the next version and commit it; gives its number.

        ``base`` is the version that ``rows`` were made from, the newest one unless it is given. If
        others have committed since, only what ``rows`` changed against ``base`` is committed over theirs.
        """
        base = self.version() if base is None else base
        folder = self._write(rows)
        while True:
            newest = self.version()
            if newest > base:
                written = self.spark.read.parquet(f"{self.path}/{folder}")
                before = self.read(base) if base else written.limit(0)
                folder, base = self._write(merge_changes(before, written, self.read(newest), key)), newest
            if self.commits.commit(newest + 1, {"folder": folder}):
                return newest + 1

    def update(self, change: Callable[[DataFrame], DataFrame]) -> int:
        """Commit ``change`` of the newest version; over a later one where another writer was first."""
        base = self.version()
        return self.replace(change(self.read(base)), base)

    def update_processed(self, asset_id: str, flag: str) -> dict[str, str] | None:
        """Mark one asset processed when the flag is ``'false'``; None when nothing is done."""
        if flag != OPEN_FLAG:
            return None
        run = self.spark.range(1).select(F.lit(asset_id).alias("asset_id"), F.lit(flag).alias("is_processed"))
        self.update(lambda state: mark_processed(state, run))
        return dict(UPDATED)
