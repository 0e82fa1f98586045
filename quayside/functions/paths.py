"""Object-store paths and run folders as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Folder names of the zone layout and the run-stamp format.
RUN_PARENT = "/dataproc/"
SECURED_PARENT = "/dlp_output"
PART_GLOB = "/*.csv"
RUN_STAMP = "yyyyMMdd'T'HHmmss"


def _text(value: Column | str) -> Column:
    return F.lit(value) if isinstance(value, str) else value


def path_bucket(path: Column) -> Column:
    """The bucket of ``scheme://bucket/...``; NULL for text without a bucket."""
    found = F.regexp_extract(path, "//([^/]+)", 1)
    return F.when(found != "", found)


def path_prefix(path: Column) -> Column:
    """The folder below the bucket, closed by ``/``; empty for the bucket itself."""
    below = F.regexp_extract(path, "//[^/]+/(.*)$", 1)
    return F.when(below == "", F.lit("")).otherwise(F.concat(below, F.lit("/")))


def path_parent(path: Column) -> Column:
    """The text before the last ``/``, all of it where there is none."""
    return F.regexp_replace(path, "/[^/]*$", "")


def parent_of(path: str) -> str:
    """:func:`path_parent` for one path known on the driver."""
    return path.rsplit("/", 1)[0]


def has_suffix(path: Column, suffix: str) -> Column:
    return F.endswith(path, F.lit(suffix))


def ts_nodash(ts: Column) -> Column:
    """The run stamp used in folder names."""
    return F.date_format(ts, RUN_STAMP)


def landing_folder(zone: Column | str, asset_id: Column | str, ts: Column) -> Column:
    """The landing folder of one run of one asset."""
    return F.concat(_text(zone), F.lit(RUN_PARENT), _text(asset_id), F.lit("_"), ts_nodash(ts))


def item_folder(zone: Column | str, source: Column | str, group: Column | str, ts: Column) -> Column:
    """The folder written into the run's item record: source, lower-cased group and stamp."""
    return F.concat(
        _text(zone), F.lit(RUN_PARENT), _text(source), F.lower(_text(group)), ts_nodash(ts), F.lit("/")
    )


def secured_folder(landing: Column, landing_root: str, secured_root: str) -> Column:
    """Where the protected copy of a landing folder lives; NULL for a folder outside the zone."""
    below = F.split_part(landing, F.lit(landing_root), F.lit(2))
    path = F.concat(F.lit(secured_root), F.lit(SECURED_PARENT), below)
    return F.when(F.contains(landing, F.lit(landing_root)), path)


def quality_source(flag: Column, landing: Column, landing_root: str, secured_root: str) -> Column:
    """What the quality checks read: the protected files when tokenization is on, else the landed ones."""
    chosen = F.when(flag == "True", secured_folder(landing, landing_root, secured_root)).otherwise(landing)
    return F.concat(chosen, F.lit(PART_GLOB))
