"""Small scalar expressions used by counts and audit records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text layouts of the audit record.
AUDIT_STAMP = "yyyyMMddHHmmss"
SECONDS = "yyyy-MM-dd HH:mm:ss"
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
LOG_URL_HEAD = "/graph?dag_id="
LOG_URL_TAIL = "&root=&execution_date="


def ts_text(ts: Column, offset: str = "") -> Column:
    """A time as text: six fraction digits when there is a fraction, none otherwise."""
    whole = F.date_trunc("second", ts).cast("timestamp_ntz") == ts.cast("timestamp_ntz")
    text = F.when(whole, F.date_format(ts, SECONDS)).otherwise(F.date_format(ts, MICROS))
    return F.concat(text, F.lit(offset)) if offset else text


def parse_task_ts(text: Column) -> Column:
    """The clock time before the offset sign, with or without a fraction; NULL for other text."""
    return F.regexp_replace(text, "[+].*$", "").try_cast("timestamp_ntz")


def task_seconds(start: Column, end: Column) -> Column:
    """Seconds from start to end, exact to the microsecond."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(1e6)


def seconds_text(seconds: Column) -> Column:
    """Seconds as plain decimal text with at least one fraction digit."""
    return F.regexp_replace(seconds.cast("decimal(24,6)").cast("string"), r"(\.\d+?)0+$", "$1")


def audit_id(execution: Column, dag_id: Column, source: Column | None = None) -> Column:
    parts = [F.date_format(execution, AUDIT_STAMP), dag_id]
    return F.concat(*(parts if source is None else [*parts, source]))


def url_quote(text: Column) -> Column:
    """Percent encoding with ``%20`` for a space."""
    return F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))


def log_url(dag_id: Column, execution: Column) -> Column:
    when = url_quote(ts_text(execution, "+00:00"))
    return F.concat(F.lit(LOG_URL_HEAD), dag_id, F.lit(LOG_URL_TAIL), when)


def ingestion_date(run_ts: Column) -> Column:
    return F.date_format(run_ts, "yyyy-MM-dd")


def driver_kind(driver: Column) -> Column:
    """Database family by a part of the driver's name; NULL for one that is not served."""
    return F.when(F.contains(driver, F.lit("postgre")), "postgresql").when(
        F.contains(driver, F.lit("mysql")), "mysql"
    )


def to_int(text: Column) -> Column:
    return text.try_cast("int")


def json_field(text: Column, path: str) -> Column:
    return F.get_json_object(text, path)


def json_record(*columns: str) -> Column:
    """The named columns as one JSON text; fields that are null are left out."""
    return F.to_json(F.struct(*columns))


def lower_group(group: Column) -> Column:
    return F.lower(group.cast("string"))


def job_type_text(job_type: Column, kind: Column) -> Column:
    return F.concat_ws(" ", job_type, kind)
