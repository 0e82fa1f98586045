"""Not-modified revisits of web archives: each is joined to the full response that it confirms.

A revisit holds no body. It belongs to the latest full response of the same canonical URL that was
captured strictly earlier. If its validators agree with that response's, the record is resolved:
it has the response's body, and its headers with those that a not-modified answer may update.

The as-of join does not gather a URL in one task: a URL's captures are cut into spans of time. Each
span's last full response is an aggregate; a window over spans carries it to later ones, and a
window inside a span finds the nearest before each revisit. Bodies are not moved: a resolved record
names the record that holds its body, with its digest.

Defined results (``status``): ``resolved``; ``mismatch`` (validators differ); ``no_validator``
(nothing to compare); ``no_response`` (no earlier full response, or a null URL or time). Full
responses at one time count by the greater id; repeated records each come back; header names are
compared in lower case and null headers are none. Other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Header fields that a 304 answer carries for the stored response to take over.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")

#: Query parameters that do not choose a resource.
TRACKING = r"^(utm_[a-z_]*|ref|fbclid|gclid)(=|$)"


def canonical_url(url: Column) -> Column:
    """No scheme, user, default port, leading ``www.``, fragment, tracking parameters or closing slash.

    The host is in lower case, parameters are sorted.
    """
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    place = F.regexp_extract(bare, r"^([^?]*)", 1)
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    host = F.lower(F.regexp_extract(place, "^([^/]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(place, "^[^/]*(/.*)?$", 1), "/+$", "")
    kept = F.sort_array(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))


def lower_headers(headers: Column) -> Column:
    """A map with names in lower case; of names that then meet the last one counts."""
    pairs = F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))
    names = F.transform(pairs, lambda e: F.lower(e["key"]))
    kept = F.filter(
        F.transform(pairs, lambda e, i: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"), i.alias("i"))),
        lambda e: ~F.array_contains(F.slice(names, e["i"] + 2, F.size(names)), e["key"]),
    )
    return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["key"], e["value"])))


def _opaque(tag: Column) -> Column:
    """Entity tags are compared weakly."""
    return F.regexp_replace(F.trim(tag), "^W/", "")


def resolve_revisits(records: DataFrame, span: int = 86_400) -> DataFrame:
    """``record_id, url, at, status, source_id, source_at, digest, headers`` of every revisit.

    ``records``: ``record_id``, ``url``, ``at`` (seconds), ``revisit`` boolean, ``headers`` map,
    ``digest`` of the body. ``source_id``, ``digest`` and merged ``headers`` only where resolved.
    """
    known = records.select(
        "record_id", canonical_url(F.col("url")).alias("url"), F.col("at").cast("long").alias("at"),
        F.coalesce("revisit", F.lit(False)).alias("revisit"), lower_headers(F.col("headers")).alias("headers"), "digest",
    ).withColumn("span", F.floor(F.col("at") / span))
    lost = known.where(F.col("revisit") & (F.col("url").isNull() | F.col("at").isNull()))
    known = known.where(F.col("url").isNotNull() & F.col("at").isNotNull())
    full = F.when(~F.col("revisit"), F.struct("record_id", "at", "headers", "digest"))
    rank = F.when(~F.col("revisit"), F.struct("at", "record_id"))
    last = known.where(~F.col("revisit")).groupBy("url", "span").agg(F.max_by(full, rank).alias("last"))
    # Spans of revisits alone are needed as well, to be given what came before them.
    spans = known.select("url", "span").distinct().join(last, ["url", "span"], "left")
    before = W.partitionBy("url").orderBy("span").rowsBetween(W.unboundedPreceding, -1)
    carried = spans.select("url", "span", F.last("last", ignorenulls=True).over(before).alias("carried"))
    near = W.partitionBy("url", "span").orderBy("at").rangeBetween(W.unboundedPreceding, -1)
    found = (
        known.withColumn("near", F.max_by(full, rank).over(near))
        .where("revisit")
        .join(carried, ["url", "span"], "left")
        .withColumn("source", F.coalesce("near", "carried"))
        .drop("near", "carried")
    )
    found = found.unionByName(lost.withColumn("source", F.lit(None).cast(found.schema["source"].dataType)).select(found.columns))
    own, stored = F.col("headers"), F.col("source.headers")
    tags = own["etag"].isNotNull() & stored["etag"].isNotNull()
    dates = own["last-modified"].isNotNull() & stored["last-modified"].isNotNull()
    agrees = F.when(tags, _opaque(own["etag"]) == _opaque(stored["etag"])).when(
        dates, F.trim(own["last-modified"]) == F.trim(stored["last-modified"])
    )
    status = (
        F.when(F.col("source").isNull(), "no_response")
        .when(agrees.isNull(), "no_validator")
        .when(agrees, "resolved")
        .otherwise("mismatch")
    )
    update = F.map_filter(own, lambda name, value: name.isin(*PERMITTED) & value.isNotNull())
    merged = F.map_concat(F.map_filter(stored, lambda name, _: ~F.map_contains_key(update, name)), update)
    good = F.col("status") == "resolved"
    return found.withColumn("status", status).select(
        "record_id", "url", "at", "status",
        F.when(good, F.col("source.record_id")).alias("source_id"),
        F.when(good, F.col("source.at")).alias("source_at"),
        F.when(good, F.col("source.digest")).alias("digest"),
        F.when(good, merged).alias("headers"),
    )
