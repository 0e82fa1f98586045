"""Secret scans over an incremental ledger of text blobs.

Every version of a text is addressed by the SHA-256 of its content. The ledger holds one row for
each pair of blob and rule version that was scanned, with its findings. A run scans only blobs
without such a row, once for each content, and joins the findings back to every path.

Spans count code points, end exclusive. Rules give leftmost non-overlapping matches of their
pattern; a match whose ``measured`` group is shorter than ``shortest`` is dropped afterwards.

Defined results: a null text is the empty text; a version without findings comes back with zero
counts and empty strings; repeated rows each get the findings; an empty table gives an empty table
and an empty ledger. Input columns keep their names; internal ones are chosen so that they cannot
clash. Ties in the span order (equal start) follow the order of the rule table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayside.llm.exprs import fresh
from quayside.session import durable

BLOB_SCHEMA = "blob string, rule_version string, findings array<struct<start: int, rank: int, kind: string, end: int>>"


@dataclass(frozen=True)
class SecretRule:
    """``pattern`` must have no anchors or look-around, since matches are cut out of the text by it."""

    kind: str
    pattern: str
    measured: int = 0
    shortest: int = 0
    hint: str | None = None  # a text that every match holds: texts without it are not searched


#: The base rules, then those that the method adds. ``[0-9a-f]{24,}`` finds what
#: ``[0-9a-f]+`` of 24 and more characters finds, since a match is always a whole run.
BASE_RULES = (
    SecretRule(
        "assign",
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
        r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        measured=2,
        shortest=6,
    ),
    SecretRule("access", r"AKIA[A-Z0-9]+", shortest=20, hint="AKIA"),
    SecretRule("hex", r"[0-9a-f]{24,}", shortest=24),
)
MORE_RULES = (
    SecretRule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", shortest=40, hint="eyJ"),
    # From the first line to the last, or, where the last is missing, to the text's end. Bodies hold no
    # hyphens, header lines before them few; the number of such pieces is bounded for the matcher's stack.
    SecretRule(
        "private_key",
        r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----[^-]*(?:-{1,4}[^-]+){0,20}(?:-----END [A-Z0-9 ]*PRIVATE KEY-----)?",
        hint="PRIVATE KEY-----",
    ),
    SecretRule("hosted_token", r"gh[pousr]_[A-Za-z0-9]+", shortest=40, hint="gh"),
)
RULES = BASE_RULES + MORE_RULES


def rule_version(rules: Sequence[SecretRule]) -> str:
    """Changes whenever a rule does, so that old ledger rows no longer count as scanned."""
    import hashlib

    return hashlib.sha256(repr(tuple(rules)).encode()).hexdigest()[:16]


def blob_address(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def empty_ledger(spark) -> DataFrame:
    return spark.createDataFrame([], BLOB_SCHEMA)


def _matches(blobs: DataFrame, rank: int, rule: SecretRule) -> DataFrame:
    """``blob, start, rank, kind, end`` of one rule.

    What stands between the matches and the matches themselves take turns, so running totals over
    both lengths give the places. The totals are a window over the matches of one blob.
    """
    hit = F.col("text").rlike(rule.pattern)
    if rule.hint:
        hit = F.col("text").contains(rule.hint) & hit
    found = blobs.where(hit).select(
        "blob",
        F.posexplode(
            F.arrays_zip(
                F.transform(F.split("text", rule.pattern, -1), F.length).alias("gap"),
                F.transform(F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0)), F.length).alias("long"),
                F.transform(
                    F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.measured)), F.length
                ).alias("measured"),
            )
        ).alias("n", "m"),
    )
    upto = W.partitionBy("blob").orderBy("n").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.col("m.gap") + F.coalesce(F.col("m.long"), F.lit(0))).over(upto)
    return (
        found.withColumn("end", end.cast("int"))
        .where(F.col("m.measured") >= rule.shortest)
        .select(
            "blob",
            (F.col("end") - F.col("m.long")).alias("start"),
            F.lit(rank).alias("rank"),
            F.lit(rule.kind).alias("kind"),
            "end",
        )
    )


def scan_blobs(blobs: DataFrame, rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """Ledger rows for ``blob, text``, one for each blob, also for those without findings."""
    found = reduce(DataFrame.unionByName, (_matches(blobs, k, rule) for k, rule in enumerate(rules)))
    spans = found.groupBy("blob").agg(
        F.sort_array(F.collect_list(F.struct("start", "rank", "kind", "end"))).alias("findings")
    )
    none = F.array().cast("array<struct<start: int, rank: int, kind: string, end: int>>")
    return (
        blobs.select("blob")
        .join(spans, "blob", "left")
        .select("blob", F.lit(rule_version(rules)).alias("rule_version"), F.coalesce("findings", none).alias("findings"))
    )


def unseen_blobs(df: DataFrame, ledger: DataFrame, text: str = "text", rules: Sequence[SecretRule] = RULES) -> DataFrame:
    """``blob, text`` of contents that the ledger has no row for under these rules, each once.

    Copies are dropped before the shuffle as well as after it.
    """
    blobs = df.select(blob_address(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    seen = ledger.where(F.col("rule_version") == rule_version(rules)).select("blob")
    return blobs.groupBy("blob").agg(F.first("text").alias("text")).join(seen, "blob", "left_anti")


def scan_versions(
    df: DataFrame, ledger: DataFrame, text: str = "text", out: str = "findings", rules: Sequence[SecretRule] = RULES
) -> tuple[DataFrame, DataFrame]:
    """All versions with their findings in ``out``, and the ledger rows that this run adds.

    The unseen blobs are written to the shared folder before they are searched, and so are the
    added rows before they are joined back: a lost executor repeats neither the shuffle of texts
    nor the search.
    """
    if out.lower() in {name.lower() for name in df.columns}:
        raise ValueError(f"the input already has a column {out!r}")
    blobs = durable(unseen_blobs(df, ledger, text, rules), "unseen-blobs")
    added = durable(scan_blobs(blobs, rules), "ledger")
    key = fresh(df, "blob")
    known = (
        ledger.where(F.col("rule_version") == rule_version(rules))
        .select("blob", "findings")
        .unionByName(added.select("blob", "findings"))
        .select(F.col("blob").alias(key), F.col("findings").alias(out))
        .where(F.size(out) > 0)
    )
    none = F.array().cast("array<struct<start: int, rank: int, kind: string, end: int>>")
    joined = df.withColumn(key, blob_address(F.col(text))).join(known, key, "left")
    return joined.withColumn(out, F.coalesce(F.col(out), none)).drop(key), added


def span_text(findings: Column, kinds: Sequence[str] | None = None) -> Column:
    """``kind:start:end`` by start, then in the order of the rules, joined by commas."""
    chosen = F.filter(findings, lambda s: s["kind"].isin(list(kinds))) if kinds is not None else findings
    return F.array_join(
        F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redact(text: Column, findings: Column, mark: str = "[secret]") -> Column:
    """The text with every found span replaced; overlapping spans are replaced as one.

    Spans come in order of their start. The pieces between them are cut out and joined again.
    """
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    source = F.coalesce(text, F.lit(""))

    def step(acc: Column, s: Column) -> Column:
        apart = s["start"] > acc["at"]
        first = (acc["at"] == 0) & (s["start"] == 0)
        gap = F.substring(source, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        more = F.when(apart | first, F.concat(acc["parts"], F.array(gap))).otherwise(acc["parts"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), more.alias("parts"))

    def close(acc: Column) -> Column:
        rest = F.substring(source, acc["at"] + 1, F.length(source))
        return F.array_join(F.concat(acc["parts"], F.array(rest)), mark)

    return F.when(F.size(findings) > 0, F.aggregate(findings, state, step, close)).otherwise(text)
