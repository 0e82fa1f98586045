"""One query for each operator, over whole tables, with SQL where SQL can state the result."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import (
    bottom_k,
    decontaminate,
    merkle_manifest,
    ngram_join,
    ordinal_quality,
    quality_rules,
    revisits,
    secret_scan,
    sentencepiece_topk,
    suffix_dedup,
    token_alignment,
    token_scan,
    toxicity,
)
from quayside.llm.exprs import ascii_lower
from quayside.llm.hashed_text import held_out

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


TOKENIZERS = os.environ.get("QUAYSIDE_TOKENIZERS", "/opt/tokenizers")


@query("op1_sentencepiece_topk")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Three segmentations of every document: digests of their ids, scores, and whether they decode."""
    drawn = sentencepiece_topk.sample_segmentations(
        table(spark, folder, "documents"),
        f"{TOKENIZERS}/piece_bpe_32k.model",
        k=3,
        alpha=1.0,
        seed=17,
        keep=["doc_id"],
        with_ids=False,
    )
    return drawn.select(
        "doc_id",
        F.size("segmentations").cast("long").alias("n_segmentations"),
        F.transform("segmentations", lambda s: s["n_pieces"]).alias("n_pieces"),
        F.transform("segmentations", lambda s: s["log_prob"]).alias("log_prob"),
        F.transform("segmentations", lambda s: s["perturbed"]).alias("perturbed"),
        F.transform("segmentations", lambda s: s["log_inclusion"]).alias("log_inclusion"),
        F.transform("segmentations", lambda s: s["ids_sha256"]).alias("ids_sha256"),
        F.forall("segmentations", lambda s: s["decodes"]).alias("decodes"),
    )


LEAKS_SQL = r"""
with items as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from benchmark),
docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
ish as (select item_id, len(w) as l, q, w[q:q+4] as s from items, unnest(range(1, len(w) - 3)) as t(q)),
dsh as (select doc_id, p, w[p:p+4] as s from docs, unnest(range(1, len(w) - 3)) as t(p)),
spots as (
  select distinct d.doc_id, i.l, greatest(0, least(d.p - i.q, len(docs.w) - i.l)) as start
  from dsh d join ish i using (s) join docs using (doc_id)),
wins as (select spots.*, w[start+1:start+l] as win from spots join docs using (doc_id)),
wsh as (select doc_id, l, start, win[k:k+4] as s, count(*) as n from wins, unnest(range(1, len(win) - 3)) as t(k)
  group by all),
isn as (select item_id, l, s, count(*) as n from ish group by all),
sim as (
  select a.doc_id, b.item_id, a.start, sum(least(a.n, b.n)) as shared, any_value(greatest(1, least(b.l, len(docs.w)) - 4)) + any_value(b.l - 4) as total
  from wsh a join isn b using (l, s) join docs using (doc_id) group by all)
"""


@query(
    "op2_decontamination",
    LEAKS_SQL
    + """
, scored as (select doc_id, item_id, start, shared / (total - shared) as similarity from sim)
select doc_id, item_id, cast(start as int) as start, cast(similarity as double) as similarity from scored
where similarity >= 0.8
qualify row_number() over (partition by doc_id, item_id order by similarity desc, start) = 1
""",
)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    leaks = decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return leaks.select("doc_id", "item_id", "start", "similarity")


QUALITY_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_STOPS = ", ".join(f"'{w}'" for w in sorted(set(quality_rules.STOP_WORDS)))
QUALITY_SQL = rf"""
with base as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents),
windows as (select doc_id, i, w[i:i+2] as s from base, unnest(range(1, len(w) - 1)) as u(i)),
repeated as (select doc_id, i from windows qualify count(*) over (partition by doc_id, s) > 1),
covered as (select doc_id, count(distinct i + k) as n from repeated, unnest([0, 1, 2]) as u(k) group by doc_id),
counts as (
  select doc_id, len(w) as n_words, length(list_aggregate(w, 'string_agg', '')) as word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols, len(lines) as n_lines,
    len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n, 0) as n_repeat_words,
    len(list_filter(w, lambda x: lower(rtrim(x, '.,;:!?')) in ({_STOPS}))) as n_stop,
    length(t) - length(regexp_replace(t, '[A-Za-z]', '', 'g')) as n_letters,
    length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) as n_upper
  from base left join covered using (doc_id)),
judged as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counts)
select doc_id, n_words, coalesce(word_chars, 0) as word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed
  and coalesce(word_chars / nullif(n_words, 0) between 2 and 40, true)
  and coalesce(n_symbols / nullif(n_words, 0) <= 0.1, true)
  and coalesce(n_stop / nullif(n_words, 0) >= 0.02, true)
  and coalesce(n_dup_lines / nullif(n_lines, 0) <= 0.5, true)
  and coalesce(n_upper / nullif(n_letters, 0) <= 0.7, true) as kept
from judged
"""


@query("op3_quality_rules", QUALITY_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.apply_rules(table(spark, folder, "documents").select("doc_id", "text"), out="quality")
    return judged.select(
        "doc_id",
        *(F.col(f"quality.counts.{name}") for name in QUALITY_COLUMNS),
        F.col("quality.base_failed"),
        F.col("quality.kept"),
    )


def _spans_sql(kind: str, pattern: str, group: int, shortest: int, rank: int) -> str:
    pattern = pattern.replace("'", "''")
    return f"""
  select doc_id, '{kind}' as kind, {rank} as rank, e - m as s, e from (
    select doc_id, length(hits[n]) as m, length(parts[n]) as k,
      cast(list_sum(list_transform(gaps[1:n], lambda x: length(x))) + list_sum(list_transform(hits[1:n], lambda x: length(x))) as int) as e
    from (select doc_id, regexp_extract_all(t, '{pattern}') as hits, regexp_extract_all(t, '{pattern}', {group}) as parts,
        string_split_regex(t, '{pattern}') as gaps from texts), unnest(range(1, len(hits) + 1)) as u(n))
  where k >= {shortest}"""


SECRETS_SQL = f"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
spans as ({" union all ".join(_spans_sql(r.kind, r.pattern, r.measured, r.shortest, k) for k, r in enumerate(secret_scan.RULES))}),
told as (select doc_id,
    count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
    count(*) filter (kind = 'hex') as n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) filter (rank < 3) as base,
    string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) as spans
  from spans group by doc_id)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from texts left join told using (doc_id)
"""


@query("op6_secret_scan", SECRETS_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found, _ = secret_scan.scan_versions(docs, secret_scan.empty_ledger(spark))
    spans = F.col("findings")
    base = [rule.kind for rule in secret_scan.BASE_RULES]
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in base),
        F.sha2(secret_scan.span_text(spans, base), 256).alias("base_sha256"),
        secret_scan.span_text(spans).alias("spans"),
    )


@query("op8_ngram_jaccard")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_components(table(spark, folder, "documents").select("doc_id", "text"))


def _grade():
    """Graded rating of a labelled document: 0 poor, 1 sound but toxic, 2 sound."""
    return F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)


@query("op9_ordinal_quality")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Expected grade and tail probability of every document; selected if it is more likely than not above grade 0."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    rated = ordinal_quality.rate_texts(docs, ordinal_quality.fit(docs, labels, _grade()), keep=["doc_id"])
    return rated.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("rating.expected_grade").alias("expected_grade"),
        F.get("rating.tail", F.lit(0)).alias("p_above_0"),
        F.get("rating.tail", F.lit(1)).alias("p_above_1"),
        F.coalesce(F.get("rating.tail", F.lit(0)) >= 0.5, F.lit(True)).alias("kept"),
    )


@query("op10_toxicity")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = toxicity.score_texts(docs, toxicity.fit(docs, labels), keep=["doc_id"])
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


@query("op7_token_counts")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as flat token files, and the tokens of each as a scan for separators finds them."""
    counted = token_scan.count_tokens(table(spark, folder, "documents"), f"{TOKENIZERS}/byte_bpe_50k.tiktoken", separator=50256)
    return counted.select("doc_id", "n_tokens")


#: Every page is captured as a full response and, half a day later, as a not-modified revisit. Some
#: revisits carry another tag, only a date, or no validator; every 13th page has only a revisit.
CAPTURES = """
select * from (
  select page_id * 2 as record_id, url, page_id * 3600 as seen, false as revisit, page_id, md5(coalesce(html, '')) as digest,
    length(html) as size from {pages} where page_id % 13 <> 5 or page_id is null
  union all
  select page_id * 2 + 1 as record_id, url, page_id * 3600 + 43200 as seen, true as revisit, page_id, md5(coalesce(html, '')) as digest,
    length(html) as size from {pages}) captures
"""

REVISITS_SQL = r"""
with captures as (CAPTURES),
cut as (select *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') as bare from captures),
parts as (select *, regexp_extract(bare, '^([^?]*)', 1) as place, regexp_extract(bare, '\?(.*)$', 1) as query from cut),
named as (select *,
    regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(place, '^([^/]*)', 1)), '^.*@', ''), ':(80|443)$', ''), '^www\.', '')
    || regexp_replace(regexp_extract(place, '^[^/]*(/.*)?$', 1), '/+$', '') as stem,
    list_sort(list_filter(string_split(query, '&'), lambda p: p <> '' and not regexp_matches(lower(p), '^(utm_[a-z_]*|ref|fbclid|gclid)(=|$)'))) as kept
  from parts),
known as (select *, stem || case when len(kept) > 0 then '?' || array_to_string(kept, '&') else '' end as canon from named),
revisit as (select * from known where revisit), response as (select * from known where not revisit),
met as (
  select v.record_id, v.canon as url, v.seen, v.page_id as vp, v.digest as vd, f.record_id as source_id, f.seen as source_at,
    f.digest as fd, f.page_id as fp, f.size as fs, v.canon
  from revisit v asof left join response f on v.canon = f.canon and f.seen < v.seen),
told as (select *,
    case when source_id is null then 'no_response'
      when vp % 11 = 3 then 'no_validator'
      when vp % 11 = 4 then case when vp % 7 = fp % 7 then 'resolved' else 'mismatch' end
      when vp % 11 = 5 then 'mismatch'
      when vd = fd then 'resolved' else 'mismatch' end as status from met)
select record_id, url, cast(seen as bigint) as captured_at, status,
  case when status = 'resolved' then source_id end as source_id, case when status = 'resolved' then source_at end as source_at,
  case when status = 'resolved' then fd end as digest,
  case when status = 'resolved' then
    'cache-control=max-age=' || (vp % 5) || ';content-length=' || coalesce(cast(fs as varchar), '0') || ';content-type=text/html;date=' || seen
    || ';etag=' || case when vp % 11 = 4 then '"' || fd || '"' else 'W/"' || vd || '"' end || ';last-modified=day ' || (fp % 7) end as headers
from told
"""


@query("op5_revisits", REVISITS_SQL.replace("CAPTURES", CAPTURES.replace("{pages}", "pages")))
def op5(spark: SparkSession, folder: str) -> DataFrame:
    captures = spark.sql(CAPTURES, pages=table(spark, folder, "pages"))
    n = F.col("page_id")
    day = F.concat(F.lit("day "), n % 7)
    always = lambda value: F.concat(F.lit('W/"'), value, F.lit('"'))
    response = F.create_map(
        F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.coalesce(F.col("size"), F.lit(0)).cast("string"),
        F.lit("ETag"), F.concat(F.lit('"'), F.col("digest"), F.lit('"')), F.lit("Last-Modified"), day, F.lit("Date"), F.col("seen").cast("string"),
    )
    common = [F.lit("Date"), F.col("seen").cast("string"), F.lit("Cache-Control"), F.concat(F.lit("max-age="), n % 5), F.lit("Content-Length"), F.lit("0")]
    answer = (
        F.when(n % 11 == 3, F.create_map(*common))
        .when(n % 11 == 4, F.create_map(*common, F.lit("Last-Modified"), day))
        .when(n % 11 == 5, F.create_map(*common, F.lit("ETag"), F.lit('"other"')))
        .otherwise(F.create_map(*common, F.lit("ETag"), always(F.col("digest"))))
    )
    records = captures.select(
        "record_id", "url", F.col("seen").alias("at"), "revisit", F.when(F.col("revisit"), answer).otherwise(response).alias("headers"),
        F.when(~F.col("revisit"), F.col("digest")).alias("digest"),
    )
    resolved = revisits.resolve_revisits(records)
    told = F.array_join(
        F.transform(F.array_sort(F.map_keys("headers")), lambda k: F.concat(k, F.lit("="), F.element_at(F.col("headers"), k))), ";"
    )
    return resolved.withColumn("headers", told).withColumnRenamed("at", "captured_at")


@query("op4_suffix_dedup")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, folder, "documents")).drop("spans")


@query("op11_bottom_k")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicates by bottom-k sketches of two-word shingles; one row of each component is kept."""
    return bottom_k.similar_rows(table(spark, folder, "documents").select("doc_id", "text"))


def _merkle_sql(levels: int = 8) -> str:
    """Levels of groups, then of the groups' tops, each written out; a level with one node is left as it is."""
    part = lambda c: f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"
    leaf = lambda text: "sha256(" + " || ".join(map(part, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    crc = (
        "list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda x: ascii(x)::bigint)), "
        "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384)))"
    )
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        f"""docs as (select doc_id, source, {leaf("text")} as leaf,
  case when xor({crc}, 4294967295) % 5 = 0 then {leaf(lower)} else {leaf("text")} end as given from documents)""",
        """d0 as (select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as p,
  count(*) over (partition by source) as n, given as v, '' as proof from docs)""",
        "a0 as (select source as g, p, n, leaf as h from d0)",
    ]
    for side, d, a, key in (("source", "d", "a", "source"), ("root", "e", "b", "0")):
        if side == "root":
            parts += [
                f"top as (select g as source, h, row_number() over (order by g nulls first) - 1 as p, count(*) over () as n from a{levels})",
                "b0 as (select 0 as g, p, n, h from top)",
                f"""e0 as (select d{levels}.* exclude (p, n), top.h as subroot, top.p as p, top.n as n from d{levels} join top
  on d{levels}.source is not distinct from top.source)""",
            ]
        for k in range(levels):
            parts += [
                f"""{a}{k + 1} as (select g, p // 16 as p, (n + 15) // 16 as n,
  sha256(string_agg(h, '' order by p)) as h from {a}{k} where n > 1 group by g, p // 16, n union all select g, p, n, h from {a}{k} where n <= 1)""",
                f"{a}r{k} as (select g, p // 16 as p, list(h order by p) as run from {a}{k} group by g, p // 16)",
                f"""{d}{k + 1} as (select x.* exclude (p, n, v, proof), x.p // 16 as p, (n + 15) // 16 as n,
  case when n <= 1 then v else sha256(array_to_string(run[:x.p % 16], '') || v || array_to_string(run[x.p % 16 + 2:], '')) end as v,
  case when n <= 1 then proof else proof || array_to_string(run[:x.p % 16], '') || array_to_string(run[x.p % 16 + 2:], '') end as proof
  from {d}{k} x join {a}r{k} r on {key} is not distinct from r.g and x.p // 16 = r.p)""",
            ]
    return (
        "with " + ",\n".join(parts) + f"""
select doc_id, leaf, subroot, h as root, sha256(proof) as proof_sha256, v as folded_root, v = h as verified from e{levels}, b{levels}"""
    )


@query("op12_merkle_manifest", _merkle_sql())
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's leaf, proof and root; every fifth one tampered with by lower-casing its text."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle_manifest.verify_documents(table(spark, folder, "documents"), tampered, ascii_lower(F.col("text")))


@query("op13_token_alignment")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Overlap links and common groups of the tokens of two tokenizers, for every document."""
    docs = table(spark, folder, "documents")
    return token_alignment.align_corpus(docs, f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links"
    )
