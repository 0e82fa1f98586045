"""Tokenization and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.catalog.file_queries import DEMO_KEY, hmac_sql
from quayside.catalog.fixtures import COMPLEX_TYPES
from quayside.catalog.registry import query
from quayside.functions import tokens
from quayside.operators.profile import (
    preview,
    profile_columns,
    profile_histogram,
    profile_quantiles,
    profile_table,
    profile_topk,
)
from quayside.operators.heavy import heavy_hitters
from quayside.operators.profile_store import RANK_ERROR, ProfileStore
from quayside.operators.ranks import rank_values
from quayside.operators.surrogate_buckets import BucketedMap
from quayside.operators.surrogates import SurrogateMap
from quayside.operators.tokenize import apply_template
from quayside.operators.values import value_stats
from quayside.session import run_folder

# --- tokens -----------------------------------------------------------------------------------


@query("tokenize_hash", f"select c_custkey, {hmac_sql('c_name')} as token from {{customer}}")
def _tokenize_hash(spark, t):
    return t.customer.select("c_custkey", tokens.hmac_token(F.col("c_name"), DEMO_KEY).alias("token"))


@query(
    "tokenize_reversible",
    "select o_orderpriority, o_orderpriority as opened, cast(1 as bigint) as tokens, count(*) as n from {orders} group by 1",
)
def _tokenize_reversible(spark, t):
    sealed = t.orders.select("o_orderpriority", tokens.seal_token(F.col("o_orderpriority"), DEMO_KEY).alias("token"))
    return sealed.groupBy("o_orderpriority").agg(
        F.max(tokens.open_token(F.col("token"), DEMO_KEY)).alias("opened"),
        F.count_distinct("token").alias("tokens"),
        F.count(F.lit(1)).alias("n"),
    )


@query(
    "tokenize_surrogate",
    """
    select 'supplier' as kind, s_suppkey as row_key, row_number() over (order by s_name) as surrogate_id from {supplier}
    union all
    select 'customer', c_custkey, (select count(distinct s_name) from {supplier}) + row_number() over (order by c_name)
    from {customer}
    """,
)
def _tokenize_surrogate(spark, t):
    known = SurrogateMap(spark, run_folder(spark, "surrogates"))
    suppliers = t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("row_key"), "s_name")
    customers = t.customer.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("row_key"), "c_name")
    first = known.attach(suppliers, "s_name", "surrogate_id").drop("s_name")
    return first.unionByName(known.attach(customers, "c_name", "surrogate_id").drop("c_name"))


@query(
    "tokenize_surrogate_skewed",
    "select * exclude (l_returnflag), dense_rank() over (order by l_returnflag) as returnflag_id from {lineitem}",
)
def _tokenize_skewed(spark, t):
    rows = t.lineitem
    known = SurrogateMap(spark, run_folder(spark, "surrogates"))
    return known.attach(rows, "l_returnflag", "returnflag_id").drop("l_returnflag")


@query(
    "tokenize_template",
    f"""
    select row_number() over (order by c_mktsegment, c_custkey) * 0 + c_custkey as c_custkey,
      {hmac_sql('c_name')} as c_name, repeat('*', greatest(length(cast(c_nationkey as varchar)) - 1, 0))
      || right(cast(c_nationkey as varchar), 1) as c_nationkey, '[REDACTED]' as c_acctbal,
      dense_rank() over (order by c_mktsegment) as c_mktsegment
    from {{customer}}
    """,
)
def _tokenize_template(spark, t):
    template = {
        "c_name": "hash",
        "c_nationkey": {"method": "mask", "keep": 1},
        "c_acctbal": "redact",
        "c_mktsegment": "surrogate",
    }
    maps = {"c_mktsegment": SurrogateMap(spark, run_folder(spark, "surrogates"))}
    return apply_template(t.customer, template, DEMO_KEY, maps)


def _bucketed_sql(value: str, table: str) -> str:
    """Digest and number of every value: the k-th of bucket b of 64 is k * 64 + b + 1."""
    return f"""(select d, (row_number() over (partition by b order by d) - 1) * 64 + b + 1 as id
      from (select d, ('0x' || substr(d, 1, 8))::bigint % 64 as b from (select distinct sha256({value}) as d from {table}) x) y)"""


@query(
    "tokenize_template_bucketed",
    f"""select doc_id, t.id as text, l.id as lang, s.id as source, {hmac_sql('cast(n_chars as varchar)')} as n_chars
        from {{documents}} left join {_bucketed_sql('text', '{documents}')} t on t.d = sha256(text)
        left join {_bucketed_sql('v', '(select lang as v from {documents} union all select source from {documents}) u')} l on l.d = sha256(lang)
        left join {_bucketed_sql('v', '(select lang as v from {documents} union all select source from {documents}) u')} s on s.d = sha256(source)""",
)
def _tokenize_bucketed(spark, t):
    """Three surrogate columns, one of them whole texts, two of them on one map."""
    base = run_folder(spark, "buckets")
    names = BucketedMap(spark, f"{base}/names", 64)
    maps = {"text": BucketedMap(spark, f"{base}/texts", 64), "lang": names, "source": names}
    template = {**dict.fromkeys(maps, "surrogate"), "n_chars": "hash"}
    return apply_template(t.documents, template, DEMO_KEY, maps)


@query(
    "mask_column",
    f"""select row_id, repeat('*', greatest(length(masterCard) - 4, 0)) || right(masterCard, 4) as masked
        from ({COMPLEX_TYPES}) c""",
)
def _mask(spark, t):
    return t.sql(COMPLEX_TYPES).select("row_id", tokens.mask(F.col("masterCard")).alias("masked"))


@query(
    "redact_column",
    f"select row_id, case when masterCard is not null then '[REDACTED]' end as redacted from ({COMPLEX_TYPES}) c",
)
def _redact(spark, t):
    return t.sql(COMPLEX_TYPES).select("row_id", tokens.redact(F.col("masterCard")).alias("redacted"))


# --- profiles ---------------------------------------------------------------------------------


@query("preview", "select * from {orders} order by o_orderdate desc, o_orderkey limit 20")
def _preview(spark, t):
    return preview(t.orders, F.desc("o_orderdate"), "o_orderkey")


def _profile_sql(source: str, columns: dict[str, str]) -> str:
    """One SELECT for each column: ``columns`` gives the type as Spark names it."""
    parts = []
    for name, kind in columns.items():
        number, text = kind in ("int", "bigint", "double"), kind == "string"
        shown = "cast(cast(round({0}, 6) as decimal(38,6)) as varchar)" if kind == "double" else "cast({0} as varchar)"
        low, high = shown.format(f'min("{name}")'), shown.format(f'max("{name}")')
        parts.append(
            f"""select '{name}' as column_name, '{kind}' as data_type, count(*) as row_count,
            count(*) - count("{name}") as null_count,
            100::double * (count(*) - count("{name}")) / count(*) as null_pct,
            {low} as min_value, {high} as max_value,
            {f'round(avg("{name}"), 4)' if number else 'cast(null as double)'} as mean_value,
            {f'round(stddev_samp("{name}"), 4)' if number else 'cast(null as double)'} as std_value,
            {f'cast(min(length("{name}")) as int)' if text else 'cast(null as int)'} as min_length,
            {f'cast(max(length("{name}")) as int)' if text else 'cast(null as int)'} as max_length,
            count(distinct "{name}") as distinct_count from {source}"""
        )
    return " union all ".join(parts)


CUSTOMER_TYPES = {
    "c_custkey": "bigint",
    "c_name": "string",
    "c_nationkey": "int",
    "c_acctbal": "double",
    "c_mktsegment": "string",
}
ORDER_TYPES = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}
COMPLEX_COLUMN_TYPES = {"row_id": "bigint", "int": "int", "masterCard": "string"}


@query("profile_columns", _profile_sql("{customer}", CUSTOMER_TYPES))
def _profile_customer(spark, t):
    return profile_columns(t.customer)


@query("profile_columns_orders", _profile_sql("{orders}", ORDER_TYPES))
def _profile_orders(spark, t):
    return profile_columns(t.orders)


@query("profile_columns_nulls", _profile_sql(f"({COMPLEX_TYPES}) c", COMPLEX_COLUMN_TYPES))
def _profile_nulls(spark, t):
    return profile_columns(t.sql(COMPLEX_TYPES))


@query("profile_columns_approx")
def _profile_approx(spark, t):
    return profile_columns(t.lineitem, exact=False)


FAULTY = """select doc_id, case when doc_id % 11 = 3 then null else text end as text, lang,
  case when doc_id % 7 = 1 then null else source end as source, n_chars from {documents}
  union all select doc_id, text, lang, source, n_chars from {documents} where doc_id % 13 = 2"""


@query(
    "profile_table",
    f"""select (select count(*) from ({FAULTY}) a) as row_count,
       (select count(*) from information_schema.columns where table_name = 'documents') as column_count,
       (select count(*) from ({FAULTY}) a) - (select count(*) from (select distinct * from ({FAULTY}) b) d) as duplicate_rows,
       (select cast(sum((text is null)::int + (source is null)::int) as bigint) from ({FAULTY}) c) as missing_cells""",
)
def _profile_table(spark, t):
    return profile_table(t.sql(FAULTY))


@query(
    "profile_topk_texts",
    """select text as value, count(*) as n from {documents} where text is not null group by 1 order by n desc, value limit 10""",
)
def _profile_topk_texts(spark, t):
    """The most frequent whole texts, from counters of bounded number in each task and an exact recount."""
    return heavy_hitters(t.documents, "text", 10).rows


MERGED = ("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate")


@query(
    "profile_merged",
    " union all ".join(
        f"""select '{c}' as column_name, cast(4 as bigint) as runs, count(*) as row_count, count(*) - count({c}) as null_count,
          count(distinct {c}) as distinct_count, true as distinct_within, true as median_within from {{lineitem}}"""
        for c in MERGED
    ),
)
def _profile_merged(spark, t):
    """Four runs that were profiled one by one; the exact values say whether the merged estimates keep their errors."""
    store = ProfileStore(spark, run_folder(spark, "profiles"))
    rows = t.lineitem.select(*MERGED)
    for run in range(4):
        store.add(f"run{run}", rows.where(F.col("l_orderkey") % 4 == run))
    store.add("run3", rows.where(F.col("l_orderkey") % 4 == 3))  # a repeated run replaces its own rows
    merged = store.merged()
    exact = value_stats(rows, MERGED).select("column_name", "distinct_count")
    both = merged.join(exact, "column_name")
    within = F.abs(F.col("distinct_estimate") - F.col("distinct_count")) <= F.col("distinct_error") * F.col("distinct_count")
    # The share of rows up to the estimated median, for numbers.
    medians = {r["column_name"]: r["quantiles"][0] for r in merged.where("quantiles is not null").collect()}
    ranks = rows.agg(
        *[F.avg((F.col(c) < v).cast("double")).alias(f"{c}_below") for c, v in medians.items()],
        *[F.avg((F.col(c) <= v).cast("double")).alias(f"{c}_upto") for c, v in medians.items()],
    ).first()
    fits = {c: ranks[f"{c}_below"] - RANK_ERROR <= 0.5 <= ranks[f"{c}_upto"] + RANK_ERROR for c in medians}
    told = F.coalesce(F.create_map(*[F.lit(x) for item in fits.items() for x in item])[F.col("column_name")], F.lit(True))
    return both.select(
        "column_name", "runs", "row_count", "null_count", "distinct_count", within.alias("distinct_within"), told.alias("median_within")
    )


@query(
    "profile_table_nulls",
    f"""select count(*) as row_count, cast(3 as bigint) as column_count, cast(0 as bigint) as duplicate_rows,
        cast(sum(case when "int" is null then 1 else 0 end + case when masterCard is null then 1 else 0 end) as bigint)
        as missing_cells from ({COMPLEX_TYPES}) c""",
)
def _profile_table_nulls(spark, t):
    return profile_table(t.sql(COMPLEX_TYPES))


TOPK = ("c_mktsegment", "c_nationkey", "c_name")


@query(
    "profile_topk",
    " union all ".join(
        f"""select '{c}' as column_name, value, n, rank from (
              select cast({c} as varchar) as value, count(*) as n,
                cast(row_number() over (order by count(*) desc, cast({c} as varchar)) as int) as rank
              from {{customer}} group by {c}) x where rank <= 5"""
        for c in TOPK
    ),
)
def _profile_topk(spark, t):
    return profile_topk(t.customer, TOPK, 5)


PROBS = (0.05, 0.25, 0.5, 0.75, 0.95)


NUMERIC = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "profile_quantiles",
    " union all ".join(
        f"select '{c}' as column_name, {p}::double as prob, round(quantile_cont({c}::double, {p}), 4) as quantile "
        "from {lineitem}"
        for c in NUMERIC
        for p in PROBS
    ),
)
def _profile_quantiles(spark, t):
    found = profile_quantiles(t.lineitem, probs=PROBS)
    return found.withColumn("quantile", F.round("quantile", 4))


#: Numbers past 2^53 that lie close together, numbers over many magnitudes, and a decimal.
WIDE = """select cast(9007199254740993 + l_orderkey * 4 + l_linenumber as bigint) as big,
  cast((l_partkey - 100) * 1000000000000000 as bigint) as spread,
  cast(l_extendedprice as decimal(20,2)) * cast(1000000000000 as decimal(20,2)) as amount from {lineitem}"""

#: The same numbers without the cast, whose products leave 64 bits where part keys pass 9,323; as texts they read alike.
WIDE_EXACT = WIDE.replace(
    "cast((l_partkey - 100) * 1000000000000000 as bigint)",
    "(cast(l_partkey as decimal(19,0)) - 100) * cast(1000000000000000 as decimal(16,0))",
)


@query(
    "profile_ranks",
    " union all ".join(
        f"""select '{c}' as column_name, {p}::double as prob, cast(min(v) filter (r = cast(floor({p} * (n - 1)) as bigint)) as varchar) as below,
          cast(min(v) filter (r = cast(ceil({p} * (n - 1)) as bigint)) as varchar) as above
        from (select {c} as v, row_number() over (order by {c}) - 1 as r, count(*) over () as n from ({WIDE}) w) x"""
        for c in ("big", "spread", "amount")
        for p in PROBS
    ),
)
def _profile_ranks(spark, t):
    return rank_values(t.sql(WIDE_EXACT), ["big", "spread", "amount"], PROBS)


@query("profile_quantiles_approx")
def _profile_quantiles_approx(spark, t):
    numeric = [f.name for f in t.lineitem.schema.fields if isinstance(f.dataType, T.NumericType)]
    return profile_quantiles(t.lineitem, numeric, PROBS, exact=False)


@query(
    "profile_estimates",
    " union all ".join(
        f"select '{c}' as column_name, count(*) as row_count, count(distinct {c}) as distinct_count, true as distinct_within, "
        f"true as quantiles_within from {{lineitem}}"
        for c in NUMERIC
    ),
)
def _profile_estimates(spark, t):
    """What the estimated profiles say of every numeric column, held against the exact values: within 15 %, and within 1 % of the ranks."""
    rows = t.lineitem.select(*NUMERIC)
    guessed = profile_columns(rows, exact=False).select("column_name", "row_count", F.col("distinct_count").alias("guess"))
    exact = value_stats(rows, NUMERIC).select("column_name", "distinct_count")
    found = profile_quantiles(rows, NUMERIC, PROBS, exact=False).collect()
    spots = rows.agg(
        *[F.avg((F.col(r["column_name"]) < r["quantile"]).cast("double")).alias(f"below{at}") for at, r in enumerate(found)],
        *[F.avg((F.col(r["column_name"]) <= r["quantile"]).cast("double")).alias(f"upto{at}") for at, r in enumerate(found)],
    ).first()
    fits = dict.fromkeys(NUMERIC, True)
    for at, r in enumerate(found):
        fits[r["column_name"]] &= spots[f"below{at}"] - 0.01 <= r["prob"] <= spots[f"upto{at}"] + 0.01
    told = F.create_map(*[F.lit(x) for item in fits.items() for x in item])[F.col("column_name")]
    near = F.abs(F.col("guess") - F.col("distinct_count")) <= 0.15 * F.col("distinct_count")
    return guessed.join(exact, "column_name").select(
        "column_name", "row_count", "distinct_count", near.alias("distinct_within"), told.alias("quantiles_within")
    )


@query(
    "profile_histogram",
    """
    with ends as (select min(l_extendedprice) as low, max(l_extendedprice) as high from {lineitem}),
    found as (select cast(least(floor((l_extendedprice - low) / ((high - low) / 20)), 19) as int) as bin, count(*) as n
              from {lineitem}, ends group by 1)
    select cast(b.bin as int) as bin, low + b.bin * ((high - low) / 20) as low,
      low + (b.bin + 1) * ((high - low) / 20) as high, coalesce(n, 0) as records
    from range(20) b(bin) left join found f on f.bin = b.bin, ends
    """,
)
def _profile_histogram(spark, t):
    return profile_histogram(t.lineitem, "l_extendedprice", 20)
