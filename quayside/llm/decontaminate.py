"""Benchmark decontamination: SimHash fingerprints of item-sized windows, then exact similarity.

1. Every five-word shingle of the documents is looked up among the benchmark's, which marks places
   in the documents for each length of items. A window of that length that is similar enough holds
   at least ``least_shared`` marked places, wherever parts of the item have been moved to; all
   starts with so many are taken, found by the distance of each marked place to the one that many on.
2. Windows and items get 64-bit SimHash fingerprints over their weighted shingles.
3. Fingerprints are cut into blocks. Two of them within ``radius`` bits differ by at most
   ``radius // blocks`` bits in some block, so items are filed under every block value within that
   distance, and windows look up their own block values: all pairs within the radius meet.
4. Pairs within the radius are verified by the weighted Jaccard similarity of their shingles, the
   weight of a shingle being how often it stands in the window.

Windows are shuffled, never documents. The benchmark's shingles and filed fingerprints are
broadcast only below a counted limit; above it Spark joins by shuffle.

Defined results: null and wordless texts or items match nothing; a text of fewer than five words is
one shingle; an item longer than a document is compared with the whole document; repeated rows with
the same id and text count as one; of equally similar windows those that hold some shingle where an
item of their length holds it come first, then the first start; an empty side gives an empty table. Only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.exprs import ascii_lower, let, word_array
from quayside.session import durable

SHINGLE = 5
BITS = 64
#: Rows of the benchmark side that may be broadcast: under 100 MB.
BROADCAST_ROWS = 1_000_000


def _shingle(words: Column, i: Column, size: int) -> Column:
    """Hash of the shingle from word ``i``; words past the end are null and do not count."""
    return F.xxhash64(*(F.get(words, i + k) for k in range(size)))


def _shingles(words: Column, size: int) -> Column:
    n = F.size(words)
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - size, F.lit(0))), lambda i: _shingle(words, i, size)))


def simhash(shingles: Column) -> Column:
    """Bit b is set where more shingles (each as often as it occurs) have it set than not."""
    zero = F.array(*([F.lit(0)] * BITS))
    counts = F.aggregate(
        shingles,
        zero,
        lambda acc, h: F.transform(
            acc, lambda n, b: n + F.when(F.getbit(h, b) == 1, F.lit(1)).otherwise(F.lit(-1))
        ),
    )
    return F.aggregate(
        F.transform(counts, lambda n, b: F.when(n > 0, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))),
        F.lit(0).cast("long"),
        lambda acc, x: acc.bitwiseOR(x),
    )


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard of two arrays of shingle hashes: shared occurrences over all occurrences.

    Each distinct shingle that both have counts once, and then its further occurrences on both sides:
    those are found next to their like in sorted order, so the work grows with the arrays' length, but for
    texts that repeat many different shingles.
    """

    def again(side: Column) -> Column:
        return let(F.array_sort(side), lambda s: F.filter(s, lambda x, i: (i > 0) & (x == F.get(s, i - 1))))

    def further(x: Column, y: Column) -> Column:
        times = lambda side, h: F.size(F.filter(side, lambda v: v == h))
        return F.aggregate(F.array_intersect(x, y), F.lit(0), lambda acc, h: acc + F.least(times(x, h), times(y, h)))

    shared = F.size(F.array_intersect(a, b)) + let(again(a), lambda x: let(again(b), lambda y: further(x, y)))
    return let(shared, lambda n: n.cast("double") / (F.size(a) + F.size(b) - n))


def block_masks(bits: int, distance: int) -> list[int]:
    """All changes of at most ``distance`` bits to a block value."""
    return [sum(1 << k for k in chosen) for d in range(distance + 1) for chosen in combinations(range(bits), d)]


def bounded(df: DataFrame) -> DataFrame:
    """Marked for broadcast if counted small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _hits(lowered: DataFrame, items: DataFrame, length: int) -> DataFrame:
    """``doc_id, digest, n_doc, p, n_words, qs``: shingles of ``length`` words that documents and items share."""
    of = (F.col("n_words") >= length) if length == SHINGLE else (F.col("n_words") == length)
    places = (
        items.where(of)
        .select("n_words", F.posexplode("item_shingles").alias("q", "shingle"))
        .groupBy("n_words", "shingle")
        .agg(F.collect_set("q").alias("qs"))
    )
    return (
        lowered.where(F.size("words") >= length)
        .select("doc_id", "digest", "words", F.explode(F.sequence(F.lit(0), F.size("words") - length)).alias("p"))
        .select("doc_id", "digest", F.size("words").alias("n_doc"), "p", _shingle(F.col("words"), F.col("p"), length).alias("shingle"))
        .join(bounded(places), "shingle")
        .drop("shingle")
    )


def least_shared(n_window: Column, n_item: Column, threshold: float) -> Column:
    """Shared occurrences that a similarity of ``threshold`` takes, of so many shingles on each side; at least one."""
    least = F.ceil((n_window + n_item) * F.lit(threshold / (1 + threshold)) - F.lit(1e-9))
    return F.greatest(F.lit(1), least.cast("int"))


def _starts(hits: DataFrame, threshold: float) -> DataFrame:
    """``doc_id, digest, n_words, start, aligned``: every window with enough marked places.

    A start belongs to the first marked place in its window, so each is made once.
    """
    key = ["doc_id", "digest", "n_doc", "n_words"]
    held = lambda n: F.greatest(n - (SHINGLE - 1), F.lit(1))
    n_item, n_window = held(F.col("n_words")), held(F.least("n_words", "n_doc"))
    last = F.greatest(F.lit(0), F.col("n_doc") - F.col("n_words"))
    at = lambda i: F.get("places", i)
    low = lambda p, i: F.greatest(
        F.lit(0), F.coalesce(at(i - 1) + 1, F.lit(0)), at(i + F.col("least") - 1) - F.col("n_window") + 1
    )
    ranges = F.transform("places", lambda p, i: F.struct(low(p, i).alias("low"), F.least(p, F.col("last")).alias("high"), (at(i + F.col("least") - 1)).alias("end")))
    full = (
        hits.groupBy(*key)
        .agg(F.sort_array(F.collect_set("p")).alias("places"))
        .withColumn("n_window", n_window)
        .withColumn("least", least_shared(n_window, n_item, threshold))
        .withColumn("last", last)
        .select(*key, F.explode(F.filter(ranges, lambda r: r["end"].isNotNull() & (r["low"] <= r["high"]))).alias("r"))
        .select(*key, F.explode(F.sequence("r.low", "r.high")).alias("start"), F.lit(True).alias("full"), F.lit(False).alias("aligned"))
    )
    # A window that would leave the document is moved inside it.
    moved = F.transform("qs", lambda q: F.greatest(F.lit(0), F.least(F.col("p") - q, last)))
    aligned = hits.select(*key, F.explode(moved).alias("start"), F.lit(False).alias("full"), F.lit(True).alias("aligned"))
    return (
        full.unionByName(aligned)
        .groupBy(*key, "start")
        .agg(F.max("full").alias("full"), F.max("aligned").alias("aligned"))
        .where("full")
        .select("doc_id", "digest", "n_words", "start", "aligned")
    )


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    radius: int = 23,
    blocks: int = 8,
    threshold: float = 0.8,
) -> DataFrame:
    """``doc_id, item_id, start, n_words, hamming, similarity``: the best window of each pair."""
    size = SHINGLE
    if BITS % blocks:
        raise ValueError(f"blocks must divide {BITS}")
    width = BITS // blocks
    items = (
        benchmark.select(F.col(item_id).alias("item_id"), word_array(ascii_lower(F.col(item_text))).alias("words"))
        .where(F.size("words") > 0)
        .select("item_id", F.size("words").alias("n_words"), _shingles(F.col("words"), size).alias("item_shingles"))
    )
    # Rows are told apart by id and text, so that windows can be cut after their starts are known.
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("digest"))
    lowered = read.select("doc_id", "digest", word_array(ascii_lower(F.col("text"))).alias("words"))
    # Items below the shingle size are looked up by their whole sequence; at most size - 1 lengths.
    short = [r["n_words"] for r in items.where(F.col("n_words") < size).select("n_words").distinct().collect()]
    hits = durable(reduce(DataFrame.unionByName, (_hits(lowered, items, length) for length in [size, *sorted(short)])), "hits")
    starts = durable(_starts(hits, threshold), "starts")
    found = starts.groupBy(F.col("doc_id").alias("found_id"), F.col("digest").alias("found_digest")).agg(
        F.collect_list(F.struct("start", "n_words", "aligned")).alias("cuts")
    )
    same = (F.col("digest") == F.col("found_digest")) & F.col("doc_id").eqNullSafe(F.col("found_id"))
    # Both sides are written: fingerprints are then computed once, not again for every block of theirs.
    windows = durable(
        read.join(F.broadcast(found) if starts.count() <= BROADCAST_ROWS else found, same)
        .select("doc_id", word_array(ascii_lower(F.col("text"))).alias("words"), F.explode("cuts").alias("cut"))
        .select("doc_id", "words", "cut.*")
        .select("doc_id", "start", "n_words", "aligned", F.slice("words", F.col("start") + 1, F.col("n_words")).alias("window"))
        .distinct()
        .withColumn("shingles", _shingles(F.col("window"), size))
        .select("doc_id", "start", "n_words", "aligned", "shingles", simhash(F.col("shingles")).alias("print")),
        "windows",
    )
    prints = durable(items.withColumn("print", simhash(F.col("item_shingles"))), "items")
    low = (1 << width) - 1
    block = lambda k: F.shiftrightunsigned("print", k * width).bitwiseAND(F.lit(low)).cast("int")
    cut = F.array(*(F.struct(F.lit(k).alias("block"), block(k).alias("value")) for k in range(blocks)))
    masks = F.array(*(F.lit(m) for m in block_masks(width, radius // blocks)))
    filed = (
        prints.withColumn("cut", F.explode(cut))
        .withColumn("mask", F.explode(masks))
        .select(
            "item_id",
            F.col("n_words"),
            F.col("print").alias("item_print"),
            F.col("cut.block").alias("block"),
            F.col("cut.value").bitwiseXOR(F.col("mask")).alias("value"),
        )
    )
    hamming = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    near = (
        windows.withColumn("cut", F.explode(cut))
        .select("doc_id", "start", "n_words", "aligned", "shingles", "print", "cut.block", "cut.value")
        .join(bounded(filed), ["n_words", "block", "value"])
        .withColumn("hamming", hamming.cast("int"))
        .where(F.col("hamming") <= radius)
        .select("doc_id", "item_id", "start", "n_words", "aligned", "hamming", "shingles")
        .distinct()
    )
    verified = (
        near.join(bounded(prints.select("item_id", "item_shingles")), "item_id")
        .withColumn("similarity", similarity(F.col("shingles"), F.col("item_shingles")))
        .where(F.col("similarity") >= threshold)
    )
    best = F.max_by(F.struct("start", "n_words", "hamming", "similarity"), F.struct("similarity", "aligned", -F.col("start")))
    return verified.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")


def without_leaks(docs: DataFrame, leaks: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents that hold no benchmark item; rows without an id stay."""
    key = leaks.select(F.col("doc_id").alias(doc_id)).distinct()
    return docs.join(key, doc_id, "left_anti").select(*docs.columns)
