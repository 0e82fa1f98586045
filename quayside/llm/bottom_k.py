"""Near-duplicate documents by bottom-k sketches of their word shingles under one hash function.

A document's sketch holds the least hash values of its shingle set, in order: all of a small set, 96
of a larger one. Inverted lists of retained values say which sketches overlap, the sketch of the
union estimates the similarity and drops pairs that are far below, and whole sets decide.

A list for each single value would hold a third of all documents where a word pair is that common.
Lists are therefore keyed by runs of adjacent retained values: where two sets are similar enough,
few values of the union's sketch are missing from either, so some run is whole in both.

- Sets of up to 120 values are retained whole, and among ``u`` values of which a fifth at most is not
  shared, runs of 2, 3 or 4 shared ones must exist (by counting; see ``_LENGTHS``). No link is lost.
- Of larger sets, runs of 5 among 96 values are used. At a similarity of exactly 0.8 the chance that
  none of them is shared is about 10^-6; at 0.85 it is about 10^-9.

Documents with equal sets are one class and meet once. First each class meets only two others: of the
heads of its lists (the class whose lists are longest, so the text that the others were most likely
made from) those that it shares most lists with. Links give components. Then, in lists that still hold
several components, the classes outside the largest meet all of the others there, unless their parity
bits rule a link out: a set's values are dealt into 512 bins, a bit says whether a bin holds an odd
number, and two sets differ in at least as many values as their bits differ. So a list of near copies, or
of texts that only share a passage, costs pairs in proportion to its length, and no link between
components is lost.

Defined results: see ``similar_rows``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayside.llm.components import components
from quayside.llm.ngram_join import is_wanted, wanted_cells
from quayside.llm.shingles import BIT_WORDS, BITS, WordHashes, bits_allow, parity_bits, shingle_set
from quayside.session import durable

PERCENT = 80
WORDS = 2
KEPT = 96  # values that are retained of a large set
WHOLE = KEPT * 100 // PERCENT  # sets up to this size are retained whole, so that either both of a linkable pair are, or both are large
#: Run length, and the set sizes it is used for. Two sets of these sizes that link share a run of it.
_LENGTHS = ((2, 4, 5), (3, 5, 20), (4, 16, WHOLE), (5, KEPT + 1, None))
PARTNERS = 2  # classes that each class meets first
ERROR = 1e-9  # chance that the estimate drops a pair that links
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def pack(values: np.ndarray) -> bytes:
    """The first 48 bits of each hash, in order."""
    return np.ascontiguousarray(values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack(data) -> np.ndarray:
    part = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return np.pad(part, ((0, 0), (2, 0))).view(">u8").ravel().astype(np.uint64)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """What is retained of a sorted set."""
    return shingles if len(shingles) <= WHOLE else shingles[:KEPT]


def run_keys(values: np.ndarray, n: int) -> np.ndarray:
    """Keys of the runs of adjacent retained values of a set with ``n`` shingles."""
    keys = []
    for length, least, most in _LENGTHS:
        if n >= least and (most is None or n <= most):
            use = values if most is not None else values[:KEPT]
            total = np.full(len(use) - length + 1, length, np.uint64)
            for k in range(length):
                total += use[k : len(use) - length + 1 + k] * _MIX[k]
                total ^= total >> np.uint64(29)
            keys.append(total * _MIX[3])
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


def least_shared(n: int) -> int:
    """Of ``n`` values of a union's sketch, how many must be shared not to rule out a link, but for ``ERROR``."""
    p, total = PERCENT / 100, 0.0
    for k in range(n + 1):
        total += math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log(1 - p))
        if total > ERROR:
            return k
    return n


_LEAST = np.array([least_shared(n) for n in range(2 * WHOLE + 1)])


def _common(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def may_link(a: np.ndarray, n: int, b: np.ndarray, m: int) -> tuple[bool, bool]:
    """Whether two sketches may be of sets that link, and whether that is certain because both are whole."""
    if n <= WHOLE and m <= WHOLE:
        shared = _common(a, b)
        return 100 * shared >= PERCENT * (n + m - shared), True
    limit = min(x[-1] for x, size in ((a, n), (b, m)) if size > WHOLE)
    a, b = (x[: np.searchsorted(x, limit, side="right")] for x in (a, b))
    shared = _common(a, b)
    union = len(a) + len(b) - shared
    return shared >= _LEAST[min(union, len(_LEAST) - 1)], False


ROWS = "id bigint, n bigint, set binary, sketch binary, " + ", ".join(f"{b} bigint" for b in BITS)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            sets = [shingle_set(text, hashes, WORDS) for text in part.column(1).to_pylist()]
            bits = np.array([parity_bits(s) for s in sets]).reshape(-1, BIT_WORDS)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([pack(sketch(s)) for s in sets], pa.binary()),
                    *(pa.array(np.ascontiguousarray(column), pa.int64()) for column in bits.T),
                ],
                ["id", "n", "set", "sketch", *BITS],
            )


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            sizes = part.column(1).to_numpy()
            keys = [run_keys(unpack(s.as_buffer()), n) for s, n in zip(part.column(2), sizes.tolist())]
            lengths = np.fromiter(map(len, keys), np.int64, len(keys))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(keys).view(np.int64)),
                    pa.array(np.repeat(part.column(0).to_numpy(), lengths)),
                ],
                ["key", "c"],
            )


def _estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, m = batch.column("n").to_pylist(), batch.column("m").to_pylist()
        told = [
            may_link(unpack(a.as_buffer()), i, unpack(b.as_buffer()), j)
            for a, b, i, j in zip(batch.column("a"), batch.column("b"), n, m)
        ]
        keep = pa.array([t[0] for t in told], pa.bool_())
        out = pa.RecordBatch.from_arrays(
            [batch.column("x"), batch.column("y"), pa.array([bool(t[1]) for t in told], pa.bool_())], ["x", "y", "sure"]
        )
        yield out.filter(keep)


def _whole_sets(cells):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bits = WordHashes(), cells.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                wanted = [i for i, key in enumerate(part.column(0).to_pylist()) if is_wanted(bits, str(key))]
                if not wanted:
                    continue
                sets = [shingle_set(text, hashes, WORDS) for text in part.column(1).take(pa.array(wanted)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array([pack(s) for s in sets], pa.binary())],
                    ["set", "shingles"],
                )

    return run


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for a, b in zip(batch.column("a"), batch.column("b")):
            x, y = unpack(a.as_buffer()), unpack(b.as_buffer())
            shared = _common(x, y)
            keep.append(100 * shared >= PERCENT * (len(x) + len(y) - shared))
        yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("y")], ["u", "v"]).filter(pa.array(keep, pa.bool_()))


def _may_link(a: str, b: str) -> Column:
    return bits_allow(a, b, PERCENT)


def _band() -> Column:
    """Sizes that differ by no more than links allow lie in one band or in neighbouring ones."""
    return F.floor(F.log(F.col("n").cast("double")) / math.log(100 / PERCENT)).cast("int")


def _near_bands() -> Column:
    return F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def _first_pairs(lists: DataFrame, members: DataFrame) -> DataFrame:
    """Each class with those ``PARTNERS`` heads of its lists that it shares most lists with.

    A list has a head in each size band: the class whose lists are longest in all.
    """
    placed = lists.select("key", "c").join(members.select("c", "band", "weight"), "c")
    heads = placed.groupBy("key", "band").agg(F.max(F.struct("weight", "c")).alias("head"))
    reach = heads.select("key", _near_bands().alias("band"), F.col("head.c").alias("h"))
    shared = placed.join(reach, ["key", "band"]).where(F.col("c") != F.col("h")).groupBy("c", "h").agg(F.count(F.lit(1)).alias("shared"))
    ends = members.select("c", F.struct("n", *BITS).alias("a")), members.select(F.col("c").alias("h"), F.struct("n", *BITS).alias("b"))
    may = shared.join(ends[0], "c").join(ends[1], "h").where(_may_link("a", "b"))
    # A class has at most as many candidates as lists, three times over.
    best = W.partitionBy("c").orderBy(F.desc("shared"), "h")
    chosen = may.select("c", "h", F.row_number().over(best).alias("place")).where(F.col("place") <= PARTNERS)
    return _ordered(chosen.select(F.col("c").alias("x"), F.col("h").alias("y")))


def _open_pairs(lists: DataFrame, members: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs within lists whose ends are in different components.

    Of two classes in different components one at least is outside the list's largest, so only those
    are paired with the whole list: a list of one component costs nothing, one with few strangers little.
    Near copies share dozens of lists, so a pair is made in the first list that both are in and nowhere else.
    """
    placed = lists.select("key", "c").join(roots, "c")
    parts = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
    mixed = parts.groupBy("key").agg(F.max(F.struct("size", "root")).alias("top"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    strange = placed.join(mixed.select("key", F.col("top.root").alias("major")), "key")
    # A class has a hundred lists or so; an entry knows those before its own.
    met = strange.join(strange.groupBy("c").agg(F.collect_list("key").alias("keys")), "c").join(members, "c")
    outside = F.col("root") != F.col("major")
    earlier = F.filter("keys", lambda key: key < F.col("key")).alias("earlier")
    entry = F.struct("c", "root", "n", outside.alias("outside"), earlier, *BITS)
    all_of = met.select("key", "band", entry.alias("a"))
    minor = met.where(outside).select("key", _near_bands().alias("band"), entry.alias("b"))
    apart = (F.col("a.root") != F.col("b.root")) & (~F.col("a.outside") | (F.col("a.c") < F.col("b.c"))) & _may_link("a", "b")
    first = ~F.arrays_overlap("a.earlier", "b.earlier")
    both = all_of.join(minor, ["key", "band"]).where(apart & first)
    return both.select(F.least("a.c", "b.c").alias("x"), F.greatest("a.c", "b.c").alias("y"))


class Classes:
    """Rows, their classes (equal sets), and the links between classes that decide components."""

    def __init__(self, docs: DataFrame, doc_id: str, text: str):
        self.spark = docs.sparkSession
        self.ids = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
        self.rows = durable(self.ids.mapInArrow(_sketches, ROWS), "sketches")
        grouped = self.rows.where("n > 0").groupBy("set").agg(
            F.min("id").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.count(F.lit(1)).alias("copies"),
            *[F.first(b).alias(b) for b in BITS],
        )
        # Numbers, written once: unlike digests or parts of them they cannot meet.
        self.classes = durable(grouped.withColumn("c", F.monotonically_increasing_id()), "classes")

    def lists(self) -> tuple[DataFrame, DataFrame]:
        """``key, c, entries``: the inverted lists with two entries or more; and the classes in them with size, bits and weight."""
        postings = self.classes.select("c", "n", "sketch").mapInArrow(_postings, "key bigint, c bigint")
        repeated = postings.groupBy("key").agg(F.count(F.lit(1)).alias("entries")).where("entries > 1")
        lists = durable(postings.join(repeated, "key"), "postings")
        weights = lists.groupBy("c").agg(F.sum(F.floor(F.log2("entries") * 16).cast("long")).alias("weight"))
        members = self.classes.select("c", "n", _band().alias("band"), *BITS).join(weights, "c")
        return lists, durable(members, "members")

    def linked(self, pairs: DataFrame) -> DataFrame:
        """``u, v``: those of the pairs ``x, y`` of classes that link."""
        known = self.classes.select("c", "n", "sketch")
        met = pairs.join(known.toDF("x", "n", "a"), "x").join(known.toDF("y", "m", "b"), "y")
        likely = durable(met.select("x", "y", "n", "m", "a", "b").mapInArrow(_estimate, "x bigint, y bigint, sure boolean"), "likely")
        sure = likely.where("sure").select(F.col("x").alias("u"), F.col("y").alias("v"))
        open_ = likely.where("not sure").select("x", "y")
        if open_.isEmpty():
            return sure
        ends = open_.select(F.col("x").alias("c")).union(open_.select("y")).distinct()
        wanted = durable(self.classes.join(ends, "c").select("c", "id", "set"), "wanted")
        cells = self.spark.sparkContext.broadcast(wanted_cells(wanted.select(F.coalesce(F.col("id").cast("string"), F.lit("None")))))
        found = self.ids.mapInArrow(_whole_sets(cells), "set binary, shingles binary")
        sets = durable(found.join(wanted, "set").groupBy("c").agg(F.first("shingles").alias("shingles")), "sets")
        both = open_.join(sets.toDF("x", "a"), "x").join(sets.toDF("y", "b"), "y").select("x", "y", "a", "b")
        return durable(sure.union(both.mapInArrow(_verify, "u bigint, v bigint")), "links")

    def _roots(self, links: DataFrame) -> DataFrame:
        under = components(links).select(F.col("v").alias("c"), F.col("c").alias("top"))
        return durable(self.classes.select("c").join(under, "c", "left").select("c", F.coalesce("top", "c").alias("root")), "roots")

    def resolve(self) -> tuple[DataFrame, DataFrame]:
        """``u, v`` (links between classes) and ``c, root`` (the component of every class)."""
        lists, members = self.lists()
        first = durable(_first_pairs(lists, members), "pairs")
        links = self.linked(first)
        roots = self._roots(links)
        rest = durable(_open_pairs(lists, members, roots).join(first, ["x", "y"], "left_anti"), "pairs")
        if not rest.isEmpty():
            more = self.linked(rest)
            if not more.isEmpty():
                links = links.union(more)
                # Components of components: a small graph, which settles in few rounds.
                ends = roots.toDF("u", "x"), roots.toDF("v", "y")
                between = more.join(ends[0], "u").join(ends[1], "v").select(F.col("x").alias("u"), F.col("y").alias("v"))
                under = components(between).select(F.col("v").alias("root"), F.col("c").alias("top"))
                roots = roots.join(under, "root", "left").select("c", F.coalesce("top", "root").alias("root"))
        return links, roots


def similar_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, n_copies`` for every row.

    ``component_id`` is the least id reachable by links, ``kept`` says that it is the row's own, and
    ``n_copies`` counts the rows with the same shingle set. Null and wordless texts have an empty set,
    link with nothing and are their own component; their ``n_copies`` is 1. Rows that repeat an id or
    a text come back as often as they came. A null id is no candidate for the least id; a component
    of null ids has none, and its rows are kept. Other columns are not read. An empty table gives an
    empty one.
    """
    found = Classes(docs, doc_id, text)
    _, roots = found.resolve()
    members = found.classes.select("c", "id", "set", "copies").join(roots, "c")
    least = members.groupBy("root").agg(F.min("id").alias("component"))
    answer = members.join(least, "root").select("set", "copies", "component", F.lit(True).alias("known"))
    component = F.when(F.col("known"), F.col("component")).otherwise(F.col("id"))
    return (
        found.rows.select("id", "n", "set").join(answer, "set", "left")
        .select(
            F.col("id").alias(doc_id),
            F.col("n").alias("n_shingles"),
            component.alias("component_id"),
            F.col("id").eqNullSafe(component).alias("kept"),
            F.coalesce("copies", F.lit(1)).alias("n_copies"),
        )
    )


def similar_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Every row with the number of its class (``doc_id, class``; none without words), and verified links ``u, v`` of classes.

    The links join every component; pairs that were in one component before they were met may be left out.
    """
    found = Classes(docs, doc_id, text)
    links, _ = found.resolve()
    member = found.rows.select("id", "set").join(found.classes.select("set", F.col("c").alias("class")), "set", "left")
    return member.select(F.col("id").alias(doc_id), "class"), links
