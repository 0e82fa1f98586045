"""Similarity join of documents by the Jaccard similarity of their word shingles, as components.

1. Documents with equal shingle sets are one class. Classes with equal prefix and size are one
   group (a prefix is the part of a set, in a fixed order of all shingles, of which two sets that
   are similar enough must share an element). Rare shingles come first in the order, so that
   frequent passages stay out of prefixes. Any order is right; frequencies only save work.
2. Groups meet on shared prefix shingles if their sizes and the places of the shingle allow enough
   overlap; group pairs are expanded into pairs of members, and those verified on whole sets.
3. Not every pair needs to be verified to know components. A first round joins short posting lists
   in full, and long ones only with one entry of the same size band. A second round takes
   all pairs of long lists that are still in different components. So a group of many similar
   documents costs pairs in proportion to its size, and no link between components is lost.

Frequencies: each task packs sorted key gaps by key range, ranges are merged in tasks of about
equal size, and come back as two tables of fixed size (frequent keys; cells of keys met twice).
Sets are equal if their 128-bit digests are; shingles are told apart by 64-bit hashes, and in
verification by 48 bits of them.

Defined results: see ``similar_components``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayside.llm.components import components
from quayside.llm.shingles import BITS, WordHashes, bits_allow, parity_bits, shingle_set
from quayside.session import durable

#: Percent of the union that must be shared.
PERCENT = 80
FREQUENT_FROM = 5
FREQUENT_KEYS = 500_000  # 4.5 MB, the most that is broadcast of frequent keys
CELL_BITS = 28  # 32 MB of bits at most, broadcast: cells of keys that occur twice or more
WANTED_BITS = 26  # 8 MB of bits, broadcast: cells of rows that are wanted
FLUSH = 2_000_000  # shingles that a task holds before it packs them
LONG_LIST = 16


def _pack(values: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted values as gaps, byte planes apart, then their counts; compressed."""
    gaps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    planes = np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes + np.minimum(counts, 65535).astype("<u2").tobytes())


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    n = len(raw) // 10
    gaps = np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view("<u8").ravel()
    return np.cumsum(gaps, dtype=np.uint64), raw[8 * n :].view("<u2").astype(np.int64)


def _texts(batches: Iterator[pa.RecordBatch], wanted: Callable[[object], bool] | None = None) -> Iterator[tuple[object, str | None]]:
    """Ids and texts, of the wanted ids only if they are named."""
    for batch in batches:
        if wanted is not None:
            batch = batch.take(pa.array([i for i, key in enumerate(batch.column(0).to_pylist()) if wanted(key)], pa.int64()))
        ids = batch.column(0)
        for start in range(0, batch.num_rows, 512):
            part = batch.column(1).slice(start, 512).to_pylist()
            yield from zip(ids.slice(start, 512).to_pylist(), part)


def _shingle_keys() -> Callable[[str | None], np.ndarray]:
    hashes = WordHashes()
    return lambda text: shingle_set(text, hashes)


def _key_ranges(key_bits: int, range_bits: int, finder: Callable):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys_of, held, n = finder(), [], 0

        def flush() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            of = keys >> np.uint64(key_bits - range_bits)
            ranges, first = np.unique(of, return_index=True)
            ends = np.append(first[1:], len(keys))
            data = [_pack(keys[a:b], counts[a:b]) for a, b in zip(first, ends)]
            return pa.RecordBatch.from_arrays([pa.array(ranges.astype(np.int32)), pa.array(data, pa.binary())], ["range", "keys"])

        for _, text in _texts(batches):
            found = keys_of(text) >> np.uint64(64 - key_bits)
            if len(found):
                held.append(found)
                n += len(found)
            if n >= FLUSH:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()

    return pack


def _merge_range(key_bits: int, range_bits: int, keep: int):
    cells_of = max(CELL_BITS - range_bits, 3)

    def merge(table: pa.Table) -> pa.Table:
        parts = [_unpack(x) for x in table.column("keys").to_pylist()]
        values = np.concatenate([v for v, _ in parts])
        order = np.argsort(values, kind="stable")
        values, counts = values[order], np.concatenate([c for _, c in parts])[order]
        first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
        values, counts = values[first], np.add.reduceat(counts, first)
        again = values[counts >= 2]
        frequent = np.flatnonzero(counts >= FREQUENT_FROM)
        if len(frequent) > keep:
            frequent = np.sort(frequent[np.argsort(-counts[frequent], kind="stable")[:keep]])
        inside = (again >> np.uint64(key_bits - range_bits - cells_of)) & np.uint64((1 << cells_of) - 1)
        bits = np.zeros(1 << cells_of, bool)
        bits[inside.astype(np.int64)] = True
        levels = np.log2(counts[frequent]).astype(np.uint8)
        out = [
            pa.array([table.column("range")[0].as_py()], pa.int32()),
            [zstandard.compress(np.packbits(bits, bitorder="little").tobytes())],
            [values[frequent].astype("<u8").tobytes()],
            [levels.tobytes()],
        ]
        return pa.table(out, names=["range", "cells", "keys", "levels"])

    return merge


class Frequencies:
    """What is known of shingle frequencies: a level for frequent keys, and which cells repeat."""

    def __init__(self, key_bits: int, keys: np.ndarray, levels: np.ndarray, cells: np.ndarray, cell_bits: int):
        self.key_bits, self.keys, self.levels, self.cells, self.cell_bits = key_bits, keys, levels, cells, cell_bits

    def __getstate__(self):
        return self.__dict__ | {"cells": zstandard.compress(self.cells.tobytes())}

    def __setstate__(self, state):
        self.__dict__.update(state, cells=np.frombuffer(zstandard.decompress(state["cells"]), np.uint8))

    def level(self, shingles: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(shingles), np.uint8)
        key = shingles >> np.uint64(64 - self.key_bits)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.levels[at], 0).astype(np.uint8)

    def repeats(self, shingles: np.ndarray) -> np.ndarray:
        cell = (shingles >> np.uint64(64 - self.cell_bits)).astype(np.int64)
        return (self.cells[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1


def count_keys(docs: DataFrame, finder: Callable = _shingle_keys, likely_each: int = 600) -> Frequencies:
    """Frequencies over all keys of ``id, text``: by default the shingles of the text.

    ``finder()`` gives a task the function from a text to its 64-bit keys; ``likely_each``, about
    how many a text has, only chooses the number of key ranges.
    """
    likely = max(docs.count() * likely_each, 1)
    range_bits = min(max(math.ceil(math.log2(likely / 2_000_000)), 3) if likely > 2_000_000 else 3, CELL_BITS - 3)
    key_bits = min(max(math.ceil(math.log2(likely)) + 6, CELL_BITS + 3), 56)
    packed = docs.mapInArrow(_key_ranges(key_bits, range_bits, finder), "range int, keys binary")
    merged = packed.groupBy("range").applyInArrow(
        _merge_range(key_bits, range_bits, FREQUENT_KEYS >> range_bits or 1),
        "range int, cells binary, keys binary, levels binary",
    )
    width = (1 << max(CELL_BITS - range_bits, 3)) // 8
    cells = np.zeros(width << range_bits, np.uint8)
    keys, levels = [], []
    # At most CELL_BITS bits and FREQUENT_KEYS keys in all, whatever the input.
    for row in sorted(merged.collect(), key=lambda r: r["range"]):
        cells[row["range"] * width : (row["range"] + 1) * width] = np.frombuffer(zstandard.decompress(bytes(row["cells"])), np.uint8)
        keys.append(np.frombuffer(bytes(row["keys"]), "<u8"))
        levels.append(np.frombuffer(bytes(row["levels"]), np.uint8))
    none = np.zeros(0, np.uint64)
    bits = range_bits + max(CELL_BITS - range_bits, 3)
    return Frequencies(key_bits, np.concatenate(keys or [none]), np.concatenate(levels or [none.astype(np.uint8)]), cells, bits)


def prefix_length(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


SIGNED = "<i8"
PREFIX_SCHEMA = "id bigint, n bigint, set string, grouped string, tokens array<struct<token: bigint, place: int>>, " + ", ".join(
    f"{b} bigint" for b in BITS
)


def _prefixes(known):
    """``set``: digest of the whole set. ``grouped``: of prefix and size. ``tokens``: the part of the prefix that may meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, freq = WordHashes(), known.value
        rows: list[list] = [[], [], [], [], [], []]
        held = 0

        def out() -> pa.RecordBatch:
            ids, ns, sets, groups, tokens, bits = rows
            lengths = [len(t) for t, _ in tokens]
            both = pa.StructArray.from_arrays(
                [
                    pa.array(np.concatenate([t for t, _ in tokens]).view(np.int64), pa.int64()),
                    pa.array(np.concatenate([p for _, p in tokens]).astype(np.int32), pa.int32()),
                ],
                ["token", "place"],
            )
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *lengths]).astype(np.int32)), both)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(sets), pa.array(groups), lists,
                    *(pa.array(np.ascontiguousarray(word), pa.int64()) for word in np.array(bits).T),
                ],
                ["id", "n", "set", "grouped", "tokens", *BITS],
            )

        for key, text in _texts(batches):
            s = shingle_set(text, hashes)
            n = len(s)
            level = freq.level(s)
            # Sets are sorted, so a stable sort by level gives (level, hash).
            order = np.argsort(level, kind="stable")[: prefix_length(n)] if level.any() else np.arange(prefix_length(n) if n else 0)
            prefix = s[order]
            may = np.flatnonzero(freq.repeats(prefix)) if n else np.zeros(0, np.int64)
            for column, value in zip(
                rows,
                (key, n, xxhash.xxh3_128_hexdigest(s.tobytes()), xxhash.xxh3_128_hexdigest(prefix.tobytes() + n.to_bytes(8, "little")), (prefix[may], may), parity_bits(s)),
            ):
                column.append(value)
            held += len(may)
            if held >= 200_000 or len(rows[0]) >= 4096:
                yield out()
                rows, held = [[], [], [], [], [], []], 0
        if rows[0]:
            yield out()

    return run


SETS_SCHEMA = "c bigint, shingles binary"


def _cell(digest: str) -> int:
    return int(digest[:8], 16) >> (32 - WANTED_BITS)


def _short(shingles: np.ndarray) -> bytes:
    """The first 48 bits of each hash, which is what verification compares."""
    return shingles.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def _long(data) -> np.ndarray:
    part = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return np.ascontiguousarray(np.pad(part, ((0, 0), (2, 0)))).view("<u8").ravel()


def _whole_sets(wanted):
    """Sets of the rows whose id stands for a wanted class, each once for a task; a few others share a cell with one.

    Rows are told by their id, before their text is looked at: only wanted ones are cut into shingles.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, cells = WordHashes(), wanted.value
        keys, data, held, seen = [], [], 0, set()
        for key, text in _texts(batches, lambda key: is_wanted(cells, str(key))):
            found = shingle_set(text, hashes)
            number = _class_number(xxhash.xxh3_128_hexdigest(found.tobytes()))
            if len(found) and number not in seen:
                seen.add(number)
                keys.append(number)
                data.append(_short(found))
                held += len(data[-1])
                if held > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(data, pa.binary())], ["c", "shingles"])
                    keys, data, held = [], [], 0
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(data, pa.binary())], ["c", "shingles"])

    return run


def _class_number(digest: str) -> int:
    """The first 64 bits of a digest, signed: short keys for joins."""
    value = int(digest[:16], 16)
    return value - (1 << 64) if value >> 63 else value


SLICE_BITS = 15


def _wanted_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wanted cells of a task as slices of one bit table."""
    cells = [_cell(xxhash.xxh3_128_hexdigest(name)) for b in batches for name in b.column(0).to_pylist()]
    at = np.unique(np.array(cells, np.int64))
    for k in np.unique(at >> SLICE_BITS):
        bits = np.zeros(1 << SLICE_BITS, bool)
        bits[at[at >> SLICE_BITS == k] & ((1 << SLICE_BITS) - 1)] = True
        packed = zstandard.compress(np.packbits(bits, bitorder="little").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([int(k)], pa.int32()), pa.array([packed], pa.binary())], ["slice", "bits"])


def _merge_slices(table: pa.Table) -> pa.Table:
    bits = np.zeros((1 << SLICE_BITS) // 8, np.uint8)
    for x in table.column("bits").to_pylist():
        bits |= np.frombuffer(zstandard.decompress(x), np.uint8)
    return pa.table([pa.array([table.column("slice")[0].as_py()], pa.int32()), [zstandard.compress(bits.tobytes())]], names=["slice", "bits"])


def is_wanted(cells: np.ndarray, name: str) -> bool:
    cell = _cell(xxhash.xxh3_128_hexdigest(name))
    return bool(cells[cell >> 3] >> (cell & 7) & 1)


def wanted_cells(wanted: DataFrame) -> np.ndarray:
    """One bit table of fixed size for a column of names; each slice of it comes back once."""
    slices = wanted.mapInArrow(_wanted_slices, "slice int, bits binary").groupBy("slice")
    width = (1 << SLICE_BITS) // 8
    cells = np.zeros((1 << WANTED_BITS) // 8, np.uint8)
    for row in slices.applyInArrow(_merge_slices, "slice int, bits binary").toLocalIterator():
        cells[row["slice"] * width : (row["slice"] + 1) * width] = np.frombuffer(zstandard.decompress(bytes(row["bits"])), np.uint8)
    return cells


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= PERCENT * (len(a) + len(b) - shared)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
        keep = [
            similar(_long(a.as_buffer()), _long(b.as_buffer()))
            for a, b in zip(batch.column("a"), batch.column("b"))
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array([v for v, k in zip(x, keep) if k], pa.int64()), pa.array([v for v, k in zip(y, keep) if k], pa.int64())], ["u", "v"]
        )


def _may_link(a: str, b: str) -> Column:
    """Sizes near enough, and enough room behind the shared shingle in both sets.

    For the first shingle that two prefixes share this bound holds; a pair that fails it at a later
    one has passed it at the first.
    """
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    need = F.ceil(PERCENT * (n + m) / F.lit(100 + PERCENT))
    sizes = 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)
    return sizes & (F.least(n - F.col(f"{a}.place"), m - F.col(f"{b}.place")) >= need)


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(f"{a}.g", f"{b}.g").alias("g"), F.greatest(f"{a}.g", f"{b}.g").alias("h")]


def _first_pairs(postings: DataFrame, sizes: DataFrame) -> DataFrame:
    """All pairs of short lists; in long ones each entry with the head of its size band and of the one below.

    The head has the fewest rarer shingles of its own before the shared one, so it is the text that
    the others were most likely made from, and links with as many of them as any can.
    """
    entry = F.struct("place", "n", "g")
    short = postings.join(sizes.where(F.col("entries") <= LONG_LIST).select("token"), "token")
    lists = short.groupBy("token").agg(F.collect_list(entry).alias("list"))
    ab = lists.select("list", F.posexplode("list").alias("k", "a")).select("a", F.explode(F.slice(F.col("list"), F.col("k") + 2, F.lit(LONG_LIST))).alias("b"))
    # The band is left by a factor of 1.25 in size, the most that two similar sets differ by.
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / PERCENT)).cast("int")
    long = postings.join(sizes.where(F.col("entries") > LONG_LIST).select("token"), "token").withColumn("band", band)
    heads = long.groupBy("token", "band").agg(F.min(entry).alias("a"))
    reach = heads.union(heads.select("token", F.col("band") + 1, "a"))
    ends = long.select("token", "band", entry.alias("b")).join(reach, ["token", "band"]).select("a", "b")
    return ab.union(ends).where(_may_link("a", "b") & (F.col("a.g") != F.col("b.g"))).select(*_pair("a", "b")).distinct()


def _open_pairs(postings: DataFrame, sizes: DataFrame, labels: DataFrame) -> DataFrame:
    """All pairs of long lists whose groups are not yet all in one component."""
    long = postings.join(sizes.where(F.col("entries") > LONG_LIST).select("token"), "token").join(labels, "g")
    mixed = long.groupBy("token").agg(F.min("low").alias("low"), F.max("high").alias("high")).where(F.col("low") != F.col("high")).select("token")
    entry = F.struct("n", "g", "place", "low", "high")
    left = long.join(mixed, "token").select("token", entry.alias("a"))
    both = left.join(left.select("token", F.col("a").alias("b")), "token").where(F.col("a.g") < F.col("b.g"))
    apart = (F.least("a.low", "b.low") != F.greatest("a.high", "b.high"))
    return both.where(apart & _may_link("a", "b")).select(*_pair("a", "b")).distinct()


def similar_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row; ``component_id`` is the least id reachable by links.

    Null and wordless texts have an empty set, link with nothing and are their own component, also
    if they are equal. Rows that repeat an id or a text come back as often as they came. A null id
    is no candidate for the least id; a component of null ids has none. Other columns are not read.
    An empty table gives an empty one.
    """
    spark = docs.sparkSession
    ids = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    known = spark.sparkContext.broadcast(count_keys(ids))
    rows = durable(ids.mapInArrow(_prefixes(known), PREFIX_SCHEMA), "prefixes")
    number = F.conv(F.substring("set", 1, 16), 16, -10).cast("long")
    full = rows.where(F.col("n") > 0)
    groups = full.groupBy(F.xxhash64("grouped").alias("g")).agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))
    classes = durable(
        full.groupBy("set")
        .agg(F.min("id").alias("id"), F.first(F.xxhash64("grouped")).alias("g"), *[F.first(c).alias(c) for c in ("n", *BITS)])
        .withColumn("c", number),
        "classes",
    )
    sizes_and_bits = classes.select("c", F.struct("n", *BITS).alias("end"))

    def likely(pairs: DataFrame) -> DataFrame:
        """Pairs that neither sizes nor parity bits rule out; whole sets are fetched for those alone."""
        ends = pairs.join(sizes_and_bits.toDF("x", "a"), "x").join(sizes_and_bits.toDF("y", "b"), "y")
        return ends.where(bits_allow("a", "b", PERCENT)).select("x", "y")

    heads = classes.groupBy("g").agg(F.min("c").alias("c"), F.count(F.lit(1)).alias("members"))
    postings = durable(
        groups.select("g", "n", F.explode("tokens").alias("t")).select("t.token", "t.place", "n", "g"), "postings"
    )
    sizes = durable(postings.groupBy("token").agg(F.count(F.lit(1)).alias("entries")).where(F.col("entries") > 1), "lists")

    def verified(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.col("x").alias("c")).union(pairs.select(F.col("y").alias("c"))).distinct()
        wanted = spark.sparkContext.broadcast(
            wanted_cells(classes.join(ends, "c").select(F.coalesce(F.col("id").cast("string"), F.lit("None"))))
        )
        sets = durable(ids.mapInArrow(_whole_sets(wanted), SETS_SCHEMA), "sets")
        met = pairs.join(sets.select(F.col("c").alias("y"), F.col("shingles").alias("b")), "y").join(
            sets.select(F.col("c").alias("x"), F.col("shingles").alias("a")), "x"
        )
        return durable(met.select("x", "y", "a", "b").mapInArrow(_verify, "u bigint, v bigint"), "verified")

    member = classes.select("g", "c")
    found = durable(_first_pairs(postings, sizes), "pairs")
    one = member.withColumnRenamed("c", "y").withColumnRenamed("g", "h")
    other = member.withColumnRenamed("c", "x")
    head = heads.select("g", F.col("c").alias("x"))
    stars = (
        found.join(head, "g").join(one, "h").select("x", "y")
        .union(found.join(other, "g").join(head.toDF("h", "y"), "h").select("x", "y"))
        .union(member.toDF("g", "y").join(head, "g").where(F.col("x") != F.col("y")).select("x", "y"))
    )
    first = durable(stars.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(), "pairs")
    links = verified(durable(likely(first), "likely"))
    reached = components(links)

    def labelled(reached: DataFrame) -> DataFrame:
        under = reached.select(F.col("v").alias("c"), F.col("c").alias("top"))
        return classes.join(under, "c", "left").select("set", "id", "g", "c", F.coalesce("top", "c").alias("root"))

    # What is left: pairs of long lists, and members of large groups, in different components.
    now = durable(labelled(reached), "labels")
    spread = now.groupBy("g").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    crowded = heads.where(F.col("members") > 1).select("g")
    old = found.join(crowded, "g", "left_semi").union(found.join(crowded.toDF("h"), "h", "left_semi").select("g", "h"))
    inside = crowded.select("g", F.col("g").alias("h"))
    more = _open_pairs(postings, sizes, spread).union(old).union(inside).distinct()
    left = now.select("g", F.col("c").alias("x"), F.col("root").alias("p"))
    right = left.toDF("h", "y", "q")
    rest = (
        more.join(left, "g").join(right, "h").where((F.col("p") != F.col("q")) & (F.col("x") != F.col("y")))
        .select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
        .join(first, ["x", "y"], "left_anti")
    )
    rest = durable(rest, "pairs")
    rest = durable(likely(rest), "likely")
    more_links = None if rest.isEmpty() else verified(rest)
    if more_links is not None and not more_links.isEmpty():
        now = durable(labelled(components(links.union(more_links))), "labels")
    least = now.groupBy("root").agg(F.min("id").alias("component_id"))
    answer = now.join(least, "root").select("set", "component_id")
    return (
        rows.select("id", "n", "set").join(answer, "set", "left")
        .select(
            F.col("id").alias(doc_id),
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        )
    )
