"""Removal of repeated byte strings by distributed prefix doubling.

A position's rank at length h is a 64-bit name of the h bytes from there on. The name at 2h is made
of the pair of names at p and p + h, so names at 8, 16, 32, 64 and, at offset 36, 100 bytes follow by
doubling. Equal names are equal strings but for chance of about 2^-64 a pair.

Spark sorts positions by name twice, and drops those that are unique:

1. At 64 bytes. Every 100-byte string holds 37 strings of 64 bytes; the one with the least name is
   its anchor, which equal strings share. So only anchors are sorted (one position of nineteen),
   packed by name range. Their names that occur once are dropped with all strings they anchor.
2. At 100 bytes, the threshold. What is left are stretches of neighbouring starts with one anchor
   name. They are sorted by name and by a print of their bytes: equal ones keep the earliest and mark
   the others. Only where a name has stretches of several prints do the earliest ones' texts travel:
   their strings are named at 100 bytes, each name keeps its earliest position, all others are marked.

Stretches that a task has met before, at an earlier position, are marked at once. Marked stretches
return to their documents, which cut them out. Documents without marks are not shuffled with their
text.

Defined results: see ``remove_repeats``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.ngram_join import Frequencies, _texts, count_keys, is_wanted, wanted_cells
from quayside.session import durable

LENGTH = 100
HALF = 64
WIDTH = LENGTH - HALF + 1
#: Text that one task of the second sort should get, in bytes of input.
SHARE = 1_000_000
NO_ID = -(1 << 63)
_MET = 200_000
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_NONE = np.zeros(0, np.uint64)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    v = (a ^ (a >> np.uint64(32))) * _C[0]
    v += (b ^ (b >> np.uint64(29))) * _C[1]
    v ^= v >> np.uint64(31)
    v *= _C[2]
    v ^= v >> np.uint64(33)
    return v


def half_names(data: bytes) -> np.ndarray:
    """The names of all 64-byte strings."""
    n = len(data) - 7
    if n + 7 < HALF:
        return _NONE
    names = np.empty(n, np.uint64)
    for k in range(8):
        part = np.frombuffer(data, "<u8", (len(data) - k) // 8, k)
        names[k::8] = part[: len(names[k::8])]
    for h in (8, 16, 32):
        names = _pair(names[:-h], names[h:])
    return names


def _sliding(values: np.ndarray, width: int, pick: Callable) -> np.ndarray:
    """The least (or greatest) of every ``width`` neighbours."""
    h = 1
    while 2 * h <= width:
        values = pick(values[:-h], values[h:])
        h *= 2
    return pick(values[: len(values) - (width - h)], values[width - h :]) if h < width else values


def anchor_values(names: np.ndarray) -> np.ndarray:
    """For each 100-byte string the least name inside it."""
    return _sliding(names, WIDTH, np.minimum) if len(names) >= WIDTH else _NONE


def spread(names: np.ndarray) -> np.ndarray:
    """Names one to one onto all 64-bit numbers: least names lie near 0, and ranges and cells are cut from the top."""
    names = (names ^ (names >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return (names ^ (names >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)


def _anchor_keys() -> Callable[[str | None], np.ndarray]:
    def keys(text: str | None) -> np.ndarray:
        names = half_names((text or "").encode("utf-8", "surrogatepass"))
        least = anchor_values(names)
        if not len(least):
            return _NONE
        # A position is an anchor if some window that holds it has nothing less: the greatest of
        # those windows' least names is then its own.
        room = np.zeros(WIDTH - 1, np.uint64)
        highest = _sliding(np.concatenate([room, least, room]), WIDTH, np.maximum)
        return spread(names[highest == names])

    return keys


STRETCH = "range int, name bigint, print bigint, inner boolean, id bigint, at int, n int"
SENT = "range int, name bigint, id bigint, at int, n int, data binary"
_KINDS = {"int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, (_, k) in zip(zip(*rows), fields)], [n for n, _ in fields])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _periodic(names: np.ndarray, least: np.ndarray) -> set[int]:
    """Anchor names that one stretch may hold twice, so that it may repeat a string inside itself."""
    room = np.zeros(WIDTH - 1, np.uint64)
    spots = np.flatnonzero(_sliding(np.concatenate([room, least, room]), WIDTH, np.maximum) == names)
    near = (np.diff(spots) <= WIDTH) & (names[spots[1:]] == names[spots[:-1]])
    return set(names[spots[1:]][near].tolist())


def _found(batches: Iterator[pa.RecordBatch], freq: Frequencies):
    """Stretches of starts with one anchor name that may repeat: ``id, name, inner, at, end, bytes``."""
    for key, text in _texts(batches):
        data = (text or "").encode("utf-8", "surrogatepass")
        names = half_names(data)
        least = anchor_values(names)
        if not len(least):
            continue
        edges = np.flatnonzero(least[1:] != least[:-1]) + 1
        first, last = np.append(0, edges), np.append(edges, len(least))
        values = least[first]
        even = spread(values)
        kept = np.flatnonzero(freq.repeats(even))
        if not len(kept):
            continue
        doc, twice = NO_ID if key is None else key, _periodic(names, least)
        for v, name, a, b in zip(values[kept].tolist(), even[kept].tolist(), first[kept].tolist(), last[kept].tolist()):
            yield doc, name, v in twice, a, b, data[a : b + LENGTH - 1]


def _stretches(known, range_bits: int):
    """Stretches by the 64-bit print of their bytes; ``print`` is null for those that are marked at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[int, tuple[int, int]] = {}
        out: list[tuple] = []
        for doc, v, inner, a, b, part in _found(batches, known.value):
            mark = xxhash.xxh3_64_intdigest(part)
            seen = met.get(mark)
            settled = seen is not None and seen < (doc, a)
            if not settled:
                if len(met) >= _MET:
                    met.clear()
                met[mark] = (doc, a)
            out.append((v >> (64 - range_bits), _signed(v), None if settled else _signed(mark), inner, doc, a, b - a))
            if len(out) >= 50_000:
                yield _batch(out, STRETCH)
                out = []
        if out:
            yield _batch(out, STRETCH)

    return run


def _settle(table: pa.Table) -> pa.Table:
    """Spans of stretches that are equal to an earlier one, and the earliest ones that are still open.

    Open (``open`` true) is the earliest stretch of each print where an anchor name has stretches of
    several prints, which may share some strings, or one that may repeat a string inside itself.
    """
    sure = pc.is_null(table.column("print"))
    done = table.filter(sure)
    rest = table.filter(pc.invert(sure)).sort_by([(k, "ascending") for k in ("name", "print", "id", "at")])
    name, mark, ids, at, n = (rest.column(c).to_numpy() for c in ("name", "print", "id", "at", "n"))
    inner = rest.column("inner").to_numpy(zero_copy_only=False).astype(bool)
    new_name = np.append(True, name[1:] != name[:-1])[: len(name)]
    new_mark = new_name | np.append(True, mark[1:] != mark[:-1])[: len(name)]
    head = np.flatnonzero(new_mark)
    own = head[np.cumsum(new_mark) - 1] if len(name) else head
    later = (ids != ids[own]) | (at != at[own])
    group = np.cumsum(new_name) - 1
    prints = np.bincount(group[head], minlength=int(new_name.sum()))
    twice = np.bincount(group[inner], minlength=int(new_name.sum()))
    open_ = new_mark & ((prints > 1) | (twice > 0))[group] if len(name) else new_mark
    parts = [(done.column("id").to_numpy(), done.column("at").to_numpy(), done.column("n").to_numpy(), False)]
    parts += [(ids[later], at[later], n[later], False), (ids[open_], at[open_], n[open_], True)]
    columns = [
        pa.array(np.concatenate([p[0] for p in parts]).astype(np.int64)),
        pa.array(np.concatenate([p[1] for p in parts]).astype(np.int64)),
        pa.array(np.concatenate([p[1].astype(np.int64) + p[2] + LENGTH - 1 for p in parts])),
        pa.array(np.concatenate([np.full(len(p[0]), p[3]) for p in parts])),
    ]
    return pa.table(columns, names=["id", "lo", "hi", "open"])


def _open_texts(known, wanted, range_bits: int):
    """The bytes of open stretches; a few others share a cell with one, which changes nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, out, held = wanted.value, [], 0
        for doc, v, _, a, b, part in _found(batches, known.value):
            if is_wanted(cells, f"{doc}:{a}"):
                out.append((v >> (64 - range_bits), _signed(v), doc, a, b - a, part))
                held += len(part)
                if held > 4_000_000:
                    yield _batch(out, SENT)
                    out, held = [], 0
        if out:
            yield _batch(out, SENT)

    return run


def _mark(table: pa.Table) -> pa.Table:
    """``id, lo, hi`` of the bytes to remove: of every 100-byte string but its earliest."""
    table = table.sort_by([("id", "ascending"), ("at", "ascending")])
    ids, at, n = (table.column(c).to_numpy() for c in ("id", "at", "n"))
    who, lo, hi = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if len(ids):
        data = b"".join(table.column("data").to_pylist())
        sizes = n.astype(np.int64) + LENGTH - 1
        base = np.cumsum(sizes) - sizes
        row = np.repeat(np.arange(len(n)), n)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        half = half_names(data)
        place = base[row] + inside
        names = _pair(half[place], half[place + LENGTH - HALF])
        _, first, which = np.unique(names, return_index=True, return_inverse=True)
        start = at[row] + inside
        origin = first[which]
        again = (ids[row] != ids[row[origin]]) | (start != start[origin])
        # Neighbouring marked starts of a row are one span.
        ends = np.flatnonzero(np.diff(np.concatenate([[0], again.astype(np.int8), [0]])))
        same = np.append(False, row[1:] != row[:-1])
        breaks = np.flatnonzero(same & again & np.append(False, again[:-1]))
        begin = np.sort(np.concatenate([ends[0::2], breaks]))
        close = np.sort(np.concatenate([ends[1::2], breaks])) - 1
        who.append(ids[row[begin]])
        lo.append(start[begin].astype(np.int64))
        hi.append(start[close].astype(np.int64) + LENGTH)
    return pa.table([pa.array(np.concatenate(x).astype(np.int64), pa.int64()) for x in (who, lo, hi)], names=["id", "lo", "hi"])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out



def _to_cut(wanted):
    """``data`` only for documents that may have marks, and a digest for the others in its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = wanted.value
        rows: list[tuple] = []
        held = 0
        for key, text in _texts(batches):
            data = (text or "").encode("utf-8", "surrogatepass")
            marked = is_wanted(cells, str(NO_ID if key is None else key))
            rows.append((key, len(data), data if marked else None, None if marked else hashlib.sha256(data).hexdigest()))
            held += len(data) if marked else 64
            if held > 4_000_000 or len(rows) > 20_000:
                yield _rows(rows)
                rows, held = [], 0
        if rows:
            yield _rows(rows)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["id", "n_bytes", "data", "digest"])


CUT = "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<lo: bigint, hi: bigint>>, kept binary"


def _cut(with_kept: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                spans = merged([(s["lo"], s["hi"]) for s in row["spans"] or ()])
                data, digest = row["data"], row["digest"]
                kept = None
                if data is not None:
                    ends = [0, *(x for span in spans for x in span), len(data)]
                    kept = b"".join(data[a:b] for a, b in zip(ends[0::2], ends[1::2]))
                    digest = hashlib.sha256(kept).hexdigest()
                cut = [{"lo": a, "hi": b} for a, b in spans]
                rows.append((row["id"], row["n_bytes"], sum(b - a for a, b in spans), len(spans), digest, cut, kept if with_kept else None))
            names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])), pa.binary()]
            columns = zip(*rows) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_kept: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` of every row, and ``kept`` on request.

    Removed is each byte that a 100-byte string covers which also starts earlier: in a document of
    smaller id, or earlier in the same one. ``kept`` are the remaining bytes, only of documents that
    may have lost some (else null: nothing was removed).

    Null texts are empty. A null id counts as the smallest. Rows that share an id count as one
    document: of a string at the same start in two of them none is earlier. Strings never cross
    documents; texts of fewer than 100 bytes lose nothing. Other columns are not read.
    """
    spark = docs.sparkSession
    ids = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    known = spark.sparkContext.broadcast(count_keys(ids, _anchor_keys, 150))
    size = ids.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    range_bits = max(3, math.ceil(math.log2(size / SHARE))) if size > SHARE else 3
    stretches = ids.mapInArrow(_stretches(known, range_bits), STRETCH)
    settled = durable(stretches.groupBy("range").applyInArrow(_settle, "id bigint, lo bigint, hi bigint, open boolean"), "stretches")
    names = settled.where("open").select(F.concat_ws(":", "id", "lo"))
    sent = ids.mapInArrow(_open_texts(known, spark.sparkContext.broadcast(wanted_cells(names)), range_bits), SENT)
    shared = sent.groupBy("range").applyInArrow(_mark, "id bigint, lo bigint, hi bigint")
    spans = settled.where("not open").select("id", "lo", "hi").unionByName(shared)
    marks = durable(spans.groupBy("id").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")), "marks")
    wanted = spark.sparkContext.broadcast(wanted_cells(marks.select(F.col("id").cast("string"))))
    whole = ids.mapInArrow(_to_cut(wanted), "id bigint, n_bytes bigint, data binary, digest string")
    key = F.when(F.col("data").isNotNull(), F.coalesce("id", F.lit(NO_ID)))
    met = whole.withColumn("key", key).join(marks.select(F.col("id").alias("key"), "spans"), "key", "left")
    cut = met.select("id", "n_bytes", "data", "digest", "spans").mapInArrow(_cut(with_kept), CUT)
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", *(["kept"] if with_kept else [])]
    return cut.select(F.col("id").alias(doc_id), *names)
