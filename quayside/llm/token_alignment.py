"""Alignment of two tokenizers over the bytes of texts, as products of sparse incidence matrices.

Tokens of tokenizer A and of tokenizer B are rows of incidence matrices over the bytes of a text.
The row products of A and the transpose of B are the overlap links: pairs of tokens that share bytes,
with how many. Byte offsets where both tokenizers end a token cut the text into groups, and the
product of the token-by-group matrices gives the pairs of tokens that share a group.

Neither tokenizer joins anything across a blank that follows a character which is no white space, so
a text is cut there into units, and each distinct unit is encoded and multiplied once in a worker.
Models for which that does not hold are used on whole texts.

How often an id pair is linked in the whole corpus comes back to the texts through chunks of them:
each chunk names its distinct pairs once, totals are aggregated, and joined back by pair. Only the
most linked count of every id of B is broadcast, at most one row for each entry of its vocabulary.

Defined results: a null or empty text has no tokens, nor has one whose tokens do not spell out a
blank and the text again (a literal blank mark does that); its counts are 0 and its digest is empty.
Every input row gives one row, also where keys are null or repeat; equal texts are counted as often
as they come. An empty table gives an empty one. Columns other than key and text are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quayside.llm.lattice import BLANK
from quayside.session import durable

CHUNK_CHARS = 4_000_000
CHUNK_ROWS = 20_000
KNOWN_UNITS = 300_000
NEW_CHARS = 500_000  # characters of new units that are encoded and multiplied together
PRODUCTS = 4_000_000  # partial products that are held at once
_CUT = re.compile(r" (?<=\S )")


@dataclass
class Csr:
    """Rows of ones: ``indices[indptr[i]:indptr[i + 1]]`` are the columns of row ``i``."""

    indptr: np.ndarray
    indices: np.ndarray
    columns: int

    def transpose(self) -> Csr:
        rows = np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))
        order = np.argsort(self.indices, kind="stable")
        counts = np.bincount(self.indices, minlength=self.columns)
        return Csr(np.append(0, np.cumsum(counts)), rows[order], len(self.indptr) - 1)


def gustavson(a: Csr, b: Csr, products: int = PRODUCTS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Entries ``(row, column, value)`` of ``a @ b``, row by row: each row gathers the rows of ``b`` at its columns.

    Blocks of rows hold at most ``products`` partial products, or one row.
    """
    lengths = np.diff(b.indptr)[a.indices]
    upto = np.append(0, np.cumsum(lengths))[a.indptr]
    rows, row = len(a.indptr) - 1, 0
    while row < rows:
        end = max(int(np.searchsorted(upto, upto[row] + products, side="right")) - 1, row + 1)
        part = slice(a.indptr[row], a.indptr[end])
        size = lengths[part]
        at = ranges(b.indptr[a.indices[part]], size)
        of = np.repeat(np.repeat(np.arange(row, end), np.diff(a.indptr[row : end + 1])), size)
        entries = of * b.columns + b.indices[at]
        if (entries[1:] < entries[:-1]).any():
            entries = np.sort(entries)
        first = np.flatnonzero(np.append(True, entries[1:] != entries[:-1])) if len(entries) else np.zeros(0, np.int64)
        values = np.diff(np.append(first, len(entries)))
        entries = entries[first]
        of = entries // max(b.columns, 1)
        yield of, entries - of * b.columns, values
        row = end


def overlap_links(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Links of tokens with byte lengths ``a`` and ``b`` over the same bytes, and the bytes each link shares."""
    total = int(a.sum())
    rows, columns = (Csr(np.append(0, np.cumsum(x)), np.arange(total), total) for x in (a, b))
    return gustavson(rows, columns.transpose())


def groups_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The group of every token of both sides, and how many there are."""
    ends_a, ends_b = np.cumsum(a), np.cumsum(b)
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
    return np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b), len(cuts)


def group_links(of_a: np.ndarray, of_b: np.ndarray, groups: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Links of tokens that share a group."""
    a, b = (Csr(np.arange(len(x) + 1), x, groups) for x in (of_a, of_b))
    return gustavson(a, b.transpose())


class Tokenizers:
    """A: byte-level BPE from a ``tokenizers`` file. B: a ``sentencepiece`` model, which adds the leading blank."""

    def __init__(self, a: str, b: str):
        # One thread for each task, as Spark counts them; read when the library is first imported.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a)
        self.a.encode_special_tokens = True
        self.a.no_padding(), self.a.no_truncation()
        with open(a, encoding="utf-8") as file:
            before = json.load(file)["pre_tokenizer"] or {}
        points = _byte_points()
        size = self.a.get_vocab_size(with_added_tokens=True)
        self.bytes_a = [bytes(map(points.__getitem__, name)) if name and all(c in points for c in name) else (name or "").encode() for name in map(self.a.id_to_token, range(size))]
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        size = self.b.get_piece_size()
        names = [self.b.id_to_piece(i) for i in range(size)]
        self.bytes_b = [bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace(BLANK, " ").encode() for i, n in enumerate(names)]
        self.told = [f"{i}{end}" for i in range(len(self.bytes_a)) for end in ",|"]
        self.told += [f"{i}{end}" for i in range(size) for end in (",", ";", "")]
        self.blank = self.b.piece_to_id(BLANK)
        self.long_a, self.long_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        # What allows cuts: A cuts before blanks by its pattern, no piece of B reaches across one.
        self.cuts = (
            before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
            and self.bytes_b[self.blank] == b" " and not any(BLANK in n.lstrip(BLANK) for n in names) and self.b.encode("a  b", out_type=str)[:1] == [BLANK + "a"]
        )

    def units(self, text: str) -> list[str]:
        return _CUT.split(text) if self.cuts else [text]

    def encode(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a = [e.ids for e in self.a.encode_batch_fast([" " + u for u in units], add_special_tokens=False)]
        # The library gives nothing for an empty text; within a longer one it would give its blank.
        b = [x if u else [self.blank] for u, x in zip(units, self.b.encode(units, num_threads=1))]
        return a, b

    def spell(self, units: list[str], a: list[list[int]], b: list[list[int]]) -> list[bool]:
        """Whether the tokens of each unit spell a blank and the unit."""
        want = [(" " + unit).encode() for unit in units]
        lengths = list(map(len, want))
        joined, fine = b"".join(want), True
        for side, names, sizes in ((a, self.bytes_a, self.long_a), (b, self.bytes_b, self.long_b)):
            # All at once: the same bytes, cut at the same places.
            ids = np.fromiter(itertools.chain.from_iterable(side), np.int64)
            ends = np.append(0, np.cumsum(sizes[ids]))[np.cumsum([0, *map(len, side)])]
            fine = fine and np.array_equal(np.diff(ends), lengths) and b"".join(map(names.__getitem__, ids.tolist())) == joined
        if fine:
            return [True] * len(units)
        return [
            b"".join(map(self.bytes_a.__getitem__, x)) == w and b"".join(map(self.bytes_b.__getitem__, y)) == w
            for x, y, w in zip(a, b, want)
        ]

    def group_texts(self, ids_a, in_a, ids_b, in_b, groups: np.ndarray, sizes: np.ndarray) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for every unit; ``groups`` and ``sizes`` say how many groups and tokens it has.

        Each token's text carries what follows it, so a unit's text is its tokens' texts one after the other.
        """
        more_a = np.append(in_a[1:] == in_a[:-1], False)[: len(in_a)]
        more_b = np.append(in_b[1:] == in_b[:-1], False)[: len(in_b)]
        last = np.zeros(int(groups.sum()), bool)
        last[(np.cumsum(groups) - 1)[groups > 0]] = True
        ends = np.where(more_b, 0, np.where(last[in_b], 2, 1)) if len(in_b) else np.zeros(0, np.int64)
        texts = np.concatenate((ids_a * 2 + ~more_a, 2 * len(self.bytes_a) + ids_b * 3 + ends))
        order = np.argsort(np.concatenate((2 * in_a, 2 * in_b + 1)), kind="stable")
        pieces = list(map(self.told.__getitem__, texts[order].tolist()))
        cuts = np.cumsum(np.append(0, sizes)).tolist()
        return ["".join(pieces[x:y]) for x, y in zip(cuts, cuts[1:])]


def _byte_points() -> dict[str, int]:
    """The characters that byte-level BPE writes for bytes: printable ones as they are, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


_LOADED: dict[tuple[str, str], Tokenizers] = {}


def load(a: str, b: str) -> Tokenizers:
    """Both tokenizers, read once for each worker process."""
    if (a, b) not in _LOADED:
        _LOADED[a, b] = Tokenizers(a, b)
    return _LOADED[a, b]


class _Rows:
    """An array that grows at its end."""

    def __init__(self, width: int | None, dtype):
        self.data = np.zeros((1024,) if width is None else (1024, width), dtype)
        self.size = 0

    def add(self, rows: np.ndarray) -> None:
        need = self.size + len(rows)
        if need > len(self.data):
            grown = np.zeros((max(need, 2 * len(self.data)), *self.data.shape[1:]), self.data.dtype)
            grown[: self.size] = self.data[: self.size]
            self.data = grown
        self.data[self.size : need] = rows
        self.size = need

    def all(self) -> np.ndarray:
        return self.data[: self.size]


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``start[i], start[i] + 1, …`` for ``size[i]`` places, one after the other."""
    first = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(start - first, size)


class Units:
    """Units that a worker has met: counts, group text and links of each."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self._empty()

    def _empty(self) -> None:
        self.number: dict[str, int] = {}
        self.texts: list[str] = []
        self.bad: set[int] = set()  # units whose tokens do not spell them
        self.counts = _Rows(5, np.int32)  # A tokens, B tokens, groups, links, links by group
        self.uses = _Rows(None, np.int64)
        self.links = _Rows(None, np.int64)  # id pairs of all units, one unit after the other
        self.begin = np.zeros(1, np.int64)

    def learn(self, units: dict[str, None]) -> None:
        """Encode and multiply those of ``units`` that are new."""
        fresh = [u for u in units if u not in self.number]
        start, chars = 0, 0
        for i, unit in enumerate(fresh):
            chars += len(unit)
            if chars >= NEW_CHARS or i + 1 == len(fresh):
                self._learn(fresh[start : i + 1])
                start, chars = i + 1, 0

    def _learn(self, units: list[str]) -> None:
        t = self.tokenizers
        a, b = t.encode(units)
        good = t.spell(units, a, b)
        if not all(good):
            a, b = ([x if g else [] for x, g in zip(side, good)] for side in (a, b))
            self.bad.update(len(self.texts) + i for i, g in enumerate(good) if not g)
        n_a, n_b = (np.fromiter(map(len, side), np.int64, len(units)) for side in (a, b))
        ids_a, ids_b = (np.fromiter(itertools.chain.from_iterable(side), np.int64, int(n.sum())) for side, n in ((a, n_a), (b, n_b)))
        of_a = np.repeat(np.arange(len(units)), n_a)
        long_a, long_b = t.long_a[ids_a], t.long_b[ids_b]
        codes, links = [np.zeros(0, np.int64)], np.zeros(len(units), np.int64)
        for row, column, _ in overlap_links(long_a, long_b):
            codes.append((ids_a[row] << 32) | ids_b[column])
            links += np.bincount(of_a[row], minlength=len(units))
        in_a, in_b, total = groups_of(long_a, long_b)
        shared = np.zeros(len(units), np.int64)
        for row, _, _ in group_links(in_a, in_b, total):
            shared += np.bincount(of_a[row], minlength=len(units))
        groups = np.bincount(of_a[np.searchsorted(in_a, np.arange(total))], minlength=len(units))
        first = len(self.texts)
        self.number.update(zip(units, range(first, first + len(units))))
        self.texts += t.group_texts(ids_a, in_a, ids_b, in_b, groups, n_a + n_b)
        self.counts.add(np.stack((n_a, n_b, groups, links, shared), axis=1))
        self.uses.add(np.zeros(len(units), np.int64))
        self.begin = np.concatenate((self.begin, self.begin[-1] + np.cumsum(links)))
        for part in codes:
            self.links.add(part)

    def of_texts(self, texts: list[str | None]) -> list[list[int]]:
        """Numbers of each text's units; none where its tokens do not spell it."""
        split = [self.tokenizers.units(text) if text else [] for text in texts]
        self.learn(dict.fromkeys(itertools.chain.from_iterable(split)))
        out = [list(map(self.number.__getitem__, units)) for units in split]
        # Where a unit does not, whether the whole still spells the text is settled on the whole.
        open_ = [i for i, numbers in enumerate(out) if not self.bad.isdisjoint(numbers)] if self.bad else []
        self.learn({texts[i]: None for i in open_})
        for i in open_:
            number = self.number[texts[i]]
            out[i] = [] if number in self.bad else [number]
        return out

    def forget(self) -> None:
        """Keep the more used half at most of what is known, and of that only what came twice. Numbers change."""
        uses, names = self.uses.all(), list(self.number)
        order = np.argsort(-uses, kind="stable")[: KNOWN_UNITS // 2]
        keep = np.sort(order[uses[order] > 1])
        texts, counts, links, begin, bad = self.texts, self.counts.all(), self.links.all(), self.begin, self.bad
        self._empty()
        self.number = {names[n]: i for i, n in enumerate(keep.tolist())}
        self.texts = [texts[n] for n in keep.tolist()]
        self.bad = {i for i, n in enumerate(keep.tolist()) if n in bad}
        self.counts.add(counts[keep])
        self.uses.add(uses[keep] // 2)
        size = np.diff(begin)[keep]
        self.links.add(links[ranges(begin[keep], size)])
        self.begin = np.append(0, np.cumsum(size))


COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_group_links")


def _chunk_schema(key: str) -> str:
    lists = ", ".join(f"{name} array<bigint>" for name in COUNTS)
    return (
        f"chunk bigint, keys array<{key}>, {lists}, digests array<string>, units binary, starts binary, "
        "pair_starts binary, pair_units binary, pairs array<struct<a: int, b: int, times: bigint>>"
    )


def _pack(values: np.ndarray) -> bytes:
    return zstandard.compress(values.astype("<i4").tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), "<i4").astype(np.int64)


def _chunk(number: int, known: Units, keys: list, docs: list[list[int]], key_type: pa.DataType) -> pa.RecordBatch:
    """One chunk of texts: their counts and digests, and which pairs each of their units links."""
    starts = np.cumsum([0, *map(len, docs)])
    flat = np.fromiter((n for doc in docs for n in doc), np.int64, int(starts[-1]))
    used, local = np.unique(flat, return_inverse=True)
    counts = known.counts.all()[used].astype(np.int64)
    sums = np.concatenate((np.zeros((1, len(COUNTS)), np.int64), np.cumsum(counts[local], axis=0)))
    per_doc = sums[starts[1:]] - sums[starts[:-1]]
    digests = [hashlib.sha256(";".join([known.texts[n] for n in doc]).encode()).hexdigest() if doc else "" for doc in docs]
    links = np.diff(known.begin)[used]
    codes, place = np.unique(known.links.all()[ranges(known.begin[used], links)], return_inverse=True)
    unit = np.repeat(np.arange(len(used)), links)
    uses = np.bincount(local, minlength=len(used)) if len(used) else np.zeros(0, np.int64)
    known.uses.all()[used] += uses
    times = np.bincount(place, weights=uses[unit], minlength=len(codes)).astype(np.int64)
    pairs = pa.StructArray.from_arrays(
        [pa.array((codes >> 32).astype(np.int32)), pa.array((codes & 0xFFFFFFFF).astype(np.int32)), pa.array(times)], ["a", "b", "times"]
    )
    columns = [
        pa.array([number], pa.int64()),
        pa.array([keys], pa.list_(key_type)),
        *(pa.array([per_doc[:, i]], pa.list_(pa.int64())) for i in range(len(COUNTS))),
        pa.array([digests], pa.list_(pa.string())),
        *(pa.array([_pack(x)], pa.binary()) for x in (local, starts, np.append(0, np.cumsum(links)), place)),
        pa.ListArray.from_arrays(pa.array([0, len(codes)], pa.int32()), pairs),
    ]
    names = ["chunk", "keys", *COUNTS, "digests", "units", "starts", "pair_starts", "pair_units", "pairs"]
    return pa.RecordBatch.from_arrays(columns, names)


def _chunks(a: str, b: str, key_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Units(load(a, b))
        number = TaskContext.get().partitionId() << 32
        keys, docs, chars = [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                texts = part.column(1).to_pylist()
                for key, text, doc in zip(part.column(0).to_pylist(), texts, known.of_texts(texts)):
                    keys.append(key), docs.append(doc)
                    chars += len(text or "")
                    if chars >= CHUNK_CHARS or len(keys) >= CHUNK_ROWS:
                        yield _chunk(number, known, keys, docs, key_type)
                        number, keys, docs, chars = number + 1, [], [], 0
                if len(known.texts) >= KNOWN_UNITS:
                    # Numbers hold within one worker's units only, so a chunk ends here too.
                    if keys:
                        yield _chunk(number, known, keys, docs, key_type)
                        number, keys, docs, chars = number + 1, [], [], 0
                    known.forget()
        if keys:
            yield _chunk(number, known, keys, docs, key_type)

    return run


def _score(key_type: pa.DataType, names: list[str]):
    def run(chunks: pa.Table, found: pa.Table) -> pa.Table:
        keys, columns, best, total = [], [[] for _ in COUNTS], [], []
        digests = []
        if chunks.num_rows:
            row = {name: chunks.column(name)[0] for name in chunks.column_names}
            starts, local = _unpack(row["starts"].as_py()), _unpack(row["units"].as_py())
            cuts, place = _unpack(row["pair_starts"].as_py()), _unpack(row["pair_units"].as_py())
            value = np.zeros((found.num_rows, 2), np.int64)
            value[found.column("k").to_numpy()] = np.stack((found.column("best").to_numpy(), found.column("total").to_numpy()), axis=1)
            by_pair = np.concatenate((np.zeros((1, 2), np.int64), np.cumsum(value[place], axis=0)))
            by_unit = (by_pair[cuts[1:]] - by_pair[cuts[:-1]])[local]
            upto = np.concatenate((np.zeros((1, 2), np.int64), np.cumsum(by_unit, axis=0)))
            best, total = (upto[starts[1:]] - upto[starts[:-1]]).T
            keys, columns, digests = row["keys"].as_py(), [row[name].values for name in COUNTS], row["digests"].as_py()
        return pa.table(
            [pa.array(keys, key_type), *(pa.array(c, pa.int64()) for c in (*columns, best, total)), pa.array(digests, pa.string())], names=names
        )

    return run


def align_corpus(docs: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, counts of tokens, groups and links, ``n_best``, ``count_sum`` and ``groups_sha256`` of every text.

    ``a`` and ``b`` are files that every executor can read. ``n_best`` counts the links whose id pair
    is linked as often as any with the same id of B, ``count_sum`` adds how often each link's pair is
    linked in all texts. A link is a pair of token occurrences.
    """
    dtype = docs.schema[key].dataType
    key_type = to_arrow_type(dtype)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    chunks = durable(rows.mapInArrow(_chunks(a, b, key_type), _chunk_schema(dtype.simpleString())), "alignment")
    pairs = chunks.select(F.col("chunk").alias("part"), F.posexplode("pairs").alias("k", "p")).select("part", "k", "p.a", "p.b", "p.times")
    totals = durable(pairs.groupBy("a", "b").agg(F.sum("times").alias("total")), "pair-totals")
    most = totals.groupBy("b").agg(F.max("total").alias("most"))
    known = totals.join(F.broadcast(most), "b").select("a", "b", "total", (F.col("total") == F.col("most")).cast("long").alias("best"))
    found = pairs.drop("times").join(known, ["a", "b"]).select("part", "k", "total", "best")
    names = [key, *COUNTS, "n_best", "count_sum", "groups_sha256"]
    schema = f"`{key}` {dtype.simpleString()}, " + ", ".join(f"{n} bigint" for n in names[1:-1]) + ", groups_sha256 string"
    met = chunks.drop("pairs").groupBy("chunk").cogroup(found.groupBy("part"))
    return met.applyInArrow(_score(key_type, names), schema)


LINKS = (
    "a_ids array<int>, b_ids array<int>, overlaps array<struct<a: int, b: int, bytes: int>>, "
    "groups array<struct<first_a: int, first_b: int>>"
)


def _aligner(a: str, b: str):
    step = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("bytes", pa.int32())])
    cut = pa.struct([("first_a", pa.int32()), ("first_b", pa.int32())])
    none = np.zeros(0, np.int64)

    def one(tokenizers: Tokenizers, text: str | None) -> tuple:
        units = tokenizers.units(text) if text else []
        sides = tokenizers.encode(units) if units else ([], [])
        ids_a, ids_b = ([i for x in side for i in x] for side in sides)
        if not units or not tokenizers.spell([text], [ids_a], [ids_b])[0]:
            return [], [], [], []
        long_a, long_b = tokenizers.long_a[ids_a], tokenizers.long_b[ids_b]
        links = [none.reshape(0, 3), *(np.stack(x, axis=1) for x in overlap_links(long_a, long_b))]
        in_a, in_b, total = groups_of(long_a, long_b)
        first = [np.searchsorted(x, np.arange(total)).tolist() for x in (in_a, in_b)]
        told = [{"a": x, "b": y, "bytes": n} for x, y, n in np.concatenate(links).tolist()]
        return ids_a, ids_b, told, [{"first_a": x, "first_b": y} for x, y in zip(*first)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = load(a, b)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                rows = [one(tokenizers, text) for text in part.column(part.num_columns - 1).to_pylist()]
                types = (pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(step), pa.list_(cut))
                made = [pa.array(column, t) for column, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([part.column(0), *made], ["key", "a_ids", "b_ids", "overlaps", "groups"])

    return run


def align_texts(docs: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, both id lists, every overlap link as places in them with the bytes shared, and where each group begins."""
    dtype = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(_aligner(a, b), f"key {dtype}, {LINKS}").withColumnRenamed("key", key)
