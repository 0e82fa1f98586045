"""Merkle manifest of a dataset whose inner nodes keep SHA-256 states, and folding of changed rows.

Leaves of a group stand in the order of key and leaf. Every 16 consecutive nodes become the hash of
their hex digests; the last run may be shorter, even one. What remains of each group is its subroot,
and the subroots in the order of the groups are the leaves of a last tree, whose top is the root.

A parent keeps the state of its hash as it was before each of its children. To see what the root
would be with another leaf, folding takes the state before the leaf's place, adds the replacement and
the siblings right of it, and goes on with the parent; left siblings are never read again.

Work is dealt out as plates of three levels, 4096 leaves at most: a plate is one group of rows,
and its top is a leaf of the next tier, so no task holds more than a plate however large a group is.
Places come from a range sort, so a group that holds most rows is spread over tasks too.

Defined results: null keys come first; rows that repeat a key are ordered by their leaf; equal rows
are leaves of their own; a null group is a group before all others. A tree of one leaf has no sibling,
and its proof is the hash of nothing. An empty table gives an empty result. Columns that are not named
are not read, so extra ones cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from quayside.llm import sha_lanes
from quayside.session import durable

FANOUT = 16
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_hash(values: Sequence[Column]) -> Column:
    """SHA-256 (32 bytes) of the values, each as byte count, colon and text; ``-`` for null."""
    told = [F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")) for v in values]
    return F.unhex(F.sha2(F.concat(*(F.coalesce(t, F.lit("-")) for t in told)), 256))


def _height(n: Column) -> Column:
    """Levels above ``n`` leaves until one node remains."""
    steps = F.when(n <= 1, 0)
    for h in range(1, 16):
        steps = steps.when(n <= F.lit(FANOUT**h), h)
    return steps.otherwise(16)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to sorted rows their partition and their place among the partition's rows of one group."""
    part = TaskContext.get().partitionId()
    last, seen = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        runs = pc.run_end_encode(batch.column("grp"))
        ends = runs.run_ends.to_numpy(zero_copy_only=False).astype(np.int64)
        begins = np.append(0, ends[:-1])
        at = np.arange(batch.num_rows) - np.repeat(begins, ends - begins)
        if last == runs.values[0].as_py():
            at[: ends[0]] += seen
        last, seen = runs.values[-1].as_py(), int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(at)], [*batch.schema.names, "part", "at"]
        )


def _numbered(rows: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """``rows`` with ``pos``, the place within ``grp`` in the given order, counted from 0.

    Ranges are cut by group and order; running totals over the ranges of a group give places. One
    row for each range and group is all that the totals see.
    """
    columns = ["grp", *order]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    ranged = rows.repartitionByRange(*columns).sortWithinPartitions(*columns).mapInArrow(_runs, f"{schema}, part int, at bigint")
    ranged = durable(ranged, label)
    sizes = ranged.groupBy("grp", "part").agg((F.max("at") + 1).alias("size"))
    before = W.partitionBy("grp").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("grp", "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    return ranged.join(offsets, ["grp", "part"]).withColumn("pos", F.col("at") + F.col("offset")).drop("part", "at", "offset")


NODES = "grp string, plate bigint, level int, at int, top boolean, height int, digest binary, children binary, states binary"


def _digests(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def _parents(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the parents of ``nodes``, and for every node its parent's state before it."""
    n = len(nodes)
    blocks = sha_lanes.hex_block(nodes)
    counts = np.minimum(FANOUT, n - np.arange(0, n, FANOUT))
    state = np.repeat(sha_lanes.START[None], len(counts), 0)
    before = np.zeros((n, 8), np.uint32)
    for slot in range(FANOUT):
        has = np.flatnonzero(counts > slot)
        at = has * FANOUT + slot
        before[at] = state[has]
        state[has] = sha_lanes.absorb(state[has], blocks[at])
    return sha_lanes.finish(state, counts), before


def _grow(levels: int):
    """All parents of one plate: up to so many levels, until one node remains."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        group, plate = (k.as_py() for k in key)
        table = table.sort_by("pos")
        height = table.column("height")[0].as_py()
        nodes, rows = _digests(table.column("digest")), []
        for level in range(min(levels, height)):
            parents, before = _parents(nodes)
            states = sha_lanes.to_bytes(before)
            top = level + 1 == min(levels, height)
            for i, digest in enumerate(parents):
                span = slice(i * FANOUT, (i + 1) * FANOUT)
                rows.append((group, plate, level, i, top, height, digest.tobytes(), nodes[span].tobytes(), states[span].tobytes()))
            nodes = parents
        return pa.table(
            [pa.array(c, t) for c, t in zip(zip(*rows), _types(NODES))],
            names=[field.split()[0] for field in NODES.split(", ")],
        )

    return run


_ARROW = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}


def _types(schema: str) -> list[pa.DataType]:
    return [_ARROW[field.split()[1]] for field in schema.split(", ")]


def _plated(rows: DataFrame, levels: int) -> DataFrame:
    return rows.withColumn("plate", F.floor(F.col("pos") / FANOUT**levels))


def _trees(leaves: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Parents tier by tier over ``grp, pos, digest, height``, and the top of every group: ``grp, subroot, tier``."""
    tallest = leaves.agg(F.max("height")).first()[0] or 0
    rows, tiers = leaves, []
    tops = leaves.where("height = 0").select("grp", F.col("digest").alias("subroot"), F.lit(0).alias("tier"))
    for tier in range(-(-tallest // levels)):
        plates = _plated(rows.where("height > 0").select("grp", "pos", "digest", "height"), levels).groupBy("grp", "plate")
        nodes = durable(plates.applyInArrow(_grow(levels), NODES), "merkle-nodes")
        tiers.append(nodes)
        rows = nodes.where("top").select("grp", F.col("plate").alias("pos"), "digest", F.greatest(F.col("height") - levels, F.lit(0)).alias("height"))
        tops = tops.union(rows.where("height = 0").select("grp", F.col("digest").alias("subroot"), F.lit(tier)))
    return tiers, tops


@dataclass
class Manifest:
    """Leaves with places; parents (with their children and states) by tier; the same of the tree over groups.

    A node's row is told by ``grp``, tier, ``plate``, ``level`` and ``at``. ``root`` is None for an empty table.
    """

    leaves: DataFrame
    tiers: list[DataFrame]
    groups: DataFrame
    group_tiers: list[DataFrame]
    root: bytes | None
    levels: int


def build_manifest(leaves: DataFrame, levels: int = LEVELS) -> Manifest:
    """``leaves`` has ``grp`` (text, null allowed), ``key``, ``leaf`` (32 bytes), and columns that are kept."""
    named = leaves.withColumn("grp", F.coalesce(F.concat(F.lit("="), "grp"), F.lit("")))
    placed = _numbered(durable(named, "merkle-leaves"), ["key", "leaf"], "merkle-ranges")
    sizes = placed.groupBy("grp").agg(_height(F.count(F.lit(1))).alias("height"))
    placed = durable(placed.join(sizes, "grp"), "merkle-placed")
    tiers, tops = _trees(placed.withColumnRenamed("leaf", "digest"), levels)
    groups = tops.select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("subroot").alias("digest"), "tier")
    groups = _numbered(durable(groups, "merkle-tops"), ["name"], "merkle-groups")
    groups = durable(groups, "merkle-groups")
    groups = groups.withColumn("height", _height(F.lit(groups.count())))
    group_tiers, top = _trees(groups, levels)
    last = top.first()
    return Manifest(placed, tiers, groups, group_tiers, bytes(last["subroot"]) if last else None, levels)


PATHS = "grp string, pos bigint, subroot binary, path array<struct<slot: int, state: binary, children: binary>>"
_STEP = pa.struct([("slot", pa.int32()), ("state", pa.binary()), ("children", pa.binary())])


class _Plate:
    """The parents of a plate, read back from their rows."""

    def __init__(self, nodes: pa.Table):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        nodes = nodes.sort_by([("level", "ascending"), ("at", "ascending")])
        level = nodes.column("level").to_numpy()
        for k in np.unique(level):
            own = nodes.slice(int(np.searchsorted(level, k)), int((level == k).sum()))
            self.levels.append((_digests(own.column("children")), _digests(own.column("states"))))

    def step(self, level: int, at: int) -> dict:
        """What folding needs at a node: its slot, the state before it, and all children of its parent."""
        children, states = self.levels[level]
        begin = at - at % FANOUT
        return {"slot": at % FANOUT, "state": states[at].tobytes(), "children": children[begin : begin + FANOUT].tobytes()}


def _descend(levels: int):
    """Paths of all leaves of a plate from the path of its top."""
    names, types = ["grp", "pos", "subroot", "path"], (pa.string(), pa.int64(), pa.binary(), pa.list_(_STEP))

    def run(key: tuple, nodes: pa.Table, paths: pa.Table) -> pa.Table:
        if not nodes.num_rows or not paths.num_rows:
            return pa.table([pa.array([], t) for t in types], names=names)
        plate, above = _Plate(nodes), paths.column("path")[0].as_py()
        n = len(plate.levels[0][0])
        own = [[plate.step(k, i // FANOUT**k) for k in range(len(plate.levels))] + above for i in range(n)]
        first = key[1].as_py() * FANOUT**levels
        columns = [key[0].as_py()] * n, range(first, first + n), [paths.column("subroot")[0].as_py()] * n, own
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return run


def _down(tiers: list[DataFrame], starts: DataFrame, levels: int) -> DataFrame:
    """Paths that arrive at the lowest plates; a group's ``starts`` enters at its top tier."""
    paths = starts.where(F.col("tier") >= len(tiers) - 1).select("grp", F.lit(0).cast("long").alias("pos"), "subroot", "path")
    for tier in range(len(tiers) - 1, -1, -1):
        if tier < len(tiers) - 1:
            here = starts.where(F.col("tier") == tier).select("grp", F.lit(0).cast("long").alias("pos"), "subroot", "path")
            paths = paths.union(here)
        if tier == 0:
            break
        met = tiers[tier].groupBy("grp", "plate").cogroup(paths.withColumnRenamed("pos", "plate").groupBy("grp", "plate"))
        paths = durable(met.applyInArrow(_descend(levels), PATHS), "merkle-paths")
    return paths


def _resume(states: np.ndarray, children: np.ndarray, begin: np.ndarray, count: np.ndarray, slot: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Parents' digests with ``value`` at ``slot``: the state before it, the value, then the right siblings only."""
    state = sha_lanes.absorb(states, sha_lanes.hex_block(value))
    blocks = sha_lanes.hex_block(children)
    for step in range(1, FANOUT):
        on = np.flatnonzero(slot + step < count)
        if not len(on):
            break
        state[on] = sha_lanes.absorb(state[on], blocks[begin[on] + slot[on] + step])
    return sha_lanes.finish(state, count)


def _distinct(place: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First of the equal pairs of place and digest, and for each row which pair it has: equal ones are folded once."""
    both = np.ascontiguousarray(np.concatenate((place.astype(">i8").view(np.uint8).reshape(-1, 8), value), axis=1))
    _, first, inverse = np.unique(both.view(f"V{both.shape[1]}").ravel(), return_index=True, return_inverse=True)
    return first, inverse.ravel()


FOLDED = "subroot binary, proof string, folded binary"


def _fold(names: Sequence[str], kept: pa.Schema, levels: int):
    def run(key: tuple, rows: pa.Table, known: pa.Table) -> pa.Table:
        n = rows.num_rows
        if not n:
            return pa.table([pa.array([], f.type) for f in kept] + [pa.array([], t) for t in (pa.binary(), pa.string(), pa.binary())], names=names)
        path_row = known.filter(pc.field("level") < 0)
        nodes = known.filter(pc.field("level") >= 0)
        inside = _Plate(nodes).levels if nodes.num_rows else []
        above = path_row.column("path")[0].as_py()
        at = rows.column("pos").to_numpy() % FANOUT**levels
        value = _digests(rows.column("given"))
        siblings: list[list[bytes]] = []
        place = at
        for children, states in inside:
            begin, slot = place - place % FANOUT, place % FANOUT
            count = np.minimum(FANOUT, len(children) - begin)
            first, inverse = _distinct(place, value)
            folded = _resume(sha_lanes.to_states(states[place[first]]), children, begin[first], count[first], slot[first], value[first])
            siblings.append(_others(children, place))
            value, place = folded[inverse], place // FANOUT
        tail = b""
        for step in above:
            children = np.frombuffer(step["children"], np.uint8).reshape(-1, 32)
            first, inverse = _distinct(np.zeros(n, np.int64), value)
            m = len(first)
            state = np.repeat(sha_lanes.to_states(np.frombuffer(step["state"], np.uint8).reshape(1, 32)), m, 0)
            slots = np.full(m, step["slot"])
            value = _resume(state, children, np.zeros(m, np.int64), np.full(m, len(children)), slots, value[first])[inverse]
            tail += _others(children, np.array([step["slot"]]))[0]
        proofs = []
        for parts in zip(*siblings) if siblings else [()] * n:
            rest = hashlib.sha256()
            for part in parts:
                rest.update(part)
            rest.update(tail)
            proofs.append(rest.hexdigest())
        subroot = path_row.column("subroot")[0].as_py()
        return pa.table(
            [rows.column(f.name) for f in kept]
            + [pa.array([subroot] * n, pa.binary()), pa.array(proofs, pa.string()), pa.array([v.tobytes() for v in value], pa.binary())],
            names=names,
        )

    return run


def _others(children: np.ndarray, place: np.ndarray) -> list[bytes]:
    """Hex texts of each node's siblings, left to right."""
    text = children.tobytes().hex().encode()
    size = 64 * FANOUT
    return [text[p // FANOUT * size : p * 64] + text[(p + 1) * 64 : (p // FANOUT + 1) * size] for p in place.tolist()]


def fold(manifest: Manifest, given: str, keep: Sequence[str]) -> DataFrame:
    """``keep``, ``subroot``, ``proof`` (hash of all siblings) and ``folded``: the root with ``given`` as the row's leaf.

    ``given`` is a column of the leaves with 32 bytes. Whole rows are folded, changed or not.
    """
    groups, tiers = manifest.groups, manifest.tiers
    spark = groups.sparkSession
    nothing = F.expr("cast(array() as array<struct<slot: int, state: binary, children: binary>>)")
    if manifest.group_tiers:
        start = spark.range(1).select(
            F.lit("").alias("grp"), F.lit(None).cast("binary").alias("subroot"), nothing.alias("path"), F.lit(len(manifest.group_tiers) - 1).alias("tier")
        )
        paths = _down(manifest.group_tiers, start, manifest.levels).withColumnRenamed("pos", "plate")
        met = manifest.group_tiers[0].groupBy("grp", "plate").cogroup(paths.groupBy("grp", "plate"))
        arrived = groups.join(met.applyInArrow(_descend(manifest.levels), PATHS).select("pos", "path"), "pos")
    else:
        arrived = groups.withColumn("path", nothing)
    starts = durable(arrived.select(F.col("name").alias("grp"), F.col("digest").alias("subroot"), "path", "tier"), "merkle-starts")
    paths = _down(tiers, starts, manifest.levels) if tiers else starts.select("grp", F.lit(0).cast("long").alias("pos"), "subroot", "path")
    known = paths.select("grp", F.col("pos").alias("plate"), F.lit(-1).alias("level"), "subroot", "path")
    lowest = tiers[0] if tiers else spark.createDataFrame([], NODES)
    known = known.unionByName(lowest.select("grp", "plate", "level", "at", "children", "states"), allowMissingColumns=True)
    rows = _plated(manifest.leaves.select(*keep, "grp", "pos", F.col(given).alias("given")), manifest.levels)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema.fields)
    kept = to_arrow_schema(rows.select(*keep).schema)
    run = _fold([*keep, "subroot", "proof", "folded"], kept, manifest.levels)
    return rows.groupBy("grp", "plate").cogroup(known.groupBy("grp", "plate")).applyInArrow(run, f"{schema}, {FOLDED}")


def verify_documents(docs: DataFrame, tampered: Column, changed_text: Column, key: str = "doc_id", group: str = "source", text: str = "text", levels: int = LEVELS) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` for every row of ``docs``.

    The manifest is that of the rows as they are. Rows where ``tampered`` holds are folded with a leaf
    of ``changed_text`` in place of their text, and verify only if that leaves the root as it was.
    ``levels`` is the height of the plates that tasks work on; it does not change the tree.
    """
    own = {name: F.col(text if name == "text" else key if name == "doc_id" else group if name == "source" else name) for name in FIELDS}
    leaf = leaf_hash(list(own.values()))
    other = leaf_hash([changed_text if name == "text" else value for name, value in own.items()])
    leaves = docs.select(F.col(key).alias("key"), F.col(group).alias("grp"), leaf.alias("leaf"), F.when(tampered, other).otherwise(leaf).alias("given"))
    manifest = build_manifest(leaves, levels)
    folded = fold(manifest, "given", ["key", "leaf"])
    told = lambda c: F.lower(F.hex(c))
    root = told(F.lit(manifest.root).cast("binary"))
    return folded.select(
        F.col("key").alias(key),
        told("leaf").alias("leaf"),
        told("subroot").alias("subroot"),
        root.alias("root"),
        F.col("proof").alias("proof_sha256"),
        told("folded").alias("folded_root"),
        (told("folded") == root).alias("verified"),
    )
