"""The Merkle manifest against plain hashing, at every height and shape."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import merkle_manifest, sha_lanes
from quayside.llm.exprs import ascii_lower


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def folded(tree, at, value):
    siblings = []
    for nodes in tree[:-1]:
        begin = at - at % 16
        run = nodes[begin : begin + 16]
        left, right = run[: at - begin], run[at - begin + 1 :]
        siblings += [*left, *right]
        value, at = digest(*left, value, *right), at // 16
    return value, siblings


def expected(rows):
    by = {}
    for row in rows:
        by.setdefault(row[3], []).append(row)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        by[source].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[source] = levels([leaf(r, r[1]) for r in by[source]])
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for g, source in enumerate(order):
        for i, row in enumerate(by[source]):
            text = row[1]
            if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            value, inner = folded(trees[source], i, leaf(row, text))
            value, outer = folded(top, g, value)
            root = top[-1][0]
            out.append((row[0], leaf(row, row[1]), trees[source][-1][0], root, digest(*inner, *outer), value, value == root))
    return sorted(map(str, out))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def verified(spark, rows, levels=3, **columns):
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({k: F.lit(v) for k, v in columns.items()}).repartition(3)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle_manifest.verify_documents(docs, tampered, ascii_lower(F.col("text")), levels=levels)


def rows(counts):
    rng, out = random.Random(9), []
    for source, n in counts.items():
        for _ in range(n):
            key = rng.randrange(10**6)
            out.append((key, f"Text {key} É", rng.choice(["en", None]), source, rng.choice([None, 7])))
    return out


@pytest.mark.parametrize(
    "counts",
    [{"a": 1}, {"a": 16}, {"a": 17, "b": 1}, {"": 3, None: 2, "é": 5, "z": 256}, {f"s{i:02}": 1 + i % 3 for i in range(40)}, {"one": 4097, "two": 4096, "three": 2}],
)
def test_against_plain_hashing(spark, counts):
    table = rows(counts)
    assert sorted(map(str, (tuple(r) for r in verified(spark, table).collect()))) == expected(table)


@pytest.mark.parametrize("levels", [1, 2])
def test_more_than_one_tier_above_the_plates(spark, levels):
    table = rows({"a": 300, None: 20, "b": 1, **{f"s{i}": 2 for i in range(20)}})
    assert sorted(map(str, (tuple(r) for r in verified(spark, table, levels).collect()))) == expected(table)


def test_odd_rows(spark):
    table = [(None, None, None, None, None), (None, "A", "en", None, 1), (5, "A" * 300_000, "en", "s", 1), (5, "b", "en", "s", 1), (5, "b", "en", "s", 1), (6, "", "", "", 0)]
    out = verified(spark, table, grp="x", leaf="y", pos=1, key=2, given=3)
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == expected(table)
    assert verified(spark, []).count() == 0


def test_states_and_lanes():
    rng = np.random.default_rng(1)
    children = rng.integers(0, 256, (40, 32), dtype=np.uint8)
    parents, before = merkle_manifest._parents(children)
    for k, parent in enumerate(parents):
        run = children[16 * k : 16 * k + 16]
        assert parent.tobytes().hex() == digest(*(c.tobytes().hex() for c in run))
        # A stored state goes on where the hash of the left siblings stopped.
        for slot in range(len(run)):
            state = before[16 * k + slot][None]
            for child in run[slot:]:
                state = sha_lanes.absorb(state, sha_lanes.hex_block(child[None]))
            assert sha_lanes.finish(state, np.array([len(run)]))[0].tobytes() == parent.tobytes()
    stored = sha_lanes.to_states(sha_lanes.to_bytes(before))
    assert (stored == before).all() and sha_lanes.to_bytes(before[:1]).tobytes()[:4] == bytes.fromhex("6a09e667")
