"""Near-duplicates by bottom-k sketches: against brute force, at the bounds of set sizes, and under skew."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import bottom_k
from quayside.llm.queries import QUERIES
from quayside.llm.shingles import WordHashes, shingle_set
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


def expected(rows):
    sizes, plain = [len(brute.shingles(t, 2)) for _, t in rows], brute.shingles
    try:
        brute.shingles = lambda text: plain(text, 2)
        out = brute.components(rows)
    finally:
        brute.shingles = plain
    assert sum(out.values()) == len(sizes)
    return out


def found(frame):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in frame.collect())


def edit(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at, kind = rng.randrange(len(words)), rng.randrange(3)
        if kind == 0:
            words[at] = f"x{rng.randrange(9)}"
        elif kind == 1:
            words.insert(at, f"x{rng.randrange(9)}")
        elif len(words) > 1:
            words.pop(at)
    return words


@pytest.fixture(scope="module")
def corpus():
    """Texts of every size around the bounds with near copies; a large group of copies; a passage that many share."""
    rng, rows = random.Random(17), []
    add = lambda words: rows.append((len(rows), " ".join(words)))
    for n in [*range(1, 26), 96, 97, 98, 119, 120, 121, 150, 151, 152, 400]:
        for _ in range(4):
            words = [f"w{rng.randrange(5000)}" for _ in range(n)]
            add(words)
            for _ in range(3):
                add(edit(rng, words, rng.randrange(1, max(2, n // 14) + 1)))
    base = [f"b{rng.randrange(300)}" for _ in range(180)]
    for k in range(120):
        add(edit(rng, base, k % 12) if k > 60 else base)
    for _ in range(80):
        add([*(f"u{rng.randrange(9000)}" for _ in range(60)), *base[:60], *(f"u{rng.randrange(9000)}" for _ in range(40))])
    rows += [(9000, None), (9001, ""), (9002, " \n\t"), (9003, "one"), (9004, "ONE"), (9005, "one two"), (9006, "a a a a a")]
    rows += [(9007, "once more the same words here"), (9007, "once more the same words here"), (9007, "another text"), (None, "once more the same words here"), (None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("partners", [1, 2])
def test_against_brute_force(spark, corpus, monkeypatch, partners):
    monkeypatch.setattr(bottom_k, "PARTNERS", partners)
    docs = spark.createDataFrame(corpus, "doc_id long, text string").repartition(5)
    assert found(bottom_k.similar_rows(docs)) == expected(corpus)


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    out = QUERIES["op11_bottom_k"](spark, FOLDER)
    assert found(out) == expected(rows)
    assert out.columns[:4] == ["doc_id", "n_shingles", "component_id", "kept"]
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out.collect())


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, set string, c int, key int")
    assert bottom_k.similar_rows(empty).count() == 0
    rows = spark.createDataFrame([(1, "a b c", "s", 1, 2), (2, None, "s", 1, 2), (None, "a b c", None, None, None)], empty.schema)
    got = {(r["doc_id"], r["component_id"], r["kept"], r["n_copies"]) for r in bottom_k.similar_rows(rows).collect()}
    assert got == {(1, 1, True, 2), (2, 2, True, 1), (None, 1, False, 2)}
    none = spark.createDataFrame([(None, "x y"), (None, "x y")], "doc_id long, text string")
    assert [r["kept"] for r in bottom_k.similar_rows(none).collect()] == [True, True]


def test_linkable_sets_share_a_run():
    """Every pair of small sets at the threshold has a common key; of large ones all that were tried."""
    rng = np.random.default_rng(5)
    for n in [4, 5, 6, 9, 10, 11, 14, 15, 16, 19, 20, 24, 25, 60, 96, 100, 119, 150, 300]:
        for _ in range(300):
            union = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) << np.uint64(1))
            apart = rng.permutation(n)[: n // 5]
            left = rng.random(len(apart)) < rng.random()
            a = np.sort(np.delete(union, apart[left]))
            b = np.sort(np.delete(union, apart[~left]))
            keys = [bottom_k.run_keys(bottom_k.unpack(bottom_k.pack(bottom_k.sketch(s))), len(s)) for s in (a, b)]
            assert n < 5 or len(np.intersect1d(*keys)), (n, len(a), len(b))
            bits = [bottom_k.parity_bits(s).view(np.uint64) for s in (a, b)]
            assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= len(apart)
            assert bottom_k.may_link(*(x for s in (a, b) for x in (bottom_k.unpack(bottom_k.pack(bottom_k.sketch(s))), len(s))))[0]


def test_strangers_in_a_list_cost_no_pairs(spark, corpus):
    """Of a group of copies each class meets two others, and texts that share a passage meet none of each other."""
    docs = spark.createDataFrame(corpus, "doc_id long, text string")
    classes = bottom_k.Classes(docs, "doc_id", "text")
    lists, members = classes.lists()
    first = bottom_k._first_pairs(lists, members)
    assert first.count() <= bottom_k.PARTNERS * members.count()
    roots = classes._roots(classes.linked(first))
    assert bottom_k._open_pairs(lists, members, roots).count() < members.count()


def test_links_lie_between_classes_of_one_component(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id long, text string")
    member, links = bottom_k.similar_classes(docs)
    assert member.count() == len(corpus) and member.where("class is null").count() == sum(not (t or "").split() for _, t in corpus)
    texts = dict(row for row in member.join(docs, "doc_id").select("class", "text").collect() if row[0] is not None)
    for u, v in links.collect():
        a, b = (shingle_set(texts[x], WordHashes(), 2) for x in (u, v))
        shared = len(np.intersect1d(a, b))
        assert 100 * shared >= 80 * (len(a) + len(b) - shared)


def test_an_open_pair_is_made_once(spark):
    """Near copies share many lists; every pair that lists leave open comes back, and comes once."""
    rng, words = random.Random(5), [f"w{i}" for i in range(4000)]
    rows = []
    for base in range(3):
        whole = [rng.choice(words) for _ in range(200)]
        for copy in range(12):
            text = list(whole)
            for at in rng.sample(range(200), 4 + 2 * copy):
                text[at] = rng.choice(words)
            rows.append((100 * base + copy, " ".join(text)))
    found = bottom_k.Classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "doc_id", "text")
    lists, members = found.lists()
    # Components that no round has made: some of two classes, some of one.
    roots = members.select("c", F.when(F.pmod(F.xxhash64("c"), F.lit(3)) == 0, F.lit(-1)).otherwise(F.col("c")).alias("root"))
    got = [tuple(r) for r in bottom_k._open_pairs(lists, members, roots).collect()]
    known = {r["c"]: r for r in members.join(roots, "c").collect()}
    keys = {}
    for r in lists.collect():
        keys.setdefault(r["c"], set()).add(r["key"])

    def may(a, b):
        differ = sum(bin((a[w] ^ b[w]) & (2**64 - 1)).count("1") for w in bottom_k.BITS)
        return 100 * min(a["n"], b["n"]) >= 80 * max(a["n"], b["n"]) and 180 * differ <= 20 * (a["n"] + b["n"])

    want = {
        (a, b) for a in keys for b in keys
        if a < b and keys[a] & keys[b] and known[a]["root"] != known[b]["root"] and may(known[a], known[b])
    }
    shared = sum(len(keys[a] & keys[b]) for a, b in want)
    assert set(got) == want and len(got) == len(want) and shared > 5 * len(want) > 0
