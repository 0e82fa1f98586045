"""Quality rules, secrets, decontamination, similarity join, repeats: against brute force and at the edges."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from quayside.llm import decontaminate, ngram_join, quality_rules, secret_scan, suffix_dedup
from quayside.llm.queries import ORACLES, QUERIES
from tests.compare import connect, difference
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(text, seed, edits):
    rng, words = random.Random(seed), text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    base = [prose(i, 120) for i in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, base[0]) for i in range(40)]  # exact copies
    rows += [(200 + i, edited(base[1], i, 1 + i % 3)) for i in range(40)]  # near copies
    rows += [(300 + i, prose(900 + i, 60) + " " + base[2][:400]) for i in range(30)]  # a shared passage
    rows += [(400, None), (401, ""), (402, " \n\t"), (403, "one two"), (404, "One TWO"), (405, "é É"), (406, "x " * 3000)]
    rows += [(407, base[3]), (407, base[3]), (None, base[4]), (None, "alone here now and then")]
    return rows


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) is None


def test_entry_has_the_queries():
    names = __spark_entry__.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


def test_native_plans(spark):
    for name in ("op2_decontamination", "op3_quality_rules", "op6_secret_scan"):
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        for node in ("Python", "Pandas", "InArrow", "CartesianProduct", "NestedLoop"):
            assert node not in plan


def test_components(docs, corpus):
    got = Counter(map(tuple, ngram_join.similar_components(docs).collect()))
    assert got == brute.components(corpus)


def test_components_beyond_the_short_lists(spark, monkeypatch):
    """Chains: neighbours are linked, ends are not, so long lists need their second round."""
    monkeypatch.setattr(ngram_join, "LONG_LIST", 2)
    words = prose(7, 200, 10**6).split()
    rows = []
    for k in range(25):
        rows.append((k, " ".join(words)))
        for j in range(4):
            words[(k * 31 + j) % 200] = f"c{k}x{j}"
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, ngram_join.similar_components(table).collect())) == brute.components(rows)


def test_repeats(docs, corpus, spark):
    rows = [r for r in corpus if r[0] is not None and r[0] != 407]
    rows += [(1000, "a" * 300), (1001, "ab" * 80 + "x" * 99 + "y" + "ab" * 80), (1002, "é" * 120), (1003, "z" * 99), (1004, "a" * 101)]
    rows += [(None, rows[5][1])]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r[0]: tuple(r[1:5]) for r in suffix_dedup.remove_repeats(table).collect()}
    assert got == brute.removal(rows)
    kept = suffix_dedup.remove_repeats(table, with_kept=True).where("n_removed > 0").select("kept", "kept_sha256", F.sha2("kept", 256).alias("h"))
    assert kept.where("h <> kept_sha256").count() == 0 and kept.count() > 0


def test_repeats_with_one_id_for_two_rows(spark):
    text = prose(1, 100)
    table = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    assert [r["n_removed"] for r in suffix_dedup.remove_repeats(table).collect()] == [0, 0]


def test_leaks(spark):
    items = [(1, prose(50, 30)), (2, prose(51, 12)), (3, "three words only"), (4, None), (5, "  "), (6, prose(52, 40))]
    docs = [
        (1, prose(60, 50) + " " + items[0][1].upper() + " " + prose(61, 50)),
        (2, items[1][1]),
        (3, "so here are three words only as a leak"),
        (4, prose(62, 30) + " " + edited(items[5][1], 3, 1)),
        (5, prose(63, 300)),
        (6, None),
        (7, ""),
        (8, items[5][1][:60]),
        (9, items[0][1]),
        (9, items[0][1]),
    ]
    got = decontaminate.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash")),
        spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash")),
    ).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == brute.item_leaks(docs, items)
    assert len(got) == len({(r["doc_id"], r["item_id"]) for r in got})


def test_leaks_of_items_with_moved_parts(spark):
    rng = random.Random(9)
    unlike = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    item = unlike(100)
    turned = lambda k: " ".join([*unlike(40), *item[k:], *item[:k], *unlike(40)])
    docs = [(k, turned(k)) for k in (0, 5, 12, 30, 50, 70, 88, 95)]
    docs += [(100 + k, " ".join(item[k:] + item[:k])) for k in (12, 50, 88)] + [(None, turned(30))]
    items = [(1, " ".join(item)), (2, " ".join(unlike(100))), (3, " ".join(item[:60]))]
    got = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == brute.item_leaks(docs, items)
    assert {r["doc_id"] for r in got if r["item_id"] == 1} == {d for d, _ in docs}
    # A turned item keeps 92 of its 96 shingles, in the window that starts where it does.
    for r in got:
        if r["item_id"] == 1 and r["doc_id"] in (12, 30, 50, 70, 88):
            assert (r["start"], r["similarity"]) == (40, 92 / 100)


def test_block_masks_reach_every_pair_within_the_radius():
    rng = random.Random(5)
    masks = set(decontaminate.block_masks(8, 23 // 8))
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 23):
            b ^= 1 << bit
        assert any(((a >> 8 * k) & 255) ^ ((b >> 8 * k) & 255) in masks for k in range(8))


def test_quality_edges(spark):
    rows = [(None, None), (1, ""), (2, "\t\n "), (3, "a b c " * 40), (4, prose(1, 60)), (5, "#" * 200_000), (4, prose(1, 60))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("words", F.lit(1)).withColumn("counts", F.lit(2))
    out = quality_rules.apply_rules(df, out="q", rules=[quality_rules.Rule("symbol_ratio", None, 0.1)])
    got = {r["doc_id"]: (r["q"]["counts"]["n_words"], r["q"]["base_failed"], r["q"]["kept"]) for r in out.collect()}
    assert got == {
        None: (0, True, False), 1: (0, True, False), 2: (0, True, False), 3: (120, True, False), 4: (60, False, True), 5: (1, True, False)
    }
    assert out.where("q.kept").count() == 2 and out.columns == [*df.columns, "q"]
    with pytest.raises(ValueError):
        quality_rules.apply_rules(df, out="COUNTS")
    with pytest.raises(ValueError):
        quality_rules.compile_rules([quality_rules.Rule("unknown")], F.lit(1))


def test_secret_spans_and_redaction(spark):
    texts = ["", None, "password = hunter22", "x AKIA" + "A" * 16 + " y", "é token:abc", "token=token:longvalue1 secret='abcdef'", "0" * 24 + "g" + "a" * 30]
    rows = [(i, t) for i, t in enumerate(texts)] + [(2, texts[2])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("blob", F.lit("clash"))
    out, ledger = secret_scan.scan_versions(df, secret_scan.empty_ledger(spark))
    spans = {r["doc_id"]: r["s"] for r in out.select("doc_id", secret_scan.span_text(F.col("findings")).alias("s")).collect()}
    assert spans == {
        0: "", 1: "", 2: "assign:0:19", 3: "access:2:22", 4: "", 5: "assign:23:37", 6: "hex:0:24,hex:25:55"
    }
    clean = {r["doc_id"]: r["t"] for r in out.select("doc_id", secret_scan.redact(F.col("text"), F.col("findings")).alias("t")).collect()}
    assert clean[2] == "[secret]" and clean[3] == "x [secret] y" and clean[6] == "[secret]g[secret]" and clean[1] is None
    assert out.count() == len(rows) and set(out.columns) == {"doc_id", "text", "blob", "findings"}
    assert ledger.count() == 6  # null and empty are one content, and so are the two copies


def test_secret_ledger_is_incremental(spark):
    first = spark.createDataFrame([(1, "token=abcdef1"), (2, "nothing")], "doc_id long, text string")
    more = spark.createDataFrame([(3, "token=abcdef1"), (4, "token=zzzzzz9")], "doc_id long, text string")
    _, ledger = secret_scan.scan_versions(first, secret_scan.empty_ledger(spark))
    assert secret_scan.unseen_blobs(more, ledger).count() == 1
    out, added = secret_scan.scan_versions(more, ledger)
    assert added.count() == 1 and out.where(F.size("findings") == 1).count() == 2
    other = secret_scan.RULES[:1]
    assert secret_scan.unseen_blobs(more, ledger, rules=other).count() == 2


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert ngram_join.similar_components(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert decontaminate.find_leaks(none, items).count() == 0
    assert quality_rules.apply_rules(none).count() == 0
    assert secret_scan.scan_versions(none, secret_scan.empty_ledger(spark))[0].count() == 0
