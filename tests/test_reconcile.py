"""Content reconciliation and bucketed surrogates, against plain Python and through their plans."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from quayside.operators.reconcile import content_digest, differing_buckets, reconcile_content
from quayside.operators.surrogate_buckets import BucketedMap, attach_surrogates
from quayside.operators.tokenize import apply_template

SCHEMA = "k int, v string, x double, m map<string,int>"


def expected(left, right):
    flat = lambda rows: Counter((k, v, x, tuple(sorted(m.items())) if m else m) for k, v, x, m in rows)
    a, b = flat(left), flat(right)
    out = [(*r, "source", n) for r, n in (a - b).items()] + [(*r, "destination", n) for r, n in (b - a).items()]
    sides = {}
    for r in out:
        sides.setdefault(r[0], set()).add(r[4])
    told = {"source": "missing", "destination": "added"}
    return sorted((*map(str, r), "changed" if len(sides[r[0]]) == 2 else told[r[4]]) for r in out)


LEFT = [(1, "a", 0.0, None), (2, None, 1.0, {"a": 1}), (None, "n", None, None), (3, "x", 1.0, None), (3, "x", 1.0, None), (4, "y", None, None)] + [
    (100 + i, "same", 1.5, None) for i in range(500)
]
RIGHT = [(1, "a", -0.0, None), (2, None, 1.0, {"a": 2}), (None, "n", None, None), (None, "n", None, None), (3, "x", 1.0, None), (4, None, None, None)] + [
    (100 + i, "same", 1.5, None) for i in range(1, 501)
]


@pytest.mark.parametrize("bits, step", [(16, 4), (7, 3), (1, 4)])
def test_rows_that_differ(spark, bits, step):
    left, right = (spark.createDataFrame(rows, SCHEMA).repartition(3) for rows in (LEFT, RIGHT))
    got = reconcile_content(left, right, ["k"], bits, step).collect()
    flat = [(r["k"], r["v"], 0.0 if r["x"] == 0 else r["x"], tuple(sorted(r["m"].items())) if r["m"] else r["m"], r["side"], r["copies"], r["change"]) for r in got]
    assert sorted(tuple(map(str, r)) for r in flat) == expected(LEFT, RIGHT)


def test_swapped_nulls_and_empty_sides(spark):
    a, b = (spark.createDataFrame(rows, "k int, p int, q int") for rows in ([(1, 2, None)], [(1, None, 2)]))
    assert reconcile_content(a, b, ["k"]).count() == 2 and reconcile_content(a, a, ["k"]).count() == 0
    none = a.limit(0)
    assert [r["change"] for r in reconcile_content(a, none, ["k"]).collect()] == ["missing"]
    assert reconcile_content(none, none, ["k"]).count() == 0
    with pytest.raises(ValueError, match="different columns"):
        reconcile_content(a, b.withColumn("more", F.lit(1)), ["k"])


def test_only_differing_buckets_are_opened(spark):
    left = spark.range(20_000).selectExpr("id as k", "id * 2 as v")
    right = left.withColumn("v", F.when(F.col("k") == 77, 0).otherwise(F.col("v")))
    a, b = content_digest(left, ["k"]), content_digest(right, ["k"])
    assert differing_buckets(a, b).count() == 1 and a.count() > 10_000
    assert differing_buckets(a, a).count() == 0


def test_numbers_of_buckets(spark, folder):
    known = BucketedMap(spark, f"{folder}/map", 4)
    rows = spark.createDataFrame([(i, f"v{i % 40}" if i % 7 else None, f"v{i % 60}") for i in range(300)], "id int, p string, q string")
    first = attach_surrogates(rows, {"p": known, "q": known})
    assert first.columns == rows.columns
    pairs = first.join(rows.toDF("id", "pv", "qv"), "id").collect()
    numbers = {}
    for r in pairs:
        for value, number in ((r["pv"], r["p"]), (r["qv"], r["q"])):
            assert (value is None) == (number is None)
            if value is not None:
                assert numbers.setdefault(value, number) == number
    assert len(set(numbers.values())) == len(numbers) == 60 and min(numbers.values()) >= 1
    more = spark.createDataFrame([(1, "v3", "new")], "id int, p string, q string")
    got = attach_surrogates(more, {"p": known, "q": known}).first()
    assert got["p"] == numbers["v3"] and got["q"] not in numbers.values() and known.read().count() == 61


def test_two_writers_give_one_number_to_a_value(spark, folder, monkeypatch):
    one, other = BucketedMap(spark, f"{folder}/map", 2), BucketedMap(spark, f"{folder}/map", 2)
    digests = lambda *v: spark.createDataFrame([(x,) for x in v], "v string").select(F.unhex(F.sha2("v", 256)).alias("digest"))
    read = one.read

    def overtaken(version=None):
        monkeypatch.setattr(one, "read", read)
        other.extend(digests("a", "b", "c"))
        return read(version)

    monkeypatch.setattr(one, "read", overtaken)
    assert one.extend(digests("b", "d")).count() == 4
    got = [r["surrogate_id"] for r in one.read().collect()]
    assert len(got) == len(set(got)) == 4


def test_rows_are_exchanged_once_for_all_columns(spark, folder):
    rows = spark.range(2000).selectExpr("id", "repeat(cast(id % 50 as string), 3000) as long", "id % 9 as a", "id % 3 as b")
    path = f"{folder}/rows"
    rows.write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        maps = {c: BucketedMap(spark, f"{folder}/{c}", 8) for c in ("long", "a", "b")}
        out = apply_template(spark.read.parquet(path), dict.fromkeys(maps, "surrogate"), None, maps)
        plan = out._jdf.queryExecution().executedPlan().toString()
        exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        # Numbers by digest, rows' numbers, and the rows themselves; texts are in none of them but the digest's scan.
        assert sum("_row" in line for line in exchanges) == 2 and len(exchanges) <= 5, plan
        assert out.count() == 2000 and out.where("long is null or a is null or b is null").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
