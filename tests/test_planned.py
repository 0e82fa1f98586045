"""Planned files, manifests of committed files, heavy hitters and profiles that merge."""

import os
import random
import subprocess
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quayside.operators import heavy
from quayside.operators.heavy import heavy_hitters, miss_bound
from quayside.operators.profile_store import DISTINCT_ERROR, RANK_ERROR, ProfileStore
from quayside.sinks.file_manifest import check_manifest, write_with_manifest
from quayside.sinks.planned import plan_files, sink_planned

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_files_of_hot_and_rare_values(spark, folder):
    rows = spark.range(20_000).selectExpr("id", "case when id % 2 = 0 then 'hot' when id % 11 = 0 then null else concat('k', id % 997) end as v").repartition(6)
    plan = sink_planned(rows, folder, ["v"], rows_per_file=1000)
    back = spark.read.schema(rows.schema).parquet(folder)
    assert back.count() == 20_000 and back.select(F.sum("id")).first()[0] == sum(range(20_000))
    files = back.groupBy("v", F.col("_metadata.file_path").alias("f")).count().collect()
    per = Counter(r["v"] for r in files)
    assert per["hot"] == 10 and all(n == 1 for v, n in per.items() if v != "hot")
    assert max(r["count"] for r in files) < 1250
    tasks = plan.where("pieces = 1").groupBy("first").agg(F.sum("n").alias("n")).collect()
    # Rare values share tasks of about the target size, none alone in many of them.
    assert len(tasks) <= 11 and max(r["n"] for r in tasks) < 2000


def test_plans_of_odd_tables(spark, folder):
    none = spark.createDataFrame([], "a int, b string")
    assert plan_files(none, ["b"])[1] == 1 and sink_planned(none, f"{folder}/x", ["b"]).count() == 0
    one = spark.createDataFrame([(1, "x"), (2, "x"), (3, None)], "a int, b string")
    sink_planned(one, f"{folder}/y", ["b"], rows_per_file=1)
    assert sorted(r["a"] for r in spark.read.schema(one.schema).parquet(f"{folder}/y").collect()) == [1, 2, 3]
    two = spark.range(60).selectExpr("id", "id % 3 as `a b`", "id % 2 as c")
    sink_planned(two, f"{folder}/z", ["a b", "c"], rows_per_file=4)
    assert spark.read.parquet(f"{folder}/z").count() == 60


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_manifests_tell_what_became_of_files(spark, folder, fmt):
    rows = spark.range(100).selectExpr("id", "concat('v', id) as v").repartition(4)
    path = f"{folder}/zone"
    manifest = write_with_manifest(rows, path, fmt)
    assert manifest.agg(F.sum("rows")).first()[0] == 100 and check_manifest(spark, path, rows.schema, fmt).count() == 0
    names = sorted(r["file"] for r in manifest.collect())
    os.rename(f"{path}/{names[0]}", f"{path}/part-other.{fmt}")
    want = {(f"part-other.{fmt}", "added"), (names[0], "missing")}
    assert set(map(tuple, check_manifest(spark, path, rows.schema, fmt).collect())) == want


RETRY = """
import sys
sys.path.insert(0, sys.argv[2])
from pyspark import TaskContext
from quayside.session import build_session
from quayside.sinks.file_manifest import write_with_manifest
from pyspark.sql import functions as F
spark = build_session("local[2,3]", spark__ui__enabled="false", spark__checkpoint__dir=sys.argv[1])
def faulty(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() == 1:
        raise RuntimeError("the first attempt is lost after all its rows")
rows = spark.range(0, 1000, 1, 4).mapInArrow(faulty, "id bigint")
told = write_with_manifest(rows, sys.argv[1] + "/zone").agg(F.sum("rows"), F.count("file")).first()
print("ROWS", told[0], told[1], spark.read.parquet(sys.argv[1] + "/zone").count())
"""


def test_an_attempt_that_failed_is_in_no_manifest(folder):
    out = subprocess.run([sys.executable, "-c", RETRY, folder, HERE], capture_output=True, text=True, timeout=300)
    assert "ROWS 1000 4 1000" in out.stdout, out.stderr[-2000:]


@pytest.mark.parametrize("counters, certain", [(10_000, True), (16, False), (200, True)])
def test_heavy_hitters(spark, counters, certain):
    rng = random.Random(6)
    values = ["hot"] * 900 + ["x" * 100 + "b"] * 700 + ["x" * 100 + "a"] * 700 + [f"t{rng.randrange(4000)}" for _ in range(3000)] + [None] * 50
    rng.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "`a b` string").repartition(5)
    found = heavy_hitters(df, "a b", 2, counters)
    assert found.certain == certain
    # Equal counts are told by the whole value, not by its digest.
    assert [tuple(r) for r in found.rows.collect()] == [("hot", 900), ("x" * 100 + "a", 700)]
    ids = spark.createDataFrame([(i % 7,) for i in range(100)], "v int")
    assert [tuple(r) for r in heavy_hitters(ids, "v", 3, counters).rows.collect()] == [(0, 15), (1, 15), (2, 14)]


def test_heavy_hitters_of_little(spark):
    none = spark.createDataFrame([(None,)], "v string")
    assert heavy_hitters(none, "v").rows.count() == 0 and heavy_hitters(none.limit(0), "v").rows.count() == 0
    assert miss_bound(10**9, heavy.COUNTERS) <= 10**9 // 2000


def test_recounting_moves_candidates_only(spark):
    df = spark.range(0, 50_000, 1, 8).selectExpr("case when id % 4 = 0 then 'hot' else sha2(cast(id as string), 256) end as v")
    found = heavy_hitters(df, "v", 1, 64)
    plan = found.rows._jdf.queryExecution().executedPlan().toString()
    assert found.certain and found.candidates <= 64 and "BroadcastHashJoin" in plan and found.rows.first()["n"] == 12_500


def test_profiles_that_merge(spark, folder):
    store = ProfileStore(spark, folder)
    rows = spark.range(30_000).selectExpr("id", "id % 1234 as v", "cast(id as string) as t", "case when id % 5 = 0 then null else id / 7 end as d", "array(id % 3) as a")
    for run in range(3):
        store.add(f"r{run}", rows.where(f"id % 3 = {run}"))
    store.add("r1", rows.where("id % 3 = 1"))
    store.add("empty", rows.limit(0))
    got = {r["column_name"]: r for r in store.merged(probs=[0.1, 0.9]).collect()}
    exact = {"id": 30_000, "v": 1234, "t": 30_000, "d": 24_000, "a": 3}
    for name, n in exact.items():
        assert got[name]["row_count"] == 30_000 and abs(got[name]["distinct_estimate"] - n) <= DISTINCT_ERROR * n, name
    assert got["d"]["null_count"] == 6000 and got["t"]["quantiles"] is None and got["id"]["runs"] == 4
    assert got["id"]["mean_value"] == pytest.approx(14_999.5) and got["id"]["std_value"] == pytest.approx(8660.398, rel=1e-6)
    assert all(abs(q / 30_000 - p) <= RANK_ERROR + 1e-4 for q, p in zip(got["id"]["quantiles"], (0.1, 0.9)))
    assert store.merged(["r0"]).where("column_name = 'v'").first()["row_count"] == 10_000
    assert ProfileStore(spark, f"{folder}/none").merged().count() == 0
