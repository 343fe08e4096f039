"""Batch ends by counting: equal a sort, for ties, hot groups, extremes and empty input; nothing is gathered in the plan."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import selection
from tidemark.operators.batches import batch_ends, next_batch


@pytest.mark.parametrize("seed", range(3))
def test_equals_a_sort(spark, seed):
    rng = random.Random(seed)
    pick = [lambda: rng.randrange(50), lambda: rng.choice([7, 7, 7, rng.randrange(10**15)]), lambda: rng.randrange(-(1 << 63), 1 << 63)][seed]
    rows = [(rng.choice([0, 0, 0, 1, 2]), pick()) for _ in range(600)] + [(3, None), (4, 5), (0, -(1 << 63)), (0, (1 << 63) - 1)]
    df = spark.createDataFrame(rows, "g int, v long")
    for k in (1, 2, 117, 10**6):
        want = {}
        for g in range(5):
            vs = sorted(v for h, v in rows if h == g and v is not None)
            if vs:
                want[g] = vs[min(k, len(vs)) - 1]
        assert selection.kth_smallest(df, F.col("v"), k, "g") == want
    vs = sorted(v for _, v in rows if v is not None)
    assert selection.kth_smallest(df, F.col("v"), 300) == {0: vs[299]}
    assert set(selection.kth_smallest(df, F.col("v"), {1: 2, 3: 1}, "g")) == {1}


def test_empty_and_bad_sizes(spark):
    df = spark.createDataFrame([], "g int, v long")
    assert selection.kth_smallest(df, F.col("v"), 3, "g") == {}
    with pytest.raises(ValueError):
        selection.kth_smallest(spark.range(3), F.col("id"), 0)
    ts = spark.createDataFrame([], "ts timestamp, x int")
    assert next_batch(ts, "ts", 5).count() == 0


def test_no_top_k_or_single_task_in_the_plan(spark, tmp_path):
    path = str(tmp_path / "feed")
    feed = spark.range(50_000).select(F.timestamp_seconds(F.lit(1_704_067_200) + F.floor(F.col("id") / 3)).alias("ts"), "id")
    feed.write.parquet(path)
    df = spark.read.parquet(path)
    batch = next_batch(df, "ts", 1000)
    plan = batch._jdf.queryExecution().executedPlan().toString()
    for gathered in ("TakeOrderedAndProject", "CollectLimit", "GlobalLimit", "WindowGroupLimit", "SinglePartition"):
        assert gathered not in plan, gathered
    assert "LessThanOrEqual(ts" in plan  # the end is a constant: it reaches the scan
    assert batch.count() == 1002  # the tie group at the end stays whole
    ends = batch_ends(df.withColumn("n", F.col("id") % 2), "ts", {0: 10, 1: 10**9}, "n")
    assert ends[0] == (1_704_067_200 + 18 // 3) * 1_000_000 and ends[1] == (1_704_067_200 + 49_999 // 3) * 1_000_000


def test_hash_random_samples_find_differences_anywhere(spark):
    """V3: both samples end at one hash, so they show exactly the sampled part of a full reconcile."""
    from tidemark.operators import reconcile

    at = lambda df: df.select(F.col("id"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id")).alias("ts"))
    source = at(spark.range(4000).where("id % 10 != 3"))  # phantoms everywhere, not among the newest only
    target = at(spark.range(4000).where("id % 10 != 7"))  # and missing ones
    s, t = reconcile.hash_samples(source, target, "ts", 500)
    assert abs(s.count() - 500) < 60 and s.count() + t.count() in (1000, 1001)  # both copies of the record at the bound are in
    got = {(r["id"], r["issue"]) for r in reconcile.sampled_differences(source, target, "ts", 500).collect()}
    ids = {r["id"] for r in s.collect()} | {r["id"] for r in t.collect()}
    assert got == {(i, "phantom_record" if i % 10 == 3 else "missing_record") for i in ids if i % 10 in (3, 7)}
    assert min(i for i, _ in got) < 400 and len(got) > 60
    assert reconcile.sampled_differences(source, source, "ts", 10**6).count() == 0  # a sample of everything, no difference
    assert reconcile.sampled_differences(source.limit(0), target.limit(0), "ts", 5).count() == 0
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "TakeOrdered" not in plan and "Exchange" not in plan


def test_hash_random_samples_compute_each_key_once(spark):
    """Keys are hashes of whole records: passes and filters must not compute them again."""
    from pyspark.sql import types as T

    from tidemark.operators import reconcile

    asked = spark.sparkContext.accumulator(0)

    def key(i):
        asked.add(1)
        return i

    source = spark.range(3000).select(F.udf(key, T.LongType())("id").alias("id"), F.timestamp_seconds("id").alias("ts"))
    target = spark.range(3000).where("id % 10 != 7").select("id", F.timestamp_seconds("id").alias("ts"))
    found = reconcile.sampled_differences(source, target, "ts", 300).collect()
    assert found and all(r["id"] % 10 == 7 and r["issue"] == "missing_record" for r in found)
    assert asked.value == 3000
