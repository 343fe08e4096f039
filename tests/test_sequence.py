"""Bucket-split ordered helpers equal plain windows, also with one hot key or burst."""

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import sequence
from tidemark.operators.sequence import latest_per_key, neighbor_row, neighbor_rows, rank_within, running_sum


def _skewed(spark):
    # key 0 holds a third of the rows; timestamps with ties, spread over days
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"),
        (F.lit(1704067200) + (F.col("id") * 7919) % (20 * 86400)).cast("timestamp").alias("ts"),
        F.col("id").alias("tb"), (F.col("id") % 7).alias("v"))
    return df.unionByName(df.where(F.col("id") % 11 == 0).withColumn("tb", F.col("tb") + 100000))


def _burst(spark):
    # one key, one instant: a third of the rows share key 0 and the same timestamp
    df = _skewed(spark)
    return df.withColumn("ts", F.when(F.col("k") == 0, F.lit("2024-01-05 00:00:00").cast("timestamp"))
                         .otherwise(F.col("ts")))


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("bucket", [3600, None])
@pytest.mark.parametrize("fixture", ["skewed", "burst"])
def test_neighbor_rows_match_lag_lead(spark, bucket, fixture):
    df = _skewed(spark) if fixture == "skewed" else _burst(spark)
    w = Window.partitionBy("k").orderBy("ts", "tb")
    for direction, fn in ((-1, F.lag), (1, F.lead)):
        got = neighbor_row(df, ["k"], "ts", ["tb"], ["v"], out="n", direction=direction, bucket_seconds=bucket) \
            .select("k", "tb", F.col("n.tb").alias("ntb"), F.col("n.v").alias("nv"))
        want = df.select("k", "tb", fn("tb").over(w).alias("ntb"), fn("v").over(w).alias("nv"))
        assert _same(got, want)


@pytest.mark.parametrize("bucket", [7200, None])
def test_neighbor_rows_both_directions(spark, bucket):
    df = _burst(spark)
    w = Window.partitionBy("k").orderBy("ts", "tb")
    got = neighbor_rows(df, ["k"], "ts", ["tb"], ["v"], bucket_seconds=bucket) \
        .select("k", "tb", F.col("prev.tb").alias("p"), F.col("next.tb").alias("n"))
    want = df.select("k", "tb", F.lag("tb").over(w).alias("p"), F.lead("tb").over(w).alias("n"))
    assert _same(got, want)


@pytest.mark.parametrize("bucket", [3600, None])
def test_running_sum_matches_window(spark, bucket):
    df = _burst(spark)
    w = Window.partitionBy("k").orderBy("ts", "tb").rowsBetween(Window.unboundedPreceding, 0)
    got = running_sum(df, ["k"], "ts", ["tb"], F.col("v"), "s", bucket).select("k", "tb", "s")
    want = df.select("k", "tb", F.sum("v").over(w).alias("s"))
    assert _same(got, want)


@pytest.mark.parametrize("bucket", [3600, None])
@pytest.mark.parametrize("fixture", ["skewed", "burst"])
def test_rank_matches_window(spark, bucket, fixture):
    df = _skewed(spark) if fixture == "skewed" else _burst(spark)
    got = rank_within(df, ["k"], "ts", "r", bucket).select("k", "tb", "r")
    want = df.select("k", "tb", F.rank().over(Window.partitionBy("k").orderBy("ts")).cast("bigint").alias("r"))
    assert _same(got, want)


def test_latest_per_key(spark):
    df = _skewed(spark)
    got = latest_per_key(df, ["k"], "ts", ["tb"], ["v"]).select("k", "tb", "v")
    w = Window.partitionBy("k").orderBy(F.col("ts").desc(), F.col("tb").desc())
    want = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("k", "tb", "v")
    assert _same(got, want)


def _large(spark):
    """400,000 rows, a third of them in one key and half of those at one instant."""
    ts = (F.lit(1704067200) + (F.col("id") * 7919) % (20 * 86400)).cast("timestamp")
    return spark.range(400_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500).alias("k"),
        F.when(F.col("id") % 6 == 0, F.lit("2024-01-05 00:00:00").cast("timestamp")).otherwise(ts).alias("ts"),
        F.col("id").alias("tb"), (F.col("id") % 7).alias("v"), F.concat(F.lit("carried "), F.col("id") % 13).alias("extra"))


@pytest.mark.parametrize("aqe", ["true", "false"])
def test_many_buckets_and_a_carried_column(spark, aqe):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions",
                                             "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "48k")
    try:
        df = _large(spark)
        buckets = sequence._with_bucket(df, "ts", None, ["tb"], ["k"])
        assert buckets.where("k = 0").select(sequence.BUCKET).distinct().count() > 4
        w = Window.partitionBy("k").orderBy("ts", "tb")
        got = running_sum(df, ["k"], "ts", ["tb"], F.col("v"), "s").select("tb", "extra", "s")
        assert _same(got, df.select("tb", "extra", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s")))
        got = neighbor_row(df, ["k"], "ts", ["tb"], ["v"], out="n").select("tb", "extra", F.col("n.tb").alias("p"))
        assert _same(got, df.select("tb", "extra", F.lag("tb").over(w).alias("p")))
        got = neighbor_rows(df, ["k"], "ts", ["tb"], ["v"]).select("tb", "extra", F.col("prev.tb").alias("p"), F.col("next.tb").alias("n"))
        assert _same(got, df.select("tb", "extra", F.lag("tb").over(w).alias("p"), F.lead("tb").over(w).alias("n")))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
