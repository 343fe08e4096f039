"""Validation and monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.control import lag_seconds
from tidemark.operators.filters import ts_lit

# Validation thresholds of the reference.
STALLED_AFTER_MS = 600_000
SEVERE_LAG_S = 3600
LAG_S = 300
FRESH_WINDOW = "5 minutes"
HEALTHY = ("healthy", "ok")


def progress_check(specs: DataFrame, checkpoints: DataFrame, as_of, stalled_after_ms: int = STALLED_AFTER_MS,
                   severe_s: int = SEVERE_LAG_S, lag_s: int = LAG_S) -> DataFrame:
    """V1: per (table, node): no_checkpoint / stalled (no sync for more than
    10 min) / severely_lagging (> 1 h) / lagging (> 5 min) / healthy, in that order."""
    shards = specs.select("table_id", F.explode(F.sequence(F.lit(0), F.col("n_shards") - 1)).alias("node_id"))
    cp = checkpoints.select("table_id", "node_id", "last_timestamp", "last_sync_time", "records_ingested", "phase")
    j = shards.join(cp, ["table_id", "node_id"], "left")
    since_sync_ms = (F.unix_micros(ts_lit(as_of)) - F.unix_micros("last_sync_time")) / 1000
    lag = lag_seconds(F.col("last_timestamp"), as_of)
    status = (F.when(F.col("last_sync_time").isNull(), "no_checkpoint")
              .when(since_sync_ms > stalled_after_ms, "stalled")
              .when(lag > severe_s, "severely_lagging").when(lag > lag_s, "lagging").otherwise("healthy"))
    return j.select("table_id", "node_id", F.lit("progress").alias("check"), status.alias("status"),
                    F.round(lag, 3).alias("lag_seconds"), "records_ingested", "phase")


def freshness_check(table_id: str, target: DataFrame | None, ts_col: str, as_of,
                    window: str = FRESH_WINDOW) -> DataFrame:
    """V2: is the newest target row inside ``window`` before ``as_of``?
    ``table_not_found`` when the target is absent, ``no_recent_data``, or
    ``healthy`` with the lag of the newest row."""
    if target is None:
        raise ValueError("use freshness_missing() for absent tables")
    newest = target.where(F.col(ts_col) > ts_lit(as_of) - F.expr(f"INTERVAL {window}")).agg(
        F.max(ts_col).alias("latest_timestamp"))
    return newest.select(
        F.lit(table_id).alias("table_id"), F.lit("smoke_test").alias("check"),
        F.when(F.col("latest_timestamp").isNull(), "no_recent_data").otherwise("healthy").alias("status"),
        "latest_timestamp", F.round(lag_seconds(F.col("latest_timestamp"), as_of), 3).alias("lag_seconds"))


def freshness_missing(spark, table_id: str, status: str = "table_not_found") -> DataFrame:
    return spark.createDataFrame(
        [(table_id, "smoke_test", status, None, None)],
        "table_id string, check string, status string, latest_timestamp timestamp, lag_seconds double")


def spot_check(table_id: str, phantoms: DataFrame, missing: DataFrame, target_sample: DataFrame,
               source_sample: DataFrame) -> DataFrame:
    """V3: status of a two-way spot check from its issue frames and samples:
    no_data when the target sample is empty, else healthy / issues_found.
    All four inputs are tagged and folded in one aggregate."""
    tagged = (phantoms.select(F.lit("phantom").alias("kind"))
              .unionByName(missing.select(F.lit("missing").alias("kind")))
              .unionByName(target_sample.select(F.lit("t_sample").alias("kind")))
              .unionByName(source_sample.select(F.lit("s_sample").alias("kind"))))

    def n(kind):
        return F.sum(F.when(F.col("kind") == kind, 1).otherwise(0)).cast("bigint")

    agg = tagged.agg(n("phantom").alias("phantom_records"), n("missing").alias("missing_records"),
                     n("t_sample").alias("t_n"), n("s_sample").alias("s_n"))
    issues = F.coalesce(F.col("phantom_records") + F.col("missing_records"), F.lit(0))
    status = (F.when(F.coalesce("t_n", F.lit(0)) == 0, "no_data")
              .when(issues == 0, "healthy").otherwise("issues_found"))
    return agg.select(F.lit(table_id).alias("table_id"), F.lit("spot_check").alias("check"), status.alias("status"),
                      F.coalesce(F.col("t_n") + F.col("s_n"), F.lit(0)).alias("samples_checked"),
                      F.coalesce("phantom_records", F.lit(0)).alias("phantom_records"),
                      F.coalesce("missing_records", F.lit(0)).alias("missing_records"))


def health_rollup(checks: DataFrame) -> DataFrame:
    """A table is healthy iff all its checks are healthy/ok; overall
    healthy iff all tables are (rollup row with ``table_id`` NULL)."""
    ok = F.col("status").isin(list(HEALTHY))
    per_table = checks.groupBy("table_id").agg(F.bool_and(ok).alias("_ok"), F.count(F.lit(1)).alias("checks"))
    overall = per_table.agg(F.lit(None).cast("string").alias("table_id"), F.bool_and("_ok").alias("_ok"),
                            F.sum("checks").cast("bigint").alias("checks"))
    both = per_table.select("table_id", "_ok", F.col("checks").cast("bigint")).unionByName(overall)
    return both.select("table_id", "checks",
                       F.when(F.col("_ok"), "healthy").otherwise("issues_detected").alias("overall_status"))


def validation_audit_row(checks: DataFrame, as_of, run_id: str) -> DataFrame:
    """V4: one audit row: overall status (healthy iff every check is) and all
    check results as JSON (one row per table and check: bounded by the specs)."""
    ok = F.col("status").isin(list(HEALTHY))
    agg = checks.agg(F.bool_and(ok).alias("_ok"),
                     F.to_json(F.collect_list(F.struct(*[F.col(c) for c in checks.columns]))).alias("check_results"))
    status = F.when(F.col("_ok"), "healthy").otherwise("issues_detected")
    return agg.select(
        F.lit(f"validation-{run_id}").alias("id"), ts_lit(as_of).alias("timestamp"),
        F.lit(None).cast("string").alias("table_id"), F.lit(None).cast("int").alias("node_id"),
        status.alias("status"),
        F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("record_sample"),
        F.lit(None).cast("bigint").alias("source_count"), F.lit(None).cast("bigint").alias("target_count"),
        F.lit(None).cast("bigint").alias("delta"), "check_results",
        F.concat(F.lit("validation "), status).alias("message"))


def alerts(progress: DataFrame, drift: DataFrame, checkpoints: DataFrame, as_of, drift_over: int = 1000,
           lag_over_s: int = 1800, no_update_s: int = 300) -> DataFrame:
    """V7: drift > 1000; lag > 30 min; no checkpoint update in 5 min."""
    a1 = drift.where(F.col("delta") > drift_over).select(
        F.lit(None).cast("string").alias("table_id"), F.col("shard").cast("int").alias("node_id"),
        F.lit("count_drift").alias("alert"), F.col("delta").cast("double").alias("value"))
    a2 = progress.where(F.col("lag_seconds") > lag_over_s).select(
        "table_id", "node_id", F.lit("lag").alias("alert"), F.col("lag_seconds").cast("double").alias("value"))
    since = (F.unix_micros(ts_lit(as_of)) - F.unix_micros("last_sync_time")) / F.lit(1e6)
    a3 = checkpoints.where(since > no_update_s).select(
        "table_id", "node_id", F.lit("no_checkpoint_update").alias("alert"), since.alias("value"))
    return a1.unionByName(a2).unionByName(a3)


def shard_balance(df: DataFrame, shard_col: str, n_shards: int, tolerance: float = 0.10) -> DataFrame:
    """V8: rows per shard, deviation from the even share, and whether every
    shard is within ``tolerance`` of it (empty shards count as 0)."""
    spark = df.sparkSession
    all_shards = spark.range(n_shards).select(F.col("id").alias(shard_col))
    counts = df.groupBy(shard_col).agg(F.count(F.lit(1)).alias("rows"))
    j = all_shards.join(counts, shard_col, "left").select(shard_col, F.coalesce("rows", F.lit(0)).alias("rows"))
    total = F.sum("rows").over(Window.partitionBy())  # n_shards rows
    share = total / F.lit(n_shards)
    dev = F.when(share > 0, F.abs(F.col("rows") - share) / share).otherwise(F.lit(0.0))
    return j.select(shard_col, "rows", F.round(dev, 6).alias("deviation"), (dev <= tolerance).alias("balanced"))


def monitoring_aggregates(audit: DataFrame, batch_log: DataFrame, checkpoints: DataFrame, as_of) -> DataFrame:
    """V9: errors by table; batches by phase; average lag by shard (long form)."""
    errs = audit.where(F.col("status").isin("skipped", "error", "issues_detected")).groupBy("table_id").agg(
        F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("errors_by_table").alias("metric"), F.col("table_id").alias("key"), "value")
    phases = batch_log.groupBy("phase").agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("batches_by_phase").alias("metric"), F.col("phase").alias("key"), "value")
    lag = checkpoints.groupBy("node_id").agg(
        F.round(F.avg(lag_seconds(F.col("last_timestamp"), as_of)), 3).alias("value")).select(
        F.lit("avg_lag_by_shard").alias("metric"), F.col("node_id").cast("string").alias("key"), "value")
    return errs.unionByName(phases).unionByName(lag)
