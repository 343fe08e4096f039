"""Checkpoint / phase / lag algebra over control tables (S3-S7, SNK5, A14, A15, V5, V6)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.lookups import map_lit
from tidemark.operators.filters import ts_lit
from tidemark.operators.sequence import latest_per_key

CHECKPOINT_SCHEMA = T.StructType([
    T.StructField("checkpoint_id", T.StringType(), False),
    T.StructField("table_id", T.StringType(), False),
    T.StructField("node_id", T.IntegerType(), False),
    T.StructField("last_timestamp", T.TimestampType(), True),
    T.StructField("records_ingested", T.LongType(), False),
    T.StructField("records_pulled", T.LongType(), False),
    T.StructField("last_sync_time", T.TimestampType(), False),
    T.StructField("phase", T.StringType(), True),
    T.StructField("batch_size", T.IntegerType(), True),
    T.StructField("seq", T.LongType(), False),
    T.StructField("n_shards", T.IntegerType(), False),
])

AUDIT_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("table_id", T.StringType(), True),
    T.StructField("node_id", T.IntegerType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("reason", T.StringType(), True),
    T.StructField("record_sample", T.StringType(), True),
    T.StructField("source_count", T.LongType(), True),
    T.StructField("target_count", T.LongType(), True),
    T.StructField("delta", T.LongType(), True),
    T.StructField("check_results", T.StringType(), True),
    T.StructField("message", T.StringType(), True),
])

# Phase thresholds (seconds), batch sizes and poll intervals (seconds).
CATCHUP_THRESHOLD_S = 3600
STEADY_THRESHOLD_S = 300
BATCH_SIZE = {"initial": 10000, "catchup": 1000, "steady": 500}
OTHER_BATCH_SIZE = 1000
POLL_INTERVAL_S = {"initial": 1, "catchup": 5, "steady": 30}
OTHER_POLL_INTERVAL_S = 10
DEFAULT_START = "1970-01-01 00:00:00"


def checkpoint_id(table_id: Column, node_id: Column) -> Column:
    return F.concat_ws("_", table_id, node_id.cast("string"))


def lag_seconds(ts: Column, as_of) -> Column:
    return (F.unix_micros(ts_lit(as_of)) - F.unix_micros(ts)) / F.lit(1e6)


def sync_phase(lag_s: Column, catchup_threshold: int = CATCHUP_THRESHOLD_S,
               steady_threshold: int = STEADY_THRESHOLD_S) -> Column:
    """Lag > catch-up threshold -> initial; > steady threshold -> catchup;
    else steady (also when there is no cursor yet)."""
    return (F.when(lag_s > catchup_threshold, F.lit("initial"))
            .when(lag_s > steady_threshold, F.lit("catchup")).otherwise(F.lit("steady")))


def batch_size_for(phase: Column, overrides: Mapping[str, int] | None = None) -> Column:
    """Batch size of a phase; per-table ``overrides`` win over the defaults."""
    sizes = dict(BATCH_SIZE, **(overrides or {}))
    return F.coalesce(map_lit(sizes)[phase], F.lit(OTHER_BATCH_SIZE)).cast("int")


def poll_interval_for(phase: Column, steady_s: int | None = None) -> Column:
    """Poll interval of a phase in seconds (steady may be configured)."""
    iv = dict(POLL_INTERVAL_S)
    if steady_s is not None:
        iv["steady"] = steady_s
    return F.coalesce(map_lit(iv)[phase], F.lit(OTHER_POLL_INTERVAL_S)).cast("int")


def advance_checkpoint(batch: DataFrame, table_id: str, ts_col: str, as_of, seq: int,
                       node_col: str | None = None, node_id: int = 0, ingested_col: str | None = None,
                       previous: DataFrame | None = None, n_shards: int = 1) -> DataFrame:
    """New checkpoint rows from one batch: cursor = newest ``ts`` of the
    batch per node, counts added to the previous totals (``pulled`` counts
    every row, ``ingested`` only valid rows), stamped with ``as_of``; phase and
    batch size follow from the new lag."""
    node = F.col(node_col).cast("int") if node_col else F.lit(node_id).cast("int")
    ingested = F.col(ingested_col).cast("int") if ingested_col else F.lit(1)
    agg = batch.groupBy(node.alias("node_id")).agg(
        F.max(ts_col).alias("last_timestamp"), F.count(F.lit(1)).alias("pulled"),
        F.sum(ingested).cast("bigint").alias("ingested"))
    agg = agg.withColumn("table_id", F.lit(table_id))
    if previous is not None:
        prev = previous.where(F.col("table_id") == table_id).select(
            "node_id", F.col("last_timestamp").alias("_p_ts"), F.col("records_ingested").alias("_p_ing"),
            F.col("records_pulled").alias("_p_pull"))
        agg = agg.join(prev, "node_id", "left")
    else:
        agg = agg.select("*", F.lit(None).cast("timestamp").alias("_p_ts"), F.lit(0).cast("bigint").alias("_p_ing"),
                         F.lit(0).cast("bigint").alias("_p_pull"))
    cursor = F.greatest(F.col("last_timestamp"), F.col("_p_ts"))
    phase = sync_phase(lag_seconds(cursor, as_of))
    return agg.select(
        checkpoint_id(F.col("table_id"), F.col("node_id")).alias("checkpoint_id"), "table_id", "node_id",
        cursor.alias("last_timestamp"),
        (F.coalesce("_p_ing", F.lit(0)) + F.col("ingested")).cast("bigint").alias("records_ingested"),
        (F.coalesce("_p_pull", F.lit(0)) + F.col("pulled")).cast("bigint").alias("records_pulled"),
        ts_lit(as_of).alias("last_sync_time"), phase.alias("phase"), batch_size_for(phase).alias("batch_size"),
        F.lit(seq).cast("bigint").alias("seq"), F.lit(n_shards).cast("int").alias("n_shards"))


def upsert_checkpoint(old: DataFrame, new: DataFrame) -> DataFrame:
    """SNK5: put by key, last write wins: the highest ``seq``, then the newest
    ``last_sync_time`` (which may go back: it is the caller's ``as_of``)."""
    both = old.select(*CHECKPOINT_SCHEMA.names).unionByName(new.select(*CHECKPOINT_SCHEMA.names))
    return latest_per_key(both, ["checkpoint_id"], "seq", ["last_sync_time"]).select(*CHECKPOINT_SCHEMA.names)


def load_checkpoint(checkpoints: DataFrame, table_id: str, n_shards: int, spark_session,
                    start=DEFAULT_START) -> DataFrame:
    """S3: the cursor of every shard of ``table_id``; a missing checkpoint starts
    at ``start`` (``restarted``: no checkpoint row at all); an unparseable or
    empty stored cursor restarts at ``start``.  With ``start=None`` such a shard
    has no cursor: nothing bounds it from below.

    Re-shard rule: checkpoints written for another shard count do not belong
    to the new shards (rows moved between shards), so a new shard without
    its own checkpoint starts at the minimum of those old cursors; the keyed
    write absorbs the rows pulled again."""
    shards = spark_session.range(n_shards).select(F.col("id").cast("int").alias("node_id"))
    cp = checkpoints.where(F.col("table_id") == table_id)
    ts_type = dict((f.name, f.dataType) for f in cp.schema.fields)["last_timestamp"]
    stored = F.col("last_timestamp")
    if isinstance(ts_type, T.StringType):
        stored = F.try_to_timestamp(stored)
    layout = F.col("n_shards") if "n_shards" in cp.columns else F.lit(n_shards)
    cp = cp.select("node_id", stored.alias("_stored"), "records_ingested", "records_pulled",
                   (layout != F.lit(n_shards)).alias("_other_layout"))
    floor = cp.where(F.col("_other_layout")).agg(F.min("_stored")).scalar()  # scalar subquery
    own = cp.where(~F.col("_other_layout")).drop("_other_layout")
    j = shards.join(own, "node_id", "left")
    cursor = F.coalesce(F.col("_stored"), floor, *([ts_lit(start)] if start is not None else []))
    return j.select(F.lit(table_id).alias("table_id"), "node_id", cursor.alias("cursor"),
                    (F.col("records_pulled").isNull() & floor.isNull()).alias("restarted"),
                    F.coalesce("records_ingested", F.lit(0)).cast("bigint").alias("records_ingested"),
                    F.coalesce("records_pulled", F.lit(0)).cast("bigint").alias("records_pulled"))


def lag_view(checkpoints: DataFrame, as_of) -> DataFrame:
    """V5 (+S5-S7 read-time): lag in seconds and the phase, batch size and poll
    interval it implies, for every checkpoint."""
    lag = lag_seconds(F.col("last_timestamp"), as_of)
    phase = sync_phase(lag)
    return checkpoints.select("checkpoint_id", "table_id", "node_id", "last_timestamp",
                              F.round(lag, 3).alias("lag_seconds"), phase.alias("phase"),
                              batch_size_for(phase).alias("batch_size"),
                              poll_interval_for(phase).alias("poll_interval_s"))


def status_view(specs: DataFrame, checkpoints: DataFrame, as_of) -> DataFrame:
    """V6: per table and shard: cluster size, phase and cursor (specs carry
    ``table_id`` and ``n_shards``)."""
    shards = specs.select("table_id", "n_shards",
                          F.explode(F.sequence(F.lit(0), F.col("n_shards") - 1)).alias("node_id"))
    lv = lag_view(checkpoints, as_of).select("table_id", "node_id", "last_timestamp", "lag_seconds", "phase")
    return shards.join(lv, ["table_id", "node_id"], "left").select(
        "table_id", "node_id", F.col("n_shards").alias("cluster_size"),
        F.coalesce("phase", F.lit("initial")).alias("phase"), F.col("last_timestamp").alias("cursor"),
        "lag_seconds")


def ingest_totals(batch_log: DataFrame) -> DataFrame:
    """Rows pulled / ingested / quarantined per table and shard."""
    return batch_log.groupBy("table_id", "node_id").agg(
        F.sum("rows_pulled").cast("bigint").alias("records_pulled"),
        F.sum("rows_written").cast("bigint").alias("records_ingested"),
        F.sum("rows_quarantined").cast("bigint").alias("records_quarantined"),
        F.count(F.lit(1)).alias("batches"))


def skip_summary(audit: DataFrame) -> DataFrame:
    """Skipped records by table and reason."""
    return audit.where(F.col("status") == "skipped").groupBy("table_id", "reason").agg(
        F.count(F.lit(1)).alias("skipped"))


def checkpoints_from_batches(batches: DataFrame, table_id: str, ts_col: str, as_of, seq: int = 1,
                             node_col: str = "shard") -> DataFrame:
    """Checkpoint rows after a set of shard batches were synced (S4 over many shards)."""
    return advance_checkpoint(batches, table_id, ts_col, as_of, seq, node_col=node_col)
