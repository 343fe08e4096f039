"""Structured Streaming (S1 stream mode, SNK2, S12, S13).

Every query reads a file source with an explicit schema, processes each
micro-batch with the same DataFrame operators as the batch path inside
``foreachBatch`` and keeps its offsets in a checkpoint folder below the
shared ``spark.checkpoint.dir``, so a restarted query resumes where it
stopped and a lost executor only repeats a micro-batch (the keyed write
absorbs the repeat).
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.convert import quarantine_split, type_projection
from tidemark.functions.keys import shard_of
from tidemark.operators import control
from tidemark.plans.sync import BATCH_LOG_SCHEMA, SyncStore, _as_datetime, _phase_of, quarantine_audit, stamp_synced
from tidemark.session import scratch_path
from tidemark.sources import sinks
from tidemark.sources.versioned import VersionedTable


def _start(writer, available_now: bool, interval: str | None):
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval or "30 seconds").start()


def stream_sync(spark: SparkSession, source_dir: str, schema: T.StructType, ts_col: str, store: SyncStore,
                target: str, table_id: str, as_of, checkpoint: str, max_files_per_trigger: int = 1,
                available_now: bool = True, interval: str | None = None, fmt: str = "parquet",
                target_schema: T.StructType | None = None, n_shards: int = 1, shard_method: str = "fingerprint"):
    """S1 in stream mode: each micro-batch is converted (with a target
    schema), quarantined, keyed, stamped and written idempotently; quarantined
    rows go to the audit table, and every batch writes its batch log rows and
    checkpoints (one per shard that had rows), last, as the batch mode does.
    A row that arrives late is in some micro-batch like any other: it is written."""
    src = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", max_files_per_trigger) \
        .load(source_dir)
    as_of_ts = _as_datetime(spark, as_of)

    def per_batch(batch: DataFrame, epoch: int) -> None:
        t0 = time.time()
        seq = epoch + 1
        if target_schema is not None:
            batch = type_projection(batch, target_schema)
        node = shard_of(F.col(ts_col), n_shards, shard_method) if n_shards > 1 else F.lit(0)
        batch = batch.withColumn("node_id", F.coalesce(node, F.lit(0)).cast("int"))
        # the micro-batch is read from the source once: staged per epoch (a replay overwrites it)
        stage = store.staging(table_id, 0, epoch) + "-stream"
        quarantine_split(batch, ts_col, "_conversion_error").write.mode("overwrite").parquet(stage)
        tagged = spark.read.parquet(stage)
        ok = F.when(F.col("reason").isNull(), F.col(ts_col))
        stats = tagged.groupBy("node_id").agg(
            F.count(F.lit(1)).alias("pulled"), F.count("reason").alias("rejected"), F.min(ok).alias("lo"),
            F.max(ok).alias("hi")).collect()  # one row per shard
        valid = tagged.where(F.col("reason").isNull()).drop("reason", "_conversion_error")
        stamped = stamp_synced(valid, ts_col, as_of, exclude=["node_id"], keep_hash=True)
        written = sinks.keyed_write(store.evolve(spark, stamped, target, ts_col, ["node_id"]), store.target(target), ts_col, count_by="node_id",
                                    count_values=[r["node_id"] for r in stats]) if stats else {}
        if any(r["rejected"] for r in stats):
            quarantine_audit(tagged.where(F.col("reason").isNotNull()).drop("node_id"), table_id, 0, as_of, cycle=f"e{epoch}") \
                .write.mode("overwrite").parquet(store.folder(store.audit, table_id, f"e{epoch}"))
        if stats:
            # an epoch that runs again must not count its own rows twice: totals come from earlier epochs
            checkpoints = store.checkpoint_log(spark, table_id)
            earlier = {r["node_id"]: r for r in checkpoints.read("main", before=seq).where(
                F.col("n_shards") == n_shards).collect()}
            cp_rows, log_rows = [], []
            for r in stats:
                n, prev = r["node_id"], earlier.get(r["node_id"])
                last = max([t for t in (r["hi"], prev and prev["last_timestamp"]) if t], default=None)
                phase = _phase_of(last, as_of_ts)
                ingested = r["pulled"] - r["rejected"]
                cp_rows.append((f"{table_id}_{n}", table_id, n, last, (prev["records_ingested"] if prev else 0) + ingested,
                                (prev["records_pulled"] if prev else 0) + r["pulled"], as_of_ts, phase,
                                control.BATCH_SIZE.get(phase, control.OTHER_BATCH_SIZE), seq, n_shards))
                log_rows.append((table_id, n, seq, r["pulled"], written[n], r["rejected"], r["lo"], r["hi"], phase,
                                 as_of_ts, time.time() - t0))
            store.batch_log(spark, table_id).append(spark.createDataFrame(log_rows, BATCH_LOG_SCHEMA).coalesce(1), seq)
            checkpoints.append(spark.createDataFrame(cp_rows, control.CHECKPOINT_SCHEMA).coalesce(1), seq)
        sinks.drop_table(spark, stage)

    q = _start(src.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint),
               available_now, interval)
    return q


def strict_stream_append(spark: SparkSession, source_dir: str, schema: T.StructType, target_path: str,
                         checkpoint: str, available_now: bool = True):
    """SNK2: NDJSON lines appended all-or-nothing per micro-batch: a row with
    an unknown key or a value of the wrong type fails the batch (and the
    query) with the number of rejected rows; nothing of it is written.

    The target is a versioned table: a micro-batch that runs again after a
    failure replaces its own rows (read it with ``sinks.read_epochs``)."""
    raw = spark.readStream.format("text").load(source_dir)

    def per_batch(batch: DataFrame, epoch: int) -> None:
        stage = scratch_path(spark, "strict")  # read the micro-batch once (check + write)
        sinks.strict_parse(spark, batch, schema).write.parquet(stage)
        sinks.strict_stream_batch(spark.read.parquet(stage), target_path, schema, epoch)
        sinks.drop_table(spark, stage)

    return _start(raw.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint),
                  available_now, None)


def rate_by_interval(df: DataFrame, ts_col: str, interval: str = "1 hour", key: str | None = None) -> DataFrame:
    """S12 (batch): rows per tumbling interval (optionally per key)."""
    keys = [F.window(F.col(ts_col), interval).alias("w")] + ([F.col(key)] if key else [])
    agg = df.where(F.col(ts_col).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("events"))
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      *([key] if key else []), "events")


RATE_SCHEMA = T.StructType([T.StructField("window_start", T.TimestampType()), T.StructField("window_end", T.TimestampType()),
                            T.StructField("events", T.LongType())])


def _rate_log(spark: SparkSession, out_path: str) -> VersionedTable:
    def fold(rows: DataFrame) -> DataFrame:
        return rows.groupBy("window_start", "window_end").agg(F.sum("events").alias("events"))

    return VersionedTable(spark, out_path, RATE_SCHEMA, fold)


def rate_by_interval_stream(spark: SparkSession, source_dir: str, schema: T.StructType, ts_col: str,
                            out_path: str, checkpoint: str, interval: str = "1 hour",
                            watermark: str = "40 days", available_now: bool = True, max_files_per_trigger: int = 1):
    """S12 (stream): rows per tumbling interval, of every row however late.

    A windowed aggregate drops what lies behind its watermark.  Here each
    micro-batch commits its own counts per window as an epoch (a replay
    replaces them), and a window's count is their sum (:func:`rate_table`):
    there is no state to bound.  The watermark, the newest time of earlier
    micro-batches less the delay, only tells late rows: they count, and a side
    output holds them (:func:`late_table`)."""
    src = spark.readStream.schema(schema).format("parquet").option("maxFilesPerTrigger", max_files_per_trigger).load(source_dir)

    def per_batch(batch: DataFrame, epoch: int) -> None:
        log_ = _rate_log(spark, out_path)
        rows = batch.where(F.col(ts_col).isNotNull())
        newest = Observation(f"newest_{uuid.uuid4().hex[:8]}")
        seen = rows.observe(newest, F.max(F.unix_micros(ts_col)).alias("high"), F.count(F.lit(1)).alias("rows"))
        folder = log_.stage(rate_by_interval(seen, ts_col, interval), epoch)
        high = log_.notes("main", before=epoch).get("high")
        if high is not None:
            edge = F.timestamp_micros(F.lit(high)) - F.expr(f"INTERVAL {watermark}")
            VersionedTable(spark, f"{out_path}-late", schema).append(rows.where(F.col(ts_col) < edge), epoch)
        # the counts commit last: an epoch that broke off before is delivered again, to both outputs
        got = newest.get
        log_.commit(folder, epoch, notes={"high": got["high"]} if got["rows"] else {})

    return _start(src.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint), available_now, None)


def rate_table(spark: SparkSession, out_path: str) -> DataFrame:
    """Current count per window: the sum over the stream's epochs."""
    return _rate_log(spark, out_path).read()


def late_table(spark: SparkSession, out_path: str, schema: T.StructType) -> DataFrame:
    """S11 (stream): rows that were behind the watermark when they arrived."""
    return VersionedTable(spark, f"{out_path}-late", schema).read()


def progress_frame(spark: SparkSession, query) -> DataFrame:
    """S13 (stream): rows, rates and rows dropped behind the watermark, per
    micro-batch, from the query's progress."""
    rows = [(p["batchId"], p["numInputRows"], float(p.get("inputRowsPerSecond") or 0.0),
             float(p.get("processedRowsPerSecond") or 0.0),
             sum(int(s.get("numRowsDroppedByWatermark") or 0) for s in p.get("stateOperators") or []))
            for p in query.recentProgress]
    return spark.createDataFrame(rows, "batch_id long, rows long, input_rows_per_sec double, "
                                       "processed_rows_per_sec double, rows_dropped_by_watermark long")


__all__ = ["stream_sync", "strict_stream_append", "rate_by_interval", "rate_by_interval_stream", "rate_table", "late_table",
           "progress_frame"]
