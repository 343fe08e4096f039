"""S11, SNK5, S8: late rows reach the target, cycles read a bounded state, crashes between steps lose nothing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.test_lossless import AS_OF, frame
from tidemark.plans import sync as S
from tidemark.plans.specs import TableSpec
from tidemark.plans.sync import SyncStore, incremental_sync, sync_cycle
from tidemark.plans.validation import validation_run
from tidemark.session import fresh_path
from tidemark.sources import sinks
from tidemark.sources.versioned import VersionedTable
from tidemark.streaming import stream

LATE = TableSpec("t", "t", "ts", "t_copy", allowed_lateness="3 days")


def at(day, name="a", v=1.0):
    return (f"2024-01-{day:02d} 00:00:00", name, "b", v)


def test_a_late_row_is_in_the_target_after_the_next_cycle(spark):
    store, rows = SyncStore.fresh(spark, "s11"), [at(d) for d in (1, 2, 9, 10)]
    incremental_sync(spark, LATE, frame(spark, rows), store, AS_OF)
    assert incremental_sync(spark, LATE, frame(spark, rows), store, AS_OF) == []  # nothing late: nothing pulled
    late = [at(8, "late"), at(10, "late"), at(9, "late"), at(9, "late")]
    (r,) = incremental_sync(spark, LATE, frame(spark, rows + late), store, AS_OF)
    assert (r["pulled"], r["written"], r["duplicates"], r["rejected"]) == (4, 3, 1, 0)
    (r,) = incremental_sync(spark, LATE, frame(spark, rows + late + [at(11), at(7, "too late"), at(11, "x")]), store, AS_OF)
    assert (r["pulled"], r["written"]) == (2, 2)  # beyond the window: a reconcile's business
    assert store.read_target(spark, "t_copy").count() == 9
    assert store.read_checkpoints(spark).first()["last_timestamp"] == dt.datetime(2024, 1, 11)


def test_late_rows_of_hot_shards_in_batches(spark):
    spec = TableSpec("t", "t", "ts", "t_copy", n_shards=3, allowed_lateness="30 days")
    rows = [(f"2024-01-{1 + i % 28:02d} {i % 24:02d}:00:00", f"r{i % 50}", "b", float(i)) for i in range(150)]
    store = SyncStore.fresh(spark, "s11b")
    incremental_sync(spark, spec, frame(spark, rows[::2]), store, AS_OF, batch_size=20)
    out = incremental_sync(spark, spec, frame(spark, rows), store, AS_OF, batch_size=20)
    assert all(r["pulled"] == r["written"] + r["duplicates"] + r["rejected"] for r in out)
    assert store.read_target(spark, "t_copy").count() == 150


def test_windows_are_pruned_in_the_plan(spark, tmp_path):
    store = SyncStore.fresh(spark, "s11c")
    path = str(tmp_path / "src")
    frame(spark, [at(d) for d in range(1, 25)]).write.parquet(path)
    src = spark.read.parquet(path)
    incremental_sync(spark, LATE, src, store, AS_OF)
    known = store.reject_log(spark, "t").read()
    df = S.late_window(LATE, src.withColumn("node_id", F.lit(0)), {0: dt.datetime(2024, 1, 24)}, store, AS_OF, known)
    plan = df._jdf.queryExecution().executedPlan().toString()
    source_scan = next(line for line in plan.splitlines() if "FileScan" in line and "_day" not in line)
    target_scan = next(line for line in plan.splitlines() if "FileScan" in line and "_day" in line)
    assert "GreaterThan(ts,2024-01-21" in source_scan and "LessThanOrEqual(ts,2024-01-24" in source_scan
    assert "PartitionFilters: [isnotnull(_day" in target_scan and ">= 2024-01-21" in target_scan


def test_rejected_rows_in_the_window_are_reported_once(spark):
    from pyspark.sql import types as T

    raw = lambda rows: spark.createDataFrame(rows, "ts string, v string")
    target = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("v", T.DoubleType())])
    store, rows = SyncStore.fresh(spark, "s11d"), [("2024-01-09 00:00:00", "1"), ("2024-01-09 00:00:00", "no number"), ("2024-01-10 00:00:00", "2")]
    run = lambda rows: incremental_sync(spark, LATE, raw(rows), store, AS_OF, target_schema=target)
    run(rows)
    assert run(rows) == [] and store.read_audit(spark).count() == 1
    (r,) = run([*rows, ("2024-01-09 00:00:00", "no number"), ("2024-01-09 01:00:00", "bad too")])
    assert (r["pulled"], r["rejected"]) == (2, 2) and store.read_audit(spark).count() == 3
    assert run([*rows, ("2024-01-09 00:00:00", "no number"), ("2024-01-09 01:00:00", "bad too")]) == []


def test_files_read_per_cycle_stay_constant(spark, monkeypatch):
    """100 cycles of control rows through the store's own logs: folders to read never grow."""
    store = SyncStore.fresh(spark, "snap")
    log = store.checkpoint_log(spark, "t")
    monkeypatch.setattr(VersionedTable, "stage", lambda self, df, epoch, writer="main": (  # one file, not one Spark job, per cycle
        self.files.write_whole(f"{self.root}/data/f{epoch}/x", "", "a"), f"f{epoch}")[1])
    folded = []
    monkeypatch.setattr(VersionedTable, "_frame", lambda self, folders: folded.append(list(folders)) or spark.createDataFrame([], self.schema))
    opened = []
    for seq in range(1, 101):
        log.commit(log.stage(None, seq), seq)
        opened.append(len(log.folders()))
    assert max(opened) <= log.compact_every + 2 and log.last_epoch("main") == 100
    read = [f for x in folded for f in x if f.startswith("f")]
    assert len(read) == len(set(read)) and set(read) == {f"f{i}" for i in range(1, 101 - len(log.folders()) + 1)}  # each folded once


STEPS = ["target", "audit", "rejects", "batches", "checkpoints"]


@pytest.mark.parametrize("step", STEPS)
def test_a_crash_before_any_commit_loses_nothing(spark, monkeypatch, step):
    store = SyncStore.fresh(spark, "crash")
    df = frame(spark, [at(1), at(2), (None, "n", "n", 1.0), (None, "n", "n", 1.0)])
    real_append, real_write, real_audit = VersionedTable.append, sinks.keyed_write, S.quarantine_audit

    def boom(*a, **k):
        raise RuntimeError("executor and driver lost")

    if step == "target":
        monkeypatch.setattr(sinks, "keyed_write", boom)
    elif step == "audit":
        monkeypatch.setattr(S, "quarantine_audit", boom)
    else:
        monkeypatch.setattr(VersionedTable, "append", lambda self, *a, **k: boom() if f"/{step}/" in self.root else real_append(self, *a, **k))
    with pytest.raises(RuntimeError):
        sync_cycle(spark, LATE, df, store, AS_OF)
    monkeypatch.undo()
    assert (sinks.keyed_write, S.quarantine_audit) == (real_write, real_audit)
    out = incremental_sync(spark, LATE, df, store, AS_OF)
    assert sum(r["pulled"] for r in out) == 4 and sum(r["rejected"] for r in out) == 2
    assert store.read_target(spark, "t_copy").count() == 2 and store.read_audit(spark).count() == 2
    assert store.read_batches(spark).count() == 1 and store.read_checkpoints(spark).count() == 1
    assert incremental_sync(spark, LATE, df, store, AS_OF) == [] and store.read_audit(spark).count() == 2


def test_rate_stream_counts_late_rows_and_puts_them_aside(spark):
    src, out, ck = (fresh_path(spark, n) for n in ("rate", "rate-out", "rate-ck"))
    schema = frame(spark, []).schema
    frame(spark, [at(20), at(21), at(21)]).coalesce(1).write.parquet(src)
    run = lambda ck: stream.rate_by_interval_stream(spark, src, schema, "ts", out, ck, "1 day", watermark="2 days").awaitTermination()
    run(ck)
    frame(spark, [at(1), at(20), at(22), (None, "n", "n", 1.0)]).coalesce(1).write.mode("append").parquet(src)
    run(ck)
    got = {r["window_start"].day: r["events"] for r in stream.rate_table(spark, out).collect()}
    assert got == {1: 1, 20: 2, 21: 2, 22: 1}  # nothing dropped behind the watermark
    assert [r["ts"].day for r in stream.late_table(spark, out, schema).collect()] == [1]


def test_stream_checkpoints_per_shard(spark):
    src, store = fresh_path(spark, "shards"), SyncStore.fresh(spark, "shards")
    rows = [(f"2024-01-{1 + i % 28:02d} 00:{i % 60:02d}:00", f"r{i}", "b", 1.0) for i in range(60)]
    frame(spark, rows).repartition(2).write.parquet(src)
    schema = frame(spark, []).schema
    stream.stream_sync(spark, src, schema, "ts", store, "c", "t", AS_OF, fresh_path(spark, "ck"), n_shards=3).awaitTermination()
    cps = store.read_checkpoints(spark).collect()
    assert [r["node_id"] for r in sorted(cps, key=lambda r: r["node_id"])] == [0, 1, 2]
    assert sum(r["records_pulled"] for r in cps) == 60 and store.read_target(spark, "c").count() == 60


def test_a_failing_validation_run_leaves_an_audit_row(spark):
    store = SyncStore.fresh(spark, "v4")
    with pytest.raises(KeyError):
        validation_run(spark, [LATE], {}, store, AS_OF, "night")
    (row,) = store.read_audit(spark).collect()
    assert row["status"] == "error" and row["message"].startswith("KeyError")
