"""Validation statuses on tiny frames (each branch of V1-V3, A4, R1, R2)."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import control, coverage, monitor, profile, reconcile
from tidemark.plans.specs import TableSpec, specs_frame
from tidemark.session import fresh_path
from tidemark.sources import sinks

AS_OF = "2024-01-31 12:00:00"
T0 = dt.datetime(2024, 1, 31, 12, 0, 0)


def _cp(spark, rows):
    return spark.createDataFrame(rows, control.CHECKPOINT_SCHEMA)


def _row(node, last_ts, last_sync):
    return (f"t_{node}", "t", node, last_ts, 10, 10, last_sync, "steady", 500, 1, 5)


def test_progress_statuses(spark):
    specs = specs_frame(spark, [TableSpec("t", "t", "ts", "t_copy", n_shards=5)])
    cps = _cp(spark, [
        _row(0, T0 - dt.timedelta(seconds=10), T0 - dt.timedelta(minutes=11)),     # stalled
        _row(1, T0 - dt.timedelta(seconds=30), T0 - dt.timedelta(seconds=30)),     # healthy
        _row(2, T0 - dt.timedelta(seconds=400), T0),                               # lagging
        _row(3, T0 - dt.timedelta(hours=2), T0),                                   # severely lagging
    ])
    got = {r["node_id"]: r for r in monitor.progress_check(specs, cps, AS_OF).collect()}
    assert got[0]["status"] == "stalled"
    assert got[1]["status"] == "healthy" and got[1]["lag_seconds"] < 60
    assert got[2]["status"] == "lagging"
    assert got[3]["status"] == "severely_lagging"
    assert got[4]["status"] == "no_checkpoint"


def test_freshness(spark):
    t = spark.createDataFrame([(T0 - dt.timedelta(minutes=2),)], "ts timestamp")
    old = spark.createDataFrame([(T0 - dt.timedelta(hours=2),)], "ts timestamp")
    assert monitor.freshness_check("a", t, "ts", AS_OF).first()["status"] == "healthy"
    assert monitor.freshness_check("b", old, "ts", AS_OF).first()["status"] == "no_recent_data"
    assert monitor.freshness_missing(spark, "c").first()["status"] == "table_not_found"


def test_phantom_spot_check(spark):
    src = spark.createDataFrame([], "id long, ts timestamp")
    tgt = spark.createDataFrame([(1, T0), (2, T0 - dt.timedelta(seconds=1))], "id long, ts timestamp")
    ph = reconcile.phantom_records(tgt, src, "ts", sample=5)
    mi = reconcile.missing_records(src, tgt, "ts", sample=5)
    r = monitor.spot_check("t", ph, mi, reconcile.newest_sample(tgt, "ts", 5), src).first()
    assert r["status"] == "issues_found" and r["phantom_records"] == 2 and r["samples_checked"] == 2
    empty = monitor.spot_check("t", ph.limit(0), mi, tgt.limit(0), src).first()
    assert empty["status"] == "no_data"
    ok = monitor.spot_check("t", ph.limit(0), mi, tgt, src).first()
    assert ok["status"] == "healthy"


def test_health_rollup(spark):
    checks = spark.createDataFrame([("a", "progress", "healthy"), ("a", "smoke", "ok"),
                                    ("b", "progress", "lagging")], "table_id string, check string, status string")
    got = {r["table_id"]: r["overall_status"] for r in monitor.health_rollup(checks).collect()}
    assert got == {"a": "healthy", "b": "issues_detected", None: "issues_detected"}


def test_data_range_and_backfill(spark):
    empty = spark.createDataFrame([], "ts timestamp")
    r = profile.data_range(empty, "ts").first()
    assert (r["has_data"], r["total_records"], r["days_covered"], r["oldest"]) == (False, 0, 0, None)
    part = spark.createDataFrame([(T0 - dt.timedelta(days=3, hours=12),), (T0,)], "ts timestamp")
    r = profile.data_range(part, "ts").first()
    assert r["has_data"] and r["days_covered"] == 3
    plan = coverage.backfill_plan(profile.data_range(part, "ts"), 30, AS_OF).first()
    assert plan["action"] == "backfill" and plan["days"] == 27
    assert plan["backfill_to"] == T0 - dt.timedelta(days=3, hours=12)
    full = coverage.backfill_plan(profile.data_range(part, "ts"), 4, AS_OF).first()
    assert full["action"] == "none"
    none = coverage.backfill_plan(profile.data_range(empty, "ts"), 30, AS_OF).first()
    assert none["action"] == "backfill" and none["days"] == 30 and none["backfill_to"] == T0


def test_retention_keeps_cutoff_row(spark):
    cut = T0 - dt.timedelta(days=2)
    df = spark.createDataFrame([(1, cut), (2, cut - dt.timedelta(microseconds=1)), (3, T0),
                                (4, cut - dt.timedelta(days=3))], "k long, ts timestamp")
    path = fresh_path(spark, "t-retention")
    sinks.create_partitioned_table(df, path, "ts")
    r = coverage.retention_delete(spark, path, "ts", AS_OF, 2)
    assert r["deleted"] == 2
    assert sorted(x["k"] for x in spark.read.parquet(path).collect()) == [1, 3]


def test_coverage_gaps(spark):
    df = spark.createDataFrame([(T0,), (T0 + dt.timedelta(days=2),)], "ts timestamp")
    gaps = [r["day"] for r in coverage.coverage_gaps(df, "ts", "2024-01-31", "2024-02-02").collect()]
    assert gaps == [dt.date(2024, 2, 1)]


def test_count_drift_thresholds(spark):
    src = spark.range(1200).select((F.lit(T0) - F.make_dt_interval(secs=F.col("id"))).alias("ts"))
    tgt = src.limit(50)
    r = reconcile.count_drift(src, tgt, "ts").first()
    assert r["delta"] == 1150 and r["status"] == "alert"
    r = reconcile.count_drift(src, src.limit(1000), "ts").first()
    assert r["status"] == "drift"
    r = reconcile.count_drift(src, src.limit(1199), "ts").first()
    assert r["status"] == "ok"


def test_validation_run_plan(spark):
    from tests.conftest import SF_SMALL
    from tidemark.plans import sync as S
    from tidemark.plans import validation as V
    from tidemark.sources import views
    from tidemark.sources.tables import read_table

    ev = read_table(spark, SF_SMALL, "events")
    feed = views.defective_feed(ev)
    store = S.SyncStore.fresh(spark, "t-validate")
    spec = TableSpec("events", "events", "ts", "copy", n_shards=2)
    S.incremental_sync(spark, spec, feed, store, "2024-01-31 00:00:00")
    missing = TableSpec("other", "events", "ts", "never_synced")
    checks, rollup = V.validation_run(spark, [spec, missing], {"events": ev, "other": ev}, store,
                                      "2024-01-31 00:00:00", "t1", sample=50)
    got = {(r["table_id"], r["check"]): r["status"] for r in checks.collect()}
    assert got[("other", "progress")] == "no_checkpoint"
    assert got[("other", "smoke_test")] == "table_not_found"
    assert got[("events", "spot_check")] in ("healthy", "issues_found")
    overall = {r["table_id"]: r["overall_status"] for r in rollup.collect()}
    assert overall[None] == "issues_detected"
    audit = store.read_audit(spark).where(F.col("id") == "validation-t1").collect()
    assert len(audit) == 1 and audit[0]["status"] == "issues_detected" and "spot_check" in audit[0]["check_results"]


def test_retention_on_month_partitions_keeps_boundary_month(spark):
    cut = T0 - dt.timedelta(days=10)  # 2024-01-21 12:00
    df = spark.createDataFrame([(1, cut), (2, cut - dt.timedelta(seconds=1)), (3, T0),
                                (4, dt.datetime(2023, 12, 30))], "k long, ts timestamp")
    path = fresh_path(spark, "t-retention-month")
    sinks.with_day(df, "ts", grain="month").write.partitionBy(sinks.DAY_COL).parquet(path)
    r = coverage.retention_delete(spark, path, "ts", AS_OF, 10, grain="month")
    assert r["deleted"] == 2
    assert sorted(x["k"] for x in spark.read.parquet(path).collect()) == [1, 3]
