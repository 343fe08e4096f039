"""Registered queries: one per operator of the inventory, each reading the
driver's tables (or frames Spark derives from them) as a whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import fingerprint_shard, record_id
from tidemark.functions import convert, geo
from tidemark.functions.keys import shard_of, with_record_id
from tidemark.operators import batches, control, coverage, filters, fleet, layout, monitor, profile, reconcile, schema_plan, tracks
from tidemark.operators.daily_profile import DailyProfile
from tidemark.session import fresh_path, scratch_path
from tidemark.streaming import stream
from tidemark.plans import sync as sync_plan
from tidemark.plans import validation as validation_plan
from tidemark.plans.specs import TableSpec, specs_frame
from tidemark.plans.sync import SyncStore
from tidemark.sources import sinks
from tidemark.operators import events as port_events_ops
from tidemark.sources import views
from tidemark.sources.tables import read_table, scan_columns

AS_OF = "2024-01-31 00:00:00"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _events(spark, d):
    return read_table(spark, d, "events")


def _positions(spark, d):
    return views.positions(_events(spark, d))


def _target(spark, d, as_of=AS_OF):
    return views.synced_target(views.defective_feed(_events(spark, d)), "ts", as_of)


# ------------------------------------------------------- sources and filters

@query
def scan_columns_q(spark, d):
    return scan_columns(_events(spark, d), ["event_id", "ts", "user_id"], "ts")


@query
def shard_filter(spark, d):
    return filters.shard_filter(_events(spark, d), "ts", 3, 1, "micros")


@query
def cursor_filter(spark, d):
    return filters.cursor_filter(_events(spark, d), "ts", "2024-01-20 00:00:00")


@query
def fingerprint_shard_q(spark, d):
    li = read_table(spark, d, "lineitem")
    return li.groupBy(fingerprint_shard(F.col("l_shipdate"), 3).alias("shard")).agg(F.count(F.lit(1)).alias("n"))


@query
def next_batch(spark, d):
    li = read_table(spark, d, "lineitem")
    return batches.next_batch(li, "l_shipdate", 10000, cursor="1996-01-01 00:00:00", n_shards=3, shard=1,
                              columns=["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"],
                              shard_method="fingerprint")


@query
def record_id_q(spark, d):
    ev = _events(spark, d)
    return ev.select("event_id", record_id(ev, "ts").alias("id"))


@query
def filter_by_type(spark, d):
    return filters.filter_by_type(_positions(spark, d), "vessel_type", "click", "ts", 100, tiebreak=["event_id"])


@query
def bounding_box(spark, d):
    return filters.bounding_box(_positions(spark, d), "latitude", "longitude", -45, 45, -90, 90,
                                ts_col="ts", as_of=AS_OF, lookback="7 days", n=1000, tiebreak=["event_id"])


@query
def z_ordered_box(spark, d):
    """F7 over a Z-ordered copy (SNK6), across the antimeridian."""
    dims = {"ts": None, "latitude": (-90.0, 90.0), "longitude": (-180.0, 180.0)}
    t = layout.write_z_ordered(_positions(spark, d), scratch_path(spark, "z-order"), dims, ["ts", "event_id"])
    return filters.bounding_box(t, "latitude", "longitude", -30, 30, 150, -150, n=None)


@query
def recent_filter(spark, d):
    return filters.recent_filter(_events(spark, d), "ts", AS_OF, "24 hours")


@query
def status_in(spark, d):
    return filters.status_in(_positions(spark, d), "status", ["AT_ANCHOR", "MOORED"])


@query
def pk_lookup(spark, d):
    ev = _events(spark, d)
    keys = ev.where(F.col("event_type") == "purchase").select("user_id")
    return filters.pk_lookup(read_table(spark, d, "customer"), "c_custkey", keys)


@query
def dynamic_search(spark, d):
    return filters.dynamic_search(
        read_table(spark, d, "lineitem"),
        [("l_quantity", "$gt", 45), ("l_returnflag", "in", ["R", "A"])],
        ["l_extendedprice DESC", "l_orderkey", "l_linenumber"], 500)


@query
def range_scan_window(spark, d):
    return filters.range_scan_window(read_table(spark, d, "orders"), "o_orderdate", "1997-01-01", "1997-02-01")


@query
def existence_probe(spark, d):
    return filters.existence_probe(_target(spark, d), _events(spark, d), ["event_id"])


@query
def latest_n(spark, d):
    return batches.latest_n(_events(spark, d), "ts", 10, tiebreak=["event_id"])


@query
def chronological_output(spark, d):
    return batches.chronological_output(read_table(spark, d, "orders"), "o_orderdate", ["o_orderkey"])


@query
def shard_batches(spark, d):
    li = read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return batches.shard_batches(li, "l_shipdate", 3, 1000, "fingerprint")



# ------------------------------------------------------------ track analytics

def _port_events(spark, d):
    return views.port_events(_events(spark, d))


def _vessel_updates(spark, d):
    return views.vessel_updates(read_table(spark, d, "orders"), read_table(spark, d, "customer"),
                                read_table(spark, d, "nation"))


def _fleet(spark, d):
    return fleet.latest_by_key(_vessel_updates(spark, d))


@query
def nearest_port(spark, d):
    return tracks.nearest_port(_positions(spark, d)).select("event_id", "nearest_port", "port_distance_nm")


@query
def track_legs(spark, d):
    return tracks.track_legs(_positions(spark, d))


@query
def dead_reckon(spark, d):
    return tracks.dead_reckon_check(_positions(spark, d))


@query
def port_stay(spark, d):
    return tracks.port_stays(_positions(spark, d))


@query
def event_position_match(spark, d):
    return tracks.event_position_match(_port_events(spark, d), _positions(spark, d))


@query
def join_synced_tables(spark, d):
    return tracks.join_synced_tables(_positions(spark, d), _fleet(spark, d))


@query
def status_from_event(spark, d):
    return port_events_ops.with_status(_port_events(spark, d))


@query
def event_transition_check(spark, d):
    return port_events_ops.transition_check(_port_events(spark, d))


@query
def port_calls(spark, d):
    return port_events_ops.port_calls(_port_events(spark, d))


@query
def port_event_stats(spark, d):
    return port_events_ops.port_event_stats(_port_events(spark, d))


@query
def latest_by_key(spark, d):
    return _fleet(spark, d)


@query
def attribute_changes(spark, d):
    return fleet.attribute_changes(_vessel_updates(spark, d))


@query
def fleet_stats(spark, d):
    return fleet.fleet_stats(_fleet(spark, d), as_of_year=2024)


@query
def tonnage_columns(spark, d):
    return fleet.tonnage_columns(_fleet(spark, d))



# ------------------------------------------------------------ sync and control

EVENTS_SPEC = TableSpec("events", "events", "ts", "events_copy", n_shards=3)
CHECKPOINT_TABLES = (("events", "events", "ts", 3), ("orders", "orders", "o_orderdate", 2),
                     ("lineitem", "lineitem", "l_shipdate", 4))
_SYNC_RUNS: dict = {}


def _feed(spark, d):
    return views.defective_feed(_events(spark, d))


def _synced(spark, d) -> SyncStore:
    """One catch-up sync of the defective feed per application and input
    folder; the queries below read its target and control tables."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _SYNC_RUNS:
        store = SyncStore.fresh(spark, "catalog-sync")
        sync_plan.incremental_sync(spark, EVENTS_SPEC, _feed(spark, d), store, AS_OF, batch_size=None)
        _SYNC_RUNS[key] = store
    return _SYNC_RUNS[key]


def _checkpoints(spark, d, as_of=AS_OF, seq=1):
    """Checkpoints after every row of three tables was synced, per shard."""
    out = None
    for table_id, name, ts_col, n in CHECKPOINT_TABLES:
        t = read_table(spark, d, name).where(F.col(ts_col).isNotNull())
        t = t.withColumn("shard", shard_of(F.col(ts_col), n))
        cp = control.advance_checkpoint(t, table_id, ts_col, as_of, seq, node_col="shard", n_shards=n)
        out = cp if out is None else out.unionByName(cp)
    return out


def _specs(spark):
    return specs_frame(spark, [TableSpec(t, n, c, f"{t}_copy", n_shards=k) for t, n, c, k in CHECKPOINT_TABLES]
                       + [TableSpec("pending", "pending", "ts", "pending_copy", n_shards=1)])


@query
def incremental_sync(spark, d):
    return _synced(spark, d).read_target(spark, EVENTS_SPEC.target)


@query
def dedupe_replay(spark, d):
    """Replay the whole feed into the synced target with fresh control tables
    (lost checkpoints): every row is pulled and keyed again, none is written twice."""
    first = _synced(spark, d)
    replay = SyncStore.fresh(spark, "replay", target_root=f"{first.root}/target")
    res = sync_plan.incremental_sync(spark, EVENTS_SPEC, _feed(spark, d), replay, AS_OF)
    assert sum(r["written"] for r in res) == 0, "replay wrote rows twice"
    return replay.read_target(spark, EVENTS_SPEC.target)


@query
def keyed_write(spark, d):
    store = SyncStore.fresh(spark, "keyed")
    keyed = sync_plan.stamp_synced(_feed(spark, d).where(F.col("ts").isNotNull()), "ts", AS_OF)
    sinks.keyed_write(keyed, store.target("t"), "ts")
    sinks.keyed_write(keyed.unionByName(keyed), store.target("t"), "ts")
    return store.read_target(spark, "t")


@query
def stamp_synced(spark, d):
    return sync_plan.stamp_synced(_events(spark, d), "ts", AS_OF)


@query
def quarantine_split(spark, d):
    return convert.quarantine_split(_feed(spark, d), "ts").select("event_id", "reason")


@query
def quarantine_log(spark, d):
    audit = _synced(spark, d).read_audit(spark)
    return audit.where(F.col("status") == "skipped").select(
        "table_id", "node_id", "status", "reason",
        F.get_json_object("record_sample", "$.event_id").cast("bigint").alias("event_id"))


@query
def skip_summary(spark, d):
    return control.skip_summary(_synced(spark, d).read_audit(spark))


@query
def ingest_totals(spark, d):
    return control.ingest_totals(_synced(spark, d).read_batches(spark))


@query
def sync_throughput(spark, d):
    """Every shard row of a batch carries the batch's duration, so it is taken once per batch."""
    b = _synced(spark, d).read_batches(spark).groupBy("table_id", "batch_id").agg(
        F.sum("rows_pulled").alias("rows_pulled"), F.max("seconds").alias("seconds"))
    return b.groupBy("table_id").agg(
        F.sum("rows_pulled").alias("rows"), F.sum("seconds").alias("seconds"),
        (F.sum("rows_pulled") / F.sum("seconds")).alias("rows_per_sec"),
        F.avg("rows_pulled").alias("rows_per_batch"))


@query
def sync_batches(spark, d):
    """S13 without the clock: rows and batches per table."""
    b = _synced(spark, d).read_batches(spark)
    return b.groupBy("table_id").agg(
        F.sum("rows_pulled").alias("rows_pulled"), F.sum(F.col("rows_pulled") - F.col("rows_quarantined")).alias("rows_valid"),
        F.countDistinct("batch_id").alias("batches"))


@query
def advance_checkpoint(spark, d):
    return _checkpoints(spark, d)


@query
def upsert_checkpoint(spark, d):
    ev = _events(spark, d)
    ev = ev.withColumn("shard", shard_of(F.col("ts"), 3))
    old = control.advance_checkpoint(ev.where(F.col("ts") < "2024-01-15"), "events", "ts",
                                     "2024-01-15 00:00:00", 1, node_col="shard", n_shards=3)
    new = control.advance_checkpoint(ev.where(F.col("ts") >= "2024-01-15"), "events", "ts", AS_OF, 2,
                                     node_col="shard", previous=old, n_shards=3)
    other = _checkpoints(spark, d).where(F.col("table_id") != "events")
    return control.upsert_checkpoint(old.unionByName(other), new)


@query
def load_checkpoint(spark, d):
    """Re-shard: lineitem's checkpoints were written for 4 shards, 6 are asked for."""
    return control.load_checkpoint(_checkpoints(spark, d), "lineitem", 6, spark)


@query
def load_checkpoint_same_layout(spark, d):
    """Same layout with one shard's checkpoint missing: it starts at the default start."""
    cps = _checkpoints(spark, d).where(F.col("checkpoint_id") != "events_1")
    return control.load_checkpoint(cps, "events", 3, spark)


@query
def lag_view(spark, d):
    return control.lag_view(_checkpoints(spark, d), AS_OF)


@query
def sync_phase(spark, d):
    lag = control.lag_seconds(F.col("last_timestamp"), AS_OF)
    return _checkpoints(spark, d).select("checkpoint_id", F.round(lag, 3).alias("lag_seconds"),
                                         control.sync_phase(lag).alias("phase"))


@query
def batch_size(spark, d):
    lag = control.lag_seconds(F.col("last_timestamp"), AS_OF)
    ph = control.sync_phase(lag)
    size = F.when(F.col("table_id") == "orders", control.batch_size_for(ph, {"initial": 5000})) \
        .otherwise(control.batch_size_for(ph))
    return _checkpoints(spark, d).select("checkpoint_id", ph.alias("phase"), size.alias("batch_size"))


@query
def poll_interval(spark, d):
    ph = control.sync_phase(control.lag_seconds(F.col("last_timestamp"), AS_OF))
    return _checkpoints(spark, d).select("checkpoint_id", ph.alias("phase"),
                                         control.poll_interval_for(ph).alias("poll_interval_s"))


@query
def checkpoint_listing(spark, d):
    return batches.checkpoint_listing(_checkpoints(spark, d))


@query
def status_view(spark, d):
    return control.status_view(_specs(spark), _checkpoints(spark, d), AS_OF)


@query
def progress_check(spark, d):
    cps = _checkpoints(spark, d)
    # shard 1 of lineitem last synced 11 minutes before as_of: stalled
    cps = cps.withColumn("last_sync_time", F.when(F.col("checkpoint_id") == "lineitem_1",
                                                  F.lit("2024-01-30 23:49:00").cast("timestamp"))
                         .otherwise(F.col("last_sync_time")))
    return monitor.progress_check(_specs(spark), cps, AS_OF)


@query
def freshness_check(spark, d):
    as_of = "2024-01-30 23:59:00"
    parts = [monitor.freshness_check(t, read_table(spark, d, n), c, as_of) for t, n, c, _ in CHECKPOINT_TABLES]
    parts.append(monitor.freshness_missing(spark, "pending"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query
def phantom_records(spark, d):
    return reconcile.phantom_records(_target(spark, d), with_record_id(_events(spark, d), "ts"), "ts")


@query
def missing_records(spark, d):
    return reconcile.missing_records(with_record_id(_events(spark, d), "ts"), _target(spark, d), "ts")


@query
def full_reconcile(spark, d):
    return reconcile.full_reconcile(with_record_id(_events(spark, d), "ts"), _target(spark, d), "ts")


@query
def bucketed_reconcile(spark, d):
    """J3 over two copies bucketed by id."""
    copies, buckets = {}, int(spark.conf.get("spark.sql.shuffle.partitions"))
    for side, df in (("source", with_record_id(_events(spark, d), "ts")), ("target", _target(spark, d))):
        path = scratch_path(spark, f"bucketed_{side}")
        copies[side] = layout.bucketed_copy(df.select("id", "ts"), path.rsplit("/", 1)[1].replace("-", "_"), path, "id", buckets)
    return layout.reconcile_bucketed(copies["source"], copies["target"], "ts")


@query
def spot_check(spark, d):
    src = with_record_id(_events(spark, d), "ts")
    tgt = _target(spark, d)
    t_sample = reconcile.newest_sample(tgt.select("id", "ts"), "ts", 5)
    ph = reconcile.phantom_records(tgt, src, "ts", sample=5)
    s_sample = src.where(F.col("ts") >= F.lit(AS_OF).cast("timestamp") - F.expr("INTERVAL 36 HOURS")) \
        .orderBy("ts", "id").limit(50)
    mi = reconcile.missing_records(src, tgt, "ts", sample=50, as_of=AS_OF, lookback="36 hours")
    return monitor.spot_check("events", ph, mi, t_sample, s_sample)


@query
def sampled_differences(spark, d):
    """V3, hash-random: both sides' records up to one hash, wherever in time they lie."""
    return reconcile.sampled_differences(with_record_id(_events(spark, d), "ts"), _target(spark, d), "ts", 2000)


@query
def count_drift(spark, d):
    return reconcile.count_drift(_events(spark, d), _target(spark, d), "ts", 3, ok_below=30, alert_above=40)


@query
def late_rows(spark, d):
    target = _target(spark, d)
    return reconcile.late_rows(with_record_id(_events(spark, d), "ts"), target, "ts", "2024-01-20 00:00:00",
                               "2 days").select("id", "event_id", "ts")


def _checks(spark, d):
    prog = progress_check(spark, d).where(F.col("table_id") != "pending").groupBy("table_id").agg(
        F.lit("progress").alias("check"),
        F.when(F.bool_and(F.col("status") == "healthy"), "healthy").otherwise("lagging").alias("status"))
    fresh = freshness_check(spark, d).select("table_id", "check", "status")
    spot = spot_check(spark, d).select("table_id", "check", "status")
    return prog.unionByName(fresh).unionByName(spot)


@query
def health_rollup(spark, d):
    return monitor.health_rollup(_checks(spark, d))


@query
def validation_run(spark, d):
    """V4 plan over the synced copy of the defective feed: checks, rollup and
    the audit row (returned; the store keeps its own copy)."""
    store = _synced(spark, d)
    checks, _ = validation_plan.validation_run(spark, [EVENTS_SPEC], {"events": _feed(spark, d)}, store, AS_OF,
                                               "catalog", sample=5, write_audit=False)
    return monitor.validation_audit_row(checks, AS_OF, "catalog")


@query
def validation_checks(spark, d):
    """The checks of the V4 plan (progress, freshness, spot check) for the synced feed."""
    store = _synced(spark, d)
    checks, _ = validation_plan.validation_run(spark, [EVENTS_SPEC], {"events": _feed(spark, d)}, store, AS_OF,
                                               "catalog-checks", sample=5, write_audit=False)
    return checks


@query
def alerts(spark, d):
    cps = _checkpoints(spark, d)
    prog = monitor.progress_check(_specs(spark), cps, AS_OF)
    drift = reconcile.count_drift(_events(spark, d), _target(spark, d), "ts", 3)
    return monitor.alerts(prog, drift, cps, "2024-01-31 00:10:00")


@query
def shard_balance(spark, d):
    ev = _events(spark, d).withColumn("shard", shard_of(F.col("ts"), 3, "micros"))
    return monitor.shard_balance(ev, "shard", 3)


@query
def monitoring_aggregates(spark, d):
    store = _synced(spark, d)
    return monitor.monitoring_aggregates(store.read_audit(spark), store.read_batches(spark),
                                         store.read_checkpoints(spark), AS_OF)


@query
def multi_table_sync(spark, d):
    store = SyncStore.fresh(spark, "multi")
    specs = [TableSpec("events", "events", "ts", "events_copy", n_shards=2),
             TableSpec("orders", "orders", "o_orderdate", "orders_copy", n_shards=1, partition_grain="month"),
             TableSpec("lineitem", "lineitem", "l_shipdate", "lineitem_copy", n_shards=2,
                       columns=["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"], partition_grain="month")]
    sources = {s.table_id: read_table(spark, d, s.source) for s in specs}
    return sync_plan.multi_table_sync(spark, specs, sources, store, AS_OF)


@query
def audit_recent(spark, d):
    audit = _synced(spark, d).read_audit(spark)
    return batches.audit_recent(audit, "2024-01-31 06:00:00", 24).select("table_id", "status", "reason", "timestamp")



# ------------------------------------------------------------ profiles

@query
def count_partition(spark, d):
    return profile.count_partition(_events(spark, d), "ts", 4, method="micros")


@query
def table_profile(spark, d):
    return profile.table_profile(_positions(spark, d), exact=True)


@query
def table_profile_approx(spark, d):
    return profile.table_profile(_positions(spark, d), exact=False)


@query
def daily_profile(spark, d):
    """A2, incrementally: two batches, one of them retried, then retention;
    exact columns, and whether each estimate is within 5 % of the exact count."""
    pos, daily = _positions(spark, d), DailyProfile(spark, scratch_path(spark, "daily-profile"))
    halves = F.pmod(F.col("event_id"), F.lit(2))
    for epoch, half in ((1, 0), (2, 1), (2, 1)):
        daily.add(pos.where(halves == half), epoch)
    kept = coverage.retained(pos, "ts", AS_OF, 10)
    daily.retain(kept, AS_OF, 10, 3)
    exact = profile.table_profile(kept, exact=True).select(*[F.col(c).alias(f"x_{c}") for c in daily.distinct])
    within = [(F.abs(F.col(c) - F.col(f"x_{c}")) <= F.greatest(F.lit(1.0), F.col(f"x_{c}") * 0.05)).alias(f"{c}_close")
              for c in daily.distinct]
    one = F.lit(1)  # a row on either side
    return daily.profile().withColumn("k", one).join(exact.withColumn("k", one), "k").select(
        "total_records", "oldest_record", "newest_record", *within)


@query
def table_size(spark, d):
    parts = [profile.table_size(read_table(spark, d, n), n) for n in ("events", "orders", "lineitem")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def data_range(spark, d):
    return profile.data_range(_events(spark, d), "ts")


@query
def verify_tables(spark, d):
    tables = {"events": (lambda: read_table(spark, d, "events"), "ts"),
              "orders": (lambda: read_table(spark, d, "orders"), "o_orderdate"),
              "lineitem": (lambda: read_table(spark, d, "lineitem"), "l_shipdate"),
              "vessel_metadata": (lambda: read_table(spark, d, "vessel_metadata"), "last_updated")}
    v = profile.verify_tables(spark, tables)
    return v.select("table_name", "oldest", "newest", "total_records", "has_data", "days_covered",
                    F.col("error").isNotNull().alias("failed"))


@query
def type_distribution(spark, d):
    return profile.type_distribution(_positions(spark, d))


@query
def active_by_type(spark, d):
    return profile.active_by_type(_positions(spark, d), AS_OF, "6 hours")


@query
def count_avg_by_type(spark, d):
    return profile.count_avg_by_type(_positions(spark, d), AS_OF, "6 hours")


@query
def port_activity_topk(spark, d):
    return profile.port_activity_topk(_positions(spark, d), AS_OF, "3 days", 10)


# ------------------------------------------------------------ sinks and conversion

def _json_dir(spark, df, files=4):
    path = fresh_path(spark, "ndjson")
    sinks.write_ndjson(df.repartition(files, "event_id"), path)
    return path


@query
def append_load(spark, d):
    ev = _events(spark, d)
    src = _json_dir(spark, ev)
    target = fresh_path(spark, "append")
    sinks.append_load(sinks.load_ndjson(spark, src, ev.schema), target, require_rows=True)
    return spark.read.parquet(target)


@query
def strict_stream_append(spark, d):
    ev = _events(spark, d)
    src = _json_dir(spark, ev)
    target = fresh_path(spark, "strict")
    # the second query has no memory of the first one's offsets: it replays every epoch into the same table
    for _ in range(2):
        q = stream.strict_stream_append(spark, src, ev.schema, target, fresh_path(spark, "strict-ckpt"))
        q.awaitTermination()
    return sinks.read_epochs(spark, target, ev.schema)


@query
def insert_method(spark, d):
    ev = _events(spark, d)
    target = fresh_path(spark, "insert")
    for _ in range(2):  # every call is retried
        sinks.insert(ev.where(F.col("event_id") % 2 == 0), target, "batch", epoch=0)
        sinks.insert(ev.where(F.col("event_id") % 2 == 1), target, "stream", epoch=1)
    return sinks.read_epochs(spark, target, ev.schema)


@query
def create_partitioned_table(spark, d):
    ev = _events(spark, d)
    target = fresh_path(spark, "partitioned")
    cluster = [c for c in schema_plan.layout_columns(ev.schema, "ts") if c != "ts"]
    sinks.create_partitioned_table(ev, target, "ts", cluster)
    t = spark.read.parquet(target)
    return filters.range_scan_window(t, "ts", "2024-01-10", "2024-01-12", day_col=sinks.DAY_COL)


@query
def truncate_keep_schema(spark, d):
    ev = _events(spark, d)
    target = fresh_path(spark, "truncate")
    ev.write.parquet(target)
    before = spark.read.parquet(target).agg(F.count(F.lit(1)).alias("rows_before"))
    before = before.first()["rows_before"]
    after = sinks.truncate_keep_schema(spark, target, ev.schema)
    return after.agg(F.lit(before).cast("bigint").alias("rows_before"), F.count(F.lit(1)).alias("rows_after"),
                     F.lit(len(after.columns)).cast("bigint").alias("columns_kept"))


@query
def drop_table(spark, d):
    """SNK8: a full copy is written, dropped twice (idempotent), and reads back
    empty: rows before and after."""
    ev = _events(spark, d)
    target = fresh_path(spark, "drop")
    ev.write.parquet(target)
    before = spark.read.parquet(target).count()
    sinks.drop_table(spark, target)
    sinks.drop_table(spark, target)
    return sinks.read_or_empty(spark, target, ev.schema).agg(
        F.lit(before).cast("bigint").alias("rows_before"), F.count(F.lit(1)).alias("rows_after"))


def _string_events(ev, junk_ts_mod=None):
    eid = F.col("event_id")
    ts_text = (F.when(eid % 3 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
               .when(eid % 3 == 1, F.unix_millis("ts").cast("string"))
               .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    if junk_ts_mod:
        ts_text = F.when(eid % junk_ts_mod == 0, F.lit("not a time")).otherwise(ts_text)
    return ev.select(eid.cast("string").alias("event_id"), ts_text.alias("ts"),
                     F.col("user_id").cast("string").alias("user_id"), "event_type",
                     F.when(eid % 50 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
                     "props")


SOURCE_FIELDS = [
    {"name": "event_id", "type": "INTEGER", "mode": "REQUIRED"},
    {"name": "ts", "type": "TIMESTAMP", "mode": "REQUIRED"},
    {"name": "user_id", "type": "INT64"},
    {"name": "event_type", "type": "STRING"},
    {"name": "value", "type": "NUMERIC"},
    {"name": "props", "type": "JSON"},
]


@query
def type_projection(spark, d):
    return convert.type_projection(_string_events(_events(spark, d)), convert.build_schema(SOURCE_FIELDS))


@query
def normalize_ts(spark, d):
    s = _string_events(_events(spark, d), junk_ts_mod=7)
    return s.select(F.col("event_id").cast("bigint").alias("event_id"),
                    convert.normalize_ts(F.col("ts")).alias("ts_norm"))


# ------------------------------------------------------------ coverage and windows

def _partitioned_events(spark, d):
    target = fresh_path(spark, "events-by-day")
    sinks.create_partitioned_table(_events(spark, d), target, "ts", ["user_id"])
    return target


def _key(df):
    return sync_plan.stamp_synced(df, "ts", AS_OF)


@query
def retention_delete(spark, d):
    path = _partitioned_events(spark, d)
    coverage.retention_delete(spark, path, "ts", AS_OF, 10)
    return spark.read.parquet(path).drop(sinks.DAY_COL)


@query
def retention_all(spark, d):
    """R1 over many tables: a day-partitioned and a month-partitioned copy."""
    by_month = fresh_path(spark, "events-by-month")
    sinks.with_day(_events(spark, d), "ts", grain="month").write.partitionBy(sinks.DAY_COL).parquet(by_month)
    return coverage.retention_all(spark, {"by_day": (_partitioned_events(spark, d), "ts"),
                                          "by_month": (by_month, "ts", "month")}, AS_OF, 10)


@query
def range_retained(spark, d):
    return coverage.retained(_events(spark, d), "ts", AS_OF, 10)


@query
def backfill_plan(spark, d):
    tables = {"events": (lambda: read_table(spark, d, "events"), "ts"),
              "orders": (lambda: read_table(spark, d, "orders"), "o_orderdate"),
              "lineitem": (lambda: read_table(spark, d, "lineitem"), "l_shipdate"),
              "vessel_metadata": (lambda: read_table(spark, d, "vessel_metadata"), "last_updated")}
    return coverage.backfill_plan(profile.verify_tables(spark, tables), 40, AS_OF)


@query
def backfill_load(spark, d):
    ev = _events(spark, d)
    target = fresh_path(spark, "backfill")
    sinks.keyed_write(_key(ev.where(F.col("ts") >= "2024-01-15")), target, "ts")
    plan = coverage.backfill_plan(profile.data_range(spark.read.parquet(target), "ts"), 30, AS_OF).first()
    coverage.backfill_load(spark, ev, target, "ts", plan["backfill_from"], plan["backfill_to"], _key)
    return spark.read.parquet(target).select("id", "event_id", "ts")


@query
def coverage_gaps(spark, d):
    return coverage.coverage_gaps(read_table(spark, d, "orders"), "o_orderdate", "1994-12-25", "2001-08-10")


@query
def rolling_window(spark, d):
    ev = _events(spark, d)
    target = fresh_path(spark, "rolling")
    sinks.keyed_write(_key(ev.where(F.col("ts") >= "2024-01-20")), target, "ts")
    coverage.rolling_window(spark, ev, target, "ts", 15, AS_OF, _key)
    return spark.read.parquet(target).select("id", "event_id", "ts")


@query
def apply_migration(spark, d):
    ev = _events(spark, d)
    existing = ev.where(F.col("ts") < "2024-01-15")
    incoming = ev.where(F.col("ts") >= "2024-01-15").select(
        "event_id", "ts", "user_id", "event_type", F.col("value").cast("string").alias("value"), "props",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    return schema_plan.apply_migration(existing, incoming)


def _three_shapes(spark, d):
    """The events as a source gives them over time: as they are, then with text
    values and a new column, then with whole-number values and no props."""
    ev = _events(spark, d)
    text = ev.withColumns({"value": F.col("value").cast("string"), "k": F.get_json_object("props", "$.k").cast("bigint")})
    whole = ev.withColumn("value", F.floor(F.col("value") * 1000).cast("bigint")).drop("props")
    return [ev.where(F.col("ts") < "2024-01-10"), text.where(F.col("ts") < "2024-01-20"), whole]


@query
def evolving_sync(spark, d):
    """SC4 and SC5 inside S1: a column is added, retyped and retyped again over three runs."""
    store, spec = SyncStore.fresh(spark, "evolving"), TableSpec("events", "events", "ts", "events_copy", n_shards=2)
    for source in _three_shapes(spark, d):
        sync_plan.incremental_sync(spark, spec, source, store, AS_OF)
    return store.read_target(spark, "events_copy").drop("id", "_synced_at")


# ------------------------------------------------------------ streaming

def _feed_dir(spark, d, files=4):
    path = fresh_path(spark, "feed")
    _feed(spark, d).repartition(files, "event_id").write.parquet(path)
    return path


@query
def stream_sync(spark, d):
    src = _feed_dir(spark, d)
    schema = spark.read.parquet(src).schema
    store = SyncStore.fresh(spark, "stream")
    q = stream.stream_sync(spark, src, schema, "ts", store, "events_copy", "events", AS_OF,
                           fresh_path(spark, "stream-ckpt"))
    q.awaitTermination()
    return store.read_target(spark, "events_copy")


@query
def rate_by_interval(spark, d):
    return stream.rate_by_interval(_events(spark, d), "ts", "1 hour")


@query
def rate_by_interval_stream(spark, d):
    src = fresh_path(spark, "rate-src")
    _events(spark, d).repartition(4, "event_id").write.parquet(src)
    out = fresh_path(spark, "rate-out")
    q = stream.rate_by_interval_stream(spark, src, spark.read.parquet(src).schema, "ts", out,
                                       fresh_path(spark, "rate-ckpt"))
    q.awaitTermination()
    return stream.rate_table(spark, out)



# ------------------------------------------------------------ geometry columns

REFERENCE_POINT = ("Singapore", 1.2644, 103.8223)


@query
def haversine_nm(spark, d):
    _, plat, plon = REFERENCE_POINT
    p = _positions(spark, d)
    return p.select("event_id", F.round(geo.haversine_nm(F.col("latitude"), F.col("longitude"), F.lit(plat),
                                                         F.lit(plon)), 6).alias("distance_nm"))


@query
def bearing_deg(spark, d):
    _, plat, plon = REFERENCE_POINT
    p = _positions(spark, d)
    return p.select("event_id", F.round(geo.bearing_deg(F.col("latitude"), F.col("longitude"), F.lit(plat),
                                                        F.lit(plon)), 6).alias("bearing_deg"))


# registered names without the helper suffix
for _k in [k for k in QUERIES if k.endswith("_q")]:
    QUERIES[_k[:-2]] = QUERIES.pop(_k)

FLAGSHIP = "next_batch"
