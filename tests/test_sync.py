"""Sync invariants: tie-safe batches, idempotent replay, isolation, stream = batch."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF_SMALL
from tidemark.operators.batches import next_batch
from tidemark.plans import sync as S
from tidemark.plans.specs import SpecError, TableSpec, validate_specs
from tidemark.session import fresh_path
from tidemark.sources import sinks, views
from tidemark.sources.tables import read_table
from tidemark.streaming import stream

AS_OF = "2024-01-31 00:00:00"


def test_next_batch_union_equals_source_with_ties(spark):
    li = read_table(spark, SF_SMALL, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    total = li.count()
    cursor, seen, sizes = None, 0, []
    while True:
        b = next_batch(li, "l_shipdate", 500, cursor=cursor)
        agg = b.agg(F.count(F.lit(1)).alias("n"), F.max("l_shipdate").alias("hi")).first()
        if agg["n"] == 0:
            break
        seen += agg["n"]
        sizes.append(agg["n"])
        cursor = agg["hi"]
    assert seen == total
    assert max(sizes) > 500  # a tie group at a cut stayed whole


def test_literal_limit_loses_tied_rows(spark):
    li = read_table(spark, SF_SMALL, "lineitem").select("l_shipdate")
    total, cursor, seen = li.count(), None, 0
    while True:
        q = li if cursor is None else li.where(F.col("l_shipdate") > F.lit(cursor))
        rows = q.orderBy("l_shipdate").limit(500).collect()
        if not rows:
            break
        seen += len(rows)
        cursor = rows[-1][0]
    assert seen < total  # the defect the tie-safe cut avoids


def test_batched_sync_is_exactly_once_and_replay_is_idempotent(spark):
    ev = read_table(spark, SF_SMALL, "events")
    feed = views.defective_feed(ev)
    store = S.SyncStore.fresh(spark, "t-sync")
    spec = TableSpec("events", "events", "ts", "copy", n_shards=2)
    res = S.incremental_sync(spark, spec, feed, store, AS_OF, batch_size=150)
    valid = feed.where(F.col("ts").isNotNull()).count()
    assert sum(r["written"] for r in res) == valid
    target = store.read_target(spark, "copy")
    assert target.count() == valid and target.select("id").distinct().count() == valid
    assert S.incremental_sync(spark, spec, feed, store, AS_OF, batch_size=150) == []
    replay = S.SyncStore.fresh(spark, "t-replay", target_root=f"{store.root}/target")
    res2 = S.incremental_sync(spark, spec, feed, replay, AS_OF)
    assert sum(r["written"] for r in res2) == 0
    assert replay.read_target(spark, "copy").count() == valid
    skipped = store.read_audit(spark).where(F.col("status") == "skipped").count()
    assert skipped == feed.where(F.col("ts").isNull()).count()
    cps = store.read_checkpoints(spark).collect()
    assert sorted(r["node_id"] for r in cps) == [0, 1]
    assert sum(r["records_pulled"] for r in cps) == feed.count()


def test_spec_validation():
    a = TableSpec("a", "s", "ts", "t1")
    with pytest.raises(SpecError):
        validate_specs([a, TableSpec("a", "s", "ts", "t2")])
    with pytest.raises(SpecError):
        validate_specs([a, TableSpec("b", "s", "ts", "t1")])
    with pytest.raises(Exception):
        validate_specs([TableSpec("c", "s", "ts", "t3", columns=["x"])])


def test_multi_table_failure_is_isolated(spark):
    ev = read_table(spark, SF_SMALL, "events")
    store = S.SyncStore.fresh(spark, "t-multi")
    specs = [TableSpec("events", "events", "ts", "events_copy"),
             TableSpec("broken", "events", "no_such_column", "broken_copy")]
    out = {r["table_id"]: r for r in S.multi_table_sync(spark, specs, {"events": ev, "broken": ev},
                                                        store, AS_OF).collect()}
    assert out["events"]["status"] == "ok" and out["events"]["written"] == ev.count()
    assert out["broken"]["status"] == "error"
    assert store.read_audit(spark).where(F.col("status") == "error").count() == 1


def test_stream_sync_equals_batch_sync(spark):
    ev = read_table(spark, SF_SMALL, "events")
    feed = views.defective_feed(ev)
    src = fresh_path(spark, "t-stream-src")
    feed.repartition(3, "event_id").write.parquet(src)
    store = S.SyncStore.fresh(spark, "t-stream")
    q = stream.stream_sync(spark, src, spark.read.parquet(src).schema, "ts", store, "copy", "events", AS_OF,
                           fresh_path(spark, "t-stream-ckpt"))
    q.awaitTermination()
    streamed = store.read_target(spark, "copy")
    bstore = S.SyncStore.fresh(spark, "t-batch")
    S.incremental_sync(spark, TableSpec("events", "events", "ts", "copy"), feed, bstore, AS_OF)
    batched = bstore.read_target(spark, "copy")
    assert streamed.exceptAll(batched).count() == 0 and batched.exceptAll(streamed).count() == 0


def test_strict_append_rejects_unknown_keys_and_bad_types(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    good = spark.createDataFrame([('{"a": 1, "b": "x"}',), ('{"a": 2, "b": null}',)], "value string")
    out = fresh_path(spark, "t-strict")
    sinks.strict_stream_batch(sinks.strict_parse(spark, good, schema), out, schema)
    assert spark.read.parquet(out).count() == 2
    for bad in ('{"a": 1, "b": "x", "c": 3}', '{"a": "not a number", "b": "x"}'):
        df = spark.createDataFrame([('{"a": 3, "b": "y"}',), (bad,)], "value string")
        with pytest.raises(sinks.LoadError, match="1 rows rejected"):
            sinks.strict_stream_batch(sinks.strict_parse(spark, df, schema), out, schema)
    assert spark.read.parquet(out).count() == 2


def test_append_load_empty_input(spark):
    empty = spark.createDataFrame([], "a long")
    with pytest.raises(sinks.LoadError):
        sinks.append_load(empty, fresh_path(spark, "t-empty"), require_rows=True)
    sinks.append_load(empty, fresh_path(spark, "t-empty2"))


def test_drop_table_is_idempotent(spark):
    path = fresh_path(spark, "t-drop")
    spark.range(3).write.parquet(path)
    assert sinks.drop_table(spark, path)
    assert sinks.drop_table(spark, path)
    assert sinks.read_or_empty(spark, path, T.StructType([T.StructField("id", T.LongType())])).count() == 0


def test_stream_resumes_from_checkpoint(spark):
    ev = read_table(spark, SF_SMALL, "events")
    src = fresh_path(spark, "t-resume-src")
    ev.repartition(2, "event_id").write.parquet(src)
    schema = spark.read.parquet(src).schema
    store = S.SyncStore.fresh(spark, "t-resume")
    ckpt = fresh_path(spark, "t-resume-ckpt")
    q1 = stream.stream_sync(spark, src, schema, "ts", store, "copy", "events", AS_OF, ckpt)
    q1.awaitTermination()
    first = [p["numInputRows"] for p in q1.recentProgress]
    assert sum(first) == ev.count()
    q2 = stream.stream_sync(spark, src, schema, "ts", store, "copy", "events", AS_OF, ckpt)
    q2.awaitTermination()
    assert sum(p["numInputRows"] for p in q2.recentProgress) == 0
    assert store.read_target(spark, "copy").count() == ev.count()
    prog = stream.progress_frame(spark, q1)
    assert prog.agg(F.sum("rows")).first()[0] == ev.count()


def test_rate_stream_equals_batch(spark):
    ev = read_table(spark, SF_SMALL, "events")
    src = fresh_path(spark, "t-rate-src")
    ev.repartition(3, "event_id").write.parquet(src)
    out = fresh_path(spark, "t-rate-out")
    q = stream.rate_by_interval_stream(spark, src, spark.read.parquet(src).schema, "ts", out,
                                       fresh_path(spark, "t-rate-ckpt"), interval="1 day")
    q.awaitTermination()
    got = stream.rate_table(spark, out)
    want = stream.rate_by_interval(ev, "ts", "1 day")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_auto_batch_size_follows_phase(spark):
    ev = read_table(spark, SF_SMALL, "events")
    store = S.SyncStore.fresh(spark, "t-auto")
    spec = TableSpec("events", "events", "ts", "copy", n_shards=1, batch_sizes={"initial": 400})
    first = S.sync_cycle(spark, spec, ev, store, AS_OF, batch_size="auto")
    assert first[0]["pulled"] == 400  # no cursor yet: initial phase, overridden size (no ties in events)
    res = S.incremental_sync(spark, spec, ev, store, AS_OF, batch_size="auto")
    assert sum(r["pulled"] for r in res) == ev.count() - 400


def test_sync_with_type_conversion_quarantines_failures(spark):
    from tidemark.catalog import SOURCE_FIELDS, _string_events
    from tidemark.functions import convert

    ev = read_table(spark, SF_SMALL, "events")
    raw = _string_events(ev, junk_ts_mod=7)
    store = S.SyncStore.fresh(spark, "t-typed")
    spec = TableSpec("typed", "events", "ts", "copy")
    target_schema = convert.build_schema(SOURCE_FIELDS)
    S.incremental_sync(spark, spec, raw, store, AS_OF, target_schema=target_schema)
    reasons = {r["reason"]: r["count"] for r in store.read_audit(spark).groupBy("reason").count().collect()}
    junk_ts = ev.where(F.col("event_id") % 7 == 0).count()
    bad_value = ev.where((F.col("event_id") % 50 == 0) & (F.col("event_id") % 7 != 0)).count()
    assert reasons == {"missing_ts": junk_ts, "processing_error: value": bad_value}
    target = store.read_target(spark, "copy")
    assert target.count() == ev.count() - junk_ts - bad_value
    assert dict(target.dtypes)["value"] == "decimal(38,9)" and dict(target.dtypes)["ts"] == "timestamp"


def test_reshard_keeps_every_row(spark):
    li = read_table(spark, SF_SMALL, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    store = S.SyncStore.fresh(spark, "t-reshard")
    two = TableSpec("li", "lineitem", "l_shipdate", "copy", n_shards=2, partition_grain="month")
    S.incremental_sync(spark, two, li, store, AS_OF, batch_size=1500, max_cycles=1)
    partial = store.read_target(spark, "copy").count()
    assert 0 < partial < li.count()
    three = TableSpec("li", "lineitem", "l_shipdate", "copy", n_shards=3, partition_grain="month")
    S.incremental_sync(spark, three, li, store, AS_OF, batch_size=2500)
    target = store.read_target(spark, "copy")
    assert target.count() == li.count() and target.select("id").distinct().count() == li.count()


def test_shard_with_only_missing_timestamps_terminates(spark):
    ev = read_table(spark, SF_SMALL, "events").limit(30).withColumn("ts", F.lit(None).cast("timestamp"))
    store = S.SyncStore.fresh(spark, "t-nulls")
    spec = TableSpec("nulls", "events", "ts", "copy")
    res = S.incremental_sync(spark, spec, ev, store, AS_OF, batch_size=10, max_cycles=5)
    assert len(res) == 1 and res[0]["pulled"] == 30 and res[0]["rejected"] == 30
    assert store.read_audit(spark).count() == 30
