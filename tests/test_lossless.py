"""No record is lost on its way: keys, cursors, quarantine, control tables, strict append."""

import json
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.convert import normalize_ts
from tidemark.functions.keys import HASH_COL, with_record_id
from tidemark.operators import control, reconcile
from tidemark.plans.specs import TableSpec
from tidemark.plans.sync import SyncStore, incremental_sync, multi_table_sync, stamp_synced, sync_cycle
from tidemark.sources import sinks

AS_OF = "2024-02-01 00:00:00"
SPEC = TableSpec("t", "t", "ts", "t_copy")


def frame(spark, rows, schema="ts string, a string, b string, v double"):
    return spark.createDataFrame(rows, schema).withColumn("ts", F.col("ts").cast("timestamp"))


def test_distinct_records_have_distinct_keys_and_are_all_stored(spark):
    t = "2024-01-01 00:00:00"
    rows = [(t, "x|y", "z", 1.0), (t, "x", "y|z", 1.0), (t, "\\N", None, 1.0), (t, None, "\\N", 1.0), (t, "a", "b", 1e-12),
            (t, "a", "b", 2e-12), (t, "a", "b", 1e40), (t, "a", "b", math.nan), (t, "a", "b", None), (t, "", None, 1.0), (t, None, "", 1.0)]
    df = frame(spark, rows)
    assert with_record_id(df, "ts").select("id").distinct().count() == len(rows)
    store = SyncStore.fresh(spark, "lossless")
    keyed = stamp_synced(df, "ts", AS_OF)
    assert sinks.keyed_write(keyed, store.target("x"), "ts") == len(rows)
    assert sinks.keyed_write(keyed.unionByName(keyed), store.target("x"), "ts") == 0


def test_equal_ids_of_different_records_are_both_kept(spark):
    df = frame(spark, [("2024-01-01 00:00:00", "a", "b", 1.0), ("2024-01-01 00:00:00", "a", "c", 1.0)])
    clash = stamp_synced(df, "ts", AS_OF, keep_hash=True).withColumn("id", F.lit(5).cast("bigint"))
    store = SyncStore.fresh(spark, "clash")
    assert sinks.keyed_write(clash, store.target("x"), "ts") == 2
    assert sinks.keyed_write(clash, store.target("x"), "ts") == 0
    assert HASH_COL not in store.read_target(spark, "x").columns


def test_old_rows_and_late_rows_without_timestamp_are_not_lost(spark):
    rows = [("1969-05-01 00:00:00", "a", "b", 1.0), ("1970-01-01 00:00:00", "a", "b", 1.0), ("2024-01-01 00:00:00", "a", "b", 1.0)]
    rows += [(None, "x" * 600, "same", 1.0)] * 3 + [(None, "x" * 600, f"other {i}", 1.0) for i in range(4)]
    store = SyncStore.fresh(spark, "late")
    (r,) = incremental_sync(spark, SPEC, frame(spark, rows), store, AS_OF)
    assert (r["pulled"], r["written"], r["rejected"]) == (10, 3, 7)
    assert store.read_audit(spark).count() == 7  # the records' first 500 characters are equal
    more = frame(spark, rows + [(None, "late", "y", 2.0), (None, "x" * 600, "same", 1.0), ("2024-01-02 00:00:00", "n", "n", 1.0)])
    (r,) = incremental_sync(spark, SPEC, more, store, AS_OF)
    assert (r["pulled"], r["written"], r["duplicates"], r["rejected"]) == (3, 1, 0, 2)
    assert store.read_audit(spark).count() == 9
    assert incremental_sync(spark, SPEC, more, store, AS_OF) == []
    assert control.skip_summary(store.read_audit(spark)).first()["skipped"] == 9


def test_every_cycle_accounts_for_its_rows(spark):
    rows = [(f"2024-01-{1 + i % 28:02d} 00:00:00" if i % 7 else None, f"r{i % 40}", "b", 1.0) for i in range(200)]
    store = SyncStore.fresh(spark, "balance")
    out = incremental_sync(spark, TableSpec("t", "t", "ts", "c", n_shards=3), frame(spark, rows), store, AS_OF, batch_size=20)
    assert len(out) > 3 and all(r["pulled"] == r["written"] + r["duplicates"] + r["rejected"] for r in out)
    assert sum(r["pulled"] for r in out) == 200


def test_an_earlier_as_of_ends(spark):
    rows = [(f"2024-01-01 00:00:{i:02d}", "a", "b", float(i)) for i in range(50)]
    store = SyncStore.fresh(spark, "early")
    incremental_sync(spark, SPEC, frame(spark, rows[:20]), store, AS_OF, batch_size=10)
    out = incremental_sync(spark, SPEC, frame(spark, rows), store, "2020-01-01 00:00:00", batch_size=10, max_cycles=20)
    assert sum(r["written"] for r in out) == 30 and len(out) == 3
    assert store.read_target(spark, "t_copy").count() == 50


def test_a_cycle_that_runs_again_overwrites_its_control_rows(spark):
    df = frame(spark, [("2024-01-01 00:00:00", "a", "b", 1.0), (None, "n", "n", 1.0)])
    store = SyncStore.fresh(spark, "again")
    for _ in range(2):
        sync_cycle(spark, SPEC, df, store, AS_OF, seq=1)
    assert store.read_batches(spark).count() == 1 and store.read_checkpoints(spark).count() == 1
    assert store.read_audit(spark).count() == 1


def test_parallel_tables_keep_all_control_rows(spark):
    df = frame(spark, [("2024-01-01 00:00:00", "a", "b", 1.0), ("2024-01-02 00:00:00", "a", "b", 1.0), (None, "a", "b", 1.0)])
    store = SyncStore.fresh(spark, "parallel")
    specs = [TableSpec(f"t{i}", "t", "ts", f"c{i}") for i in range(12)]
    res = multi_table_sync(spark, specs, {s.table_id: df for s in specs}, store, AS_OF,
                           batch_size={"t0": 1, "t1": "auto"}, parallelism=6).collect()
    assert {r["status"] for r in res} == {"ok"} and all((r["pulled"], r["written"], r["quarantined"]) == (3, 2, 1) for r in res)
    assert store.read_checkpoints(spark).count() == 12 and store.read_audit(spark).count() == 12
    assert store.read_batches(spark).where("table_id = 't0'").count() == 2


STRICT = T.StructType([T.StructField("k", T.LongType(), False), T.StructField("s", T.StringType()), T.StructField("v", T.DoubleType())])


@pytest.mark.parametrize("line", ["not json", "", "[1]", json.dumps({"s": "no key"}), json.dumps({"k": 1, "zz": 1}), json.dumps({"k": "text"}),
                                  json.dumps({"k": 1, "v": "x"})])
def test_strict_append_rejects(spark, line):
    good = json.dumps({"k": 1, "s": "a", "v": 1.5})
    raw = spark.createDataFrame([(good,), (line,)], "value string")
    path = SyncStore.fresh(spark, "strict").target("x")
    with pytest.raises(sinks.LoadError, match="^1 rows rejected"):
        sinks.strict_stream_batch(sinks.strict_parse(spark, raw, STRICT), path, STRICT)
    assert sinks.read_or_empty(spark, path, STRICT).count() == 0
    sinks.strict_stream_batch(sinks.strict_parse(spark, raw.limit(1), STRICT), path, STRICT)
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(1, "a", 1.5)]


def test_insert_by_stream_checks_the_target(spark):
    path = SyncStore.fresh(spark, "insert").target("x")
    sinks.insert(spark.createDataFrame([(1, "a")], "k long, s string"), path, "stream", STRICT)
    for bad in (spark.createDataFrame([("x", "a")], "k string, s string"), spark.createDataFrame([(None, "a")], "k long, s string"),
                spark.createDataFrame([(1, "q")], "k long, other string")):
        with pytest.raises(sinks.LoadError):
            sinks.insert(bad, path, "stream", STRICT)
    assert spark.read.parquet(path).count() == 1


def test_full_reconcile_gives_one_row_per_id(spark):
    s = frame(spark, [("2024-01-01 00:00:00", "a", "b", 1.0)] * 3).selectExpr("1L as id", "ts")
    t = frame(spark, [("2024-01-02 00:00:00", "a", "b", 1.0)] * 2).selectExpr("2L as id", "ts")
    got = {(r["id"], r["status"]) for r in reconcile.full_reconcile(s, t.unionByName(s), "ts").collect()}
    assert got == {(1, "ok"), (2, "phantom_record")}
    assert reconcile.full_reconcile(s, t.unionByName(s), "ts").count() == 2


@pytest.mark.parametrize("text, want", [("2024-01-02 03:04:05.123456", "2024-01-02 03:04:05.123456"), ("2024-01-02", "2024-01-02 00:00:00"),
                                        ("2024-01-02T03:04:05Z", "2024-01-02 03:04:05"), ("1704164645000", "2024-01-02 03:04:05"),
                                        ("2024-13-01", None), ("nonsense", None), ("", None), ("99999999999999999", None)])
def test_timestamp_forms(spark, text, want):
    df = spark.createDataFrame([(text,)], "s string").select(normalize_ts(F.col("s"), T.StringType()).cast("string").alias("t"))
    assert df.first()["t"] == want
