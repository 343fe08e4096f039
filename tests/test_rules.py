"""Rule-level tests: column selection, keys, shards, phases, schema plans."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF_ORACLE, SF_SMALL
from tidemark.functions import convert
from tidemark.functions.keys import MAX_SAFE_INTEGER, fingerprint_shard, micros_shard, with_record_id
from tidemark.operators import control, schema_plan
from tidemark.sources.tables import ColumnSelectionError, normalize_columns, read_table


@pytest.mark.parametrize("cols", [None, "*", ["*"]])
def test_columns_wildcards(cols):
    assert normalize_columns(cols, "ts") == ["*"]


def test_columns_trim_and_require_ts():
    assert normalize_columns([" ts ", "mmsi"], "ts") == ["ts", "mmsi"]
    with pytest.raises(ColumnSelectionError):
        normalize_columns(["mmsi"], "ts")
    with pytest.raises(ColumnSelectionError):
        normalize_columns([], "ts")
    with pytest.raises(ColumnSelectionError):
        normalize_columns(["ts", "  "], "ts")
    with pytest.raises(ColumnSelectionError):
        normalize_columns(["ts", 3], "ts")


def test_record_id_deterministic_and_sensitive(spark):
    rows = [(1, "2024-01-01 00:00:00", 1.5), (1, "2024-01-01 00:00:00", 1.5),
            (1, "2024-01-01 00:00:01", 1.5), (1, "2024-01-01 00:00:00", 1.6)]
    df = spark.createDataFrame(rows, "k long, ts string, v double").withColumn("ts", F.col("ts").cast("timestamp"))
    ids = [r["id"] for r in with_record_id(df, "ts").collect()]
    assert ids[0] == ids[1]
    assert len({ids[0], ids[2], ids[3]}) == 3
    assert all(0 <= i < MAX_SAFE_INTEGER for i in ids)


def test_record_id_renames_source_id(spark):
    df = spark.createDataFrame([(7, "2024-01-01 00:00:00")], "id long, ts string") \
        .withColumn("ts", F.col("ts").cast("timestamp"))
    out = with_record_id(df, "ts")
    assert out.columns == ["id", "source_id", "ts"]


def test_shards_disjoint_complete_balanced(spark):
    ev = read_table(spark, SF_ORACLE, "events")
    n = 3
    counts = ev.groupBy(fingerprint_shard(F.col("ts"), n).alias("s")).count().collect()
    total = ev.count()
    assert sum(r["count"] for r in counts) == total
    assert sorted(r["s"] for r in counts) == [0, 1, 2]
    for r in counts:
        assert abs(r["count"] - total / n) <= 0.10 * total / n


def test_micros_shard_pre_1970_gets_a_shard(spark):
    df = spark.createDataFrame([("1969-12-31 23:59:59.999998",)], "ts string") \
        .select(F.col("ts").cast("timestamp").alias("ts"))
    r = df.select(micros_shard(F.col("ts"), 3).alias("p"), micros_shard(F.col("ts"), 3, False).alias("m")).first()
    assert r["p"] in (0, 1, 2) and r["m"] < 0


def test_micros_shard_collapses_on_day_granular_ts(spark):
    li = read_table(spark, SF_SMALL, "lineitem")
    shards = {r[0] for r in li.select(micros_shard(F.col("l_shipdate"), 3)).distinct().collect()}
    assert shards == {0}
    spread = {r[0] for r in li.select(fingerprint_shard(F.col("l_shipdate"), 3)).distinct().collect()}
    assert spread == {0, 1, 2}


@pytest.mark.parametrize("lag,phase,size,poll", [(3601, "initial", 10000, 1), (3600, "catchup", 1000, 5),
                                                 (301, "catchup", 1000, 5), (300, "steady", 500, 30),
                                                 (0, "steady", 500, 30)])
def test_phase_thresholds(spark, lag, phase, size, poll):
    df = spark.createDataFrame([(float(lag),)], "lag double")
    ph = control.sync_phase(F.col("lag"))
    r = df.select(ph.alias("p"), control.batch_size_for(ph).alias("b"), control.poll_interval_for(ph).alias("i")).first()
    assert (r["p"], r["b"], r["i"]) == (phase, size, poll)


def test_batch_size_override(spark):
    df = spark.createDataFrame([("initial",), ("other",)], "p string")
    got = [r[0] for r in df.select(control.batch_size_for(F.col("p"), {"initial": 2500})).collect()]
    assert got == [2500, 1000]


@pytest.mark.parametrize("name,expected", [
    ("INTEGER", T.LongType()), ("int64", T.LongType()), ("FLOAT64", T.DoubleType()),
    ("NUMERIC", T.DecimalType(38, 9)), ("BIGNUMERIC", T.DecimalType(38, 18)), ("STRING", T.StringType()),
    ("BYTES", T.BinaryType()), ("BOOL", T.BooleanType()), ("TIMESTAMP", T.TimestampType()),
    ("DATE", T.DateType()), ("TIME", T.StringType()), ("DATETIME", T.TimestampType()),
    ("GEOGRAPHY", T.StringType()), ("JSON", T.StringType()), ("SOMETHING_NEW", T.StringType())])
def test_map_type(name, expected):
    assert convert.map_type(name) == expected


def test_map_field_modes_and_records():
    f = convert.map_field({"name": "tags", "type": "STRING", "mode": "REPEATED"})
    assert f.dataType == T.ArrayType(T.StringType(), True) and f.nullable
    f = convert.map_field({"name": "id", "type": "INTEGER", "mode": "REQUIRED"})
    assert not f.nullable
    rec = convert.map_field({"name": "r", "type": "RECORD", "fields": [{"name": "a", "type": "FLOAT"}]})
    assert rec.dataType == T.StructType([T.StructField("a", T.DoubleType(), True)])
    assert convert.map_type("NUMERIC", lossy_numeric=True) == T.DoubleType()


def test_migration_plan_branches(spark):
    src = T.StructType([T.StructField("id", T.LongType()), T.StructField("email", T.StringType())])
    create = schema_plan.migration_plan(spark, None, src).collect()
    assert schema_plan.plan_action(create) == "create" and len(create) == 2
    same = schema_plan.migration_plan(spark, src, src).collect()
    assert schema_plan.plan_action(same) == "none"
    old = T.StructType([T.StructField("id", T.LongType())])
    add = schema_plan.migration_plan(spark, old, src).collect()
    assert [(r["action"], r["column_name"], r["data_type"]) for r in add] == [("add", "email", "string")]
    conflict_old = T.StructType([T.StructField("count", T.StringType())])
    conflict_new = T.StructType([T.StructField("count", T.LongType())])
    c = schema_plan.migration_plan(spark, conflict_old, conflict_new).collect()
    assert [(r["column_name"], r["data_type"]) for r in c] == [("count_v2", "bigint")]


def test_apply_migration_routes_conflicts(spark):
    old = spark.createDataFrame([(1, "a")], "id long, count string")
    new = spark.createDataFrame([(2, 5, "x@y")], "id long, count long, email string")
    out = schema_plan.apply_migration(old, new)
    assert set(out.columns) == {"id", "count", "count_v2", "email"}
    rows = {r["id"]: r for r in out.collect()}
    assert rows[1]["count"] == "a" and rows[1]["count_v2"] is None
    assert rows[2]["count"] is None and rows[2]["count_v2"] == 5 and rows[2]["email"] == "x@y"


def test_layout_columns():
    schema = T.StructType([T.StructField(n, T.StringType()) for n in
                           ["timestamp", "id", "vessel_id", "portId", "valid", "paid", "name"]]
                          + [T.StructField("tags_id", T.ArrayType(T.StringType()))])
    assert schema_plan.layout_columns(schema, "timestamp") == ["timestamp", "id", "vessel_id", "portId"]


def test_normalize_ts_forms(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05.123456Z",), ("2024-01-02T03:04:05+02:00",),
                                ("2024-01-02 03:04:05",), ("1704164645000",), ("",), ("text",),
                                ("2024-13-01 00:00:00",), ("2024-01-32 00:00:00",), (None,)], "s string")
    got = [r[0] for r in df.select(convert.normalize_ts(F.col("s")).cast("string")).collect()]
    assert got[:4] == ["2024-01-02 03:04:05.123456", "2024-01-02 01:04:05", "2024-01-02 03:04:05",
                       "2024-01-02 03:04:05"]
    assert got[4:] == [None] * 5


def test_quarantine_reasons(spark):
    df = spark.createDataFrame([(1, None, None), (2, "2024-01-01 00:00:00", "value"),
                                (3, "2024-01-01 00:00:00", None)], "k long, ts string, _conversion_error string")
    got = {r["k"]: r["reason"] for r in convert.quarantine_split(df, "ts", "_conversion_error").collect()}
    assert got == {1: "missing_ts", 2: "processing_error: value", 3: None}


def test_cluster_conf_sizes_partitions():
    from tidemark.session import cluster_conf

    big = cluster_conf(100 * 1024 ** 4, executors=1000, cores_per_executor=8)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // (128 * 1024 ** 2)
    small = cluster_conf(10 * 1024 ** 2, executors=2, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
