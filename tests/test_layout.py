"""Z-ordered copies, bucketed tables, chains of column versions."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_ORACLE
from tests.oracle_check import compare, duck
from tidemark.catalog import QUERIES, _positions
from tidemark.operators import filters, layout, schema_plan
from tidemark.oracle import ORACLE
from tidemark.session import scratch_path

DIMS = {"ts": None, "latitude": (-90.0, 90.0), "longitude": (-180.0, 180.0)}


def _share_read(path, boxes):
    """Share of row groups whose minima and maxima meet one of the boxes {column: (lo, hi)}."""
    met = total = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            cols = [meta.row_group(g).column(i) for i in range(meta.num_columns)]
            stats = {c.path_in_schema: c.statistics for c in cols}
            total += 1
            met += any(all(stats[c].min <= hi and stats[c].max >= lo for c, (lo, hi) in box.items()) for box in boxes)
    return met / total


def test_a_box_reads_a_small_share_of_a_laid_out_copy(spark):
    pos, path, plain = _positions(spark, SF_ORACLE), scratch_path(spark, "z"), scratch_path(spark, "plain")
    t = layout.write_z_ordered(pos, path, {k: DIMS[k] for k in ("latitude", "longitude")}, ["event_id"], partitions=64)
    pos.repartition(64).write.parquet(plain)
    box = {"latitude": (-30.0, 30.0)}
    across = [{**box, "longitude": (150.0, 180.0)}, {**box, "longitude": (-180.0, -150.0)}]
    assert _share_read(plain, across) > 0.9
    assert _share_read(path, across) < 0.25
    got = filters.bounding_box(t, "latitude", "longitude", -30, 30, 150, -150, n=None)
    want = filters.bounding_box(pos, "latitude", "longitude", -30, 30, 150, -150, n=None)
    assert sorted(r["event_id"] for r in got.collect()) == sorted(r["event_id"] for r in want.collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(latitude" in plan and "PushedFilters" in plan


def test_a_hot_cell_is_split_and_odd_values_stay(spark):
    rows = spark.range(6000).select("id", F.when(F.col("id") < 3000, 1.0).otherwise(F.col("id") / 100).alias("x"), F.lit(5.0).alias("y"))
    odd = spark.createDataFrame([(-1, None, None), (-2, float("nan"), 1e300), (-3, -5.0, -1e300)], "id long, x double, y double")
    path = scratch_path(spark, "hot")
    t = layout.write_z_ordered(rows.unionAll(odd), path, {"x": (0.0, 60.0), "y": (0.0, 10.0)}, ["id"], partitions=8)
    assert t.count() == 6003
    assert max(pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{path}/*.parquet")) < 2000
    empty = layout.write_z_ordered(rows.limit(0), scratch_path(spark, "none"), {"x": None, "y": None}, ["id"])
    assert empty.count() == 0


def test_z_value_interleaves_bits(spark):
    r = spark.sql("select 5L as a, 3L as b").select(layout.z_value([F.col("a"), F.col("b")], 3).alias("z")).first()
    assert r["z"] == 0b011011  # a = 101 in the even places, b = 011 in the odd ones
    with pytest.raises(ValueError):
        layout.z_value([F.lit(0)] * 4)


@pytest.mark.parametrize("name", ["z_ordered_box", "bucketed_reconcile", "full_reconcile"])
def test_queries(spark, name):
    n, problems = compare(QUERIES[name](spark, SF_ORACLE), duck(SF_ORACLE), ORACLE[name])
    assert not problems


def test_bucketed_reconcile_moves_no_row(spark):
    df = QUERIES["bucketed_reconcile"](spark, SF_ORACLE)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_versions_of_a_retyped_column(spark):
    """Add, retype and retype again: every version has its own column, and nothing is lost."""
    t = spark.createDataFrame([(1, 10)], "id long, x int")
    for step, (value, kind) in enumerate([("a", "string"), (1.5, "double"), ("b", "string"), (7, "int")]):
        new = spark.createDataFrame([(2 + step, value)], f"id long, x {kind}")
        plan = [r["column_name"] for r in schema_plan.migration_plan(spark, t.schema, new.schema).collect()]
        assert plan == [["x_v2"], ["x_v3"], [], []][step]
        t = schema_plan.apply_migration(t, new)
    assert sorted(tuple(r) for r in t.select("id", "x", "x_v2", "x_v3").collect()) == [
        (1, 10, None, None), (2, None, "a", None), (3, None, None, 1.5), (4, None, "b", None), (5, 7, None, None)]
