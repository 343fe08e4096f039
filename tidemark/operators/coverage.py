"""Coverage, retention and backfill (R1-R5, F13 use)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.filters import range_scan_window, ts_lit
from tidemark.operators.profile import data_range
from tidemark.session import fresh_path
from tidemark.sources import sinks

DEFAULT_RETENTION_DAYS = 30


def cutoff(as_of, days: int):
    return ts_lit(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")


def retained(df: DataFrame, ts_col: str, as_of, days: int = DEFAULT_RETENTION_DAYS) -> DataFrame:
    """R1 as a frame: rows kept by the retention rule (``ts >= as_of - days``;
    strict ``<`` deletes, so a row exactly at the cutoff is kept)."""
    return df.where(F.col(ts_col) >= cutoff(as_of, days))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def retention_delete(spark: SparkSession, table_path: str, ts_col: str, as_of,
                     days: int = DEFAULT_RETENTION_DAYS, day_col: str = sinks.DAY_COL,
                     grain: str = "day") -> dict:
    """R1 on a partitioned table (``grain`` = day or month partitions): count
    what goes (before deleting), drop whole partitions older than the
    cutoff's partition, and rewrite only the boundary partition.  Kept rows
    are staged and replace the boundary partition first, by a dynamic
    partition overwrite; old partitions are dropped last.  A run that breaks
    off loses no kept row, and the next run finishes.  Returns the cutoff and
    deleted count."""
    schema = spark.read.parquet(table_path).schema
    cut = spark.range(1).select(cutoff(as_of, days).alias("c"),
                                sinks.partition_value(cutoff(as_of, days), grain).alias("d")).first()
    c_ts, c_day = cut["c"], cut["d"]
    table = spark.read.schema(schema).parquet(table_path)
    deleted = table.where((F.col(day_col) <= F.lit(c_day)) & (F.col(ts_col) < F.lit(c_ts))).count()
    if deleted == 0:
        return {"cutoff": c_ts, "deleted": 0}
    old_days = [r[0] for r in table.where(F.col(day_col) < F.lit(c_day)).select(day_col).distinct().collect()]
    boundary = table.where(F.col(day_col) == F.lit(c_day))
    keep_path = fresh_path(spark, "retention-boundary")
    boundary.where(F.col(ts_col) >= F.lit(c_ts)).write.mode("overwrite").parquet(keep_path)
    fs, root, jvm = _fs(spark, table_path)
    kept = spark.read.schema(schema).parquet(keep_path)
    if kept.isEmpty():
        old_days.append(c_day)  # nothing of the boundary partition stays
    else:
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day_col).parquet(table_path)
    for d in old_days:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{table_path}/{day_col}={d.isoformat()}"), True)
    sinks.drop_table(spark, keep_path)
    return {"cutoff": c_ts, "deleted": deleted}


def retention_all(spark: SparkSession, tables: Mapping[str, tuple], as_of,
                  days: int = DEFAULT_RETENTION_DAYS) -> DataFrame:
    """R1 over many tables (name -> (path, ts column[, grain])); a failing
    table is reported with its error and the others proceed."""
    rows = []
    for name, spec in tables.items():
        path, ts_col = spec[0], spec[1]
        grain = spec[2] if len(spec) > 2 else "day"
        try:
            r = retention_delete(spark, path, ts_col, as_of, days, grain=grain)
            rows.append((name, r["cutoff"], r["deleted"], None))
        except Exception as exc:  # noqa: BLE001 - per-table isolation
            rows.append((name, None, 0, f"{type(exc).__name__}: {exc}"[:500]))
    return spark.createDataFrame(rows, "table_name string, cutoff timestamp, deleted long, error string")


def backfill_plan(ranges: DataFrame, target_days: int, as_of) -> DataFrame:
    """R2 from A4 rows (``table_name`` optional): no data -> load the whole
    window ending at ``as_of``; else ``need = target - days_covered`` and,
    only if ``need > 1``, ``floor(need)`` days ending at the oldest row."""
    need = F.lit(target_days) - F.col("days_covered")
    days = F.when(~F.col("has_data"), F.lit(target_days)).when(need > 1, F.floor(need)).cast("bigint")
    end = F.when(~F.col("has_data"), ts_lit(as_of)).otherwise(F.col("oldest"))
    start = end - F.make_dt_interval(days)
    keep = [c for c in ("table_name",) if c in ranges.columns]
    return ranges.select(*keep, F.when(days.isNull(), "none").otherwise("backfill").alias("action"),
                         F.when(days.isNotNull(), start).alias("backfill_from"),
                         F.when(days.isNotNull(), end).alias("backfill_to"),
                         F.coalesce(days, F.lit(0).cast("bigint")).alias("days"))


def backfill_load(spark: SparkSession, archive: DataFrame, target_path: str, ts_col: str, lo, hi,
                  key_builder, grain: str = "day") -> int:
    """Fill ``[lo, hi)`` of the target from an archive/source table
    (F13 range scan, no cursor), keyed and written idempotently (S10).
    ``key_builder`` adds the key and stamp columns.  Returns rows written."""
    rows = range_scan_window(archive, ts_col, lo, hi)
    return sinks.keyed_write(key_builder(rows), target_path, ts_col, grain=grain)


def coverage_gaps(df: DataFrame, ts_col: str, start: str, end: str) -> DataFrame:
    """Calendar days in ``[start, end]`` without any row (holes that
    min/max arithmetic cannot see).  The table side is a partial aggregate to
    distinct days; the calendar is generated by Spark, one row per day."""
    spark = df.sparkSession
    cal = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)),
                                                     F.expr("INTERVAL 1 DAY"))).alias("day"))
    seen = df.where(F.col(ts_col).isNotNull()).select(F.to_date(F.col(ts_col)).alias("day")).distinct()
    return cal.join(seen, "day", "left_anti")


def rolling_window(spark: SparkSession, archive: DataFrame, target_path: str, ts_col: str, target_days: int,
                   as_of, key_builder, grain: str = "day") -> dict:
    """Keep exactly ``target_days``: profile (A4) -> plan (R2) -> backfill
    (R3) -> retention (R1)."""
    try:
        current = spark.read.parquet(target_path)
        rng = data_range(current, ts_col)
    except Exception:  # noqa: BLE001 - a missing table means no data
        from tidemark.operators.profile import empty_range
        rng = empty_range(spark).drop("error")
    plan = backfill_plan(rng, target_days, as_of).first()
    written = 0
    if plan["action"] == "backfill":
        written = backfill_load(spark, archive, target_path, ts_col, plan["backfill_from"], plan["backfill_to"],
                                key_builder, grain)
    ret = retention_delete(spark, target_path, ts_col, as_of, target_days, grain=grain)
    return {"action": plan["action"], "days": plan["days"], "written": written, "deleted": ret["deleted"]}


__all__ = ["retained", "retention_delete", "retention_all", "backfill_plan", "backfill_load",
           "coverage_gaps", "rolling_window"]
