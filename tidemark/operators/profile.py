"""Table profiles and aggregates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import shard_of
from tidemark.operators.filters import recent_filter, shard_predicate

DAY_MICROS = 86_400_000_000


def count_partition(df: DataFrame, ts_col: str, n_shards: int, shard: int | None = None,
                    method: str = "fingerprint") -> DataFrame:
    """A1: row count of one shard, or of every shard in one pass."""
    if shard is not None:
        return df.where(shard_predicate(F.col(ts_col), n_shards, shard, method)).agg(
            F.lit(shard).alias("shard"), F.count(F.lit(1)).alias("rows"))
    return df.groupBy(shard_of(F.col(ts_col), n_shards, method).alias("shard")).agg(
        F.count(F.lit(1)).alias("rows"))


def table_profile(df: DataFrame, ts_col: str = "ts", key_col: str = "mmsi", type_col: str = "vessel_type",
                  lat_col: str = "latitude", lon_col: str = "longitude", exact: bool = False) -> DataFrame:
    """A2: rows, distinct vessels and types, time range and distinct positions
    (HyperLogLog++ by default as upstream; ``exact=True`` counts exactly)."""
    pos = F.concat_ws(",", F.col(lat_col).cast("string"), F.col(lon_col).cast("string"))
    distinct_pos = F.count_distinct(F.col(lat_col), F.col(lon_col)) if exact else F.approx_count_distinct(pos)
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct(key_col).alias("unique_vessels"),
        F.count_distinct(type_col).alias("vessel_types"),
        F.min(ts_col).alias("oldest_record"),
        F.max(ts_col).alias("newest_record"),
        distinct_pos.alias("unique_positions"),
    )


def table_size(df: DataFrame, name: str) -> DataFrame:
    """A3: bytes, rows, files, created and last modified, from the scan's
    hidden ``_metadata`` column (aggregated per file, then per table)."""
    per_file = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("size"),
                         F.col("_metadata.file_modification_time").alias("mtime")) \
        .groupBy("f").agg(F.count(F.lit(1)).alias("rows"), F.max("size").alias("size"), F.max("mtime").alias("mtime"))
    return per_file.agg(
        F.lit(name).alias("table_name"), F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("num_bytes"),
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("num_rows"), F.count(F.lit(1)).alias("num_files"),
        F.min("mtime").alias("created"), F.max("mtime").alias("modified"))


def data_range(df: DataFrame, ts_col: str) -> DataFrame:
    """A4: oldest, newest, count, ``has_data`` and whole days covered.
    An empty table gives has_data=false, zero counts and NULL times."""
    agg = df.agg(F.min(ts_col).alias("oldest"), F.max(ts_col).alias("newest"),
                 F.count(F.lit(1)).alias("total_records"))
    days = F.floor((F.unix_micros("newest") - F.unix_micros("oldest")) / F.lit(DAY_MICROS)).cast("bigint")
    return agg.select("oldest", "newest", "total_records", (F.col("total_records") > 0).alias("has_data"),
                      F.coalesce(days, F.lit(0).cast("bigint")).alias("days_covered"))


def empty_range(spark: SparkSession, error: str | None = None) -> DataFrame:
    return spark.createDataFrame(
        [(None, None, 0, False, 0, error)],
        "oldest timestamp, newest timestamp, total_records bigint, has_data boolean, days_covered bigint, error string")


def verify_tables(spark: SparkSession, tables: Mapping[str, tuple]) -> DataFrame:
    """A5: per table count, oldest and newest by its own timestamp column.
    ``tables`` maps name -> (loader or DataFrame, ts column).  A table that
    cannot be read is reported with its error instead of failing the run."""
    frames = []
    for name, (src, ts_col) in tables.items():
        try:
            df = src() if callable(src) else src
            r = data_range(df, ts_col).withColumn("error", F.lit(None).cast("string"))
        except Exception as exc:  # noqa: BLE001 - isolation is the contract
            r = empty_range(spark, f"{type(exc).__name__}: {exc}"[:500])
        frames.append(r.select(F.lit(name).alias("table_name"), "*"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def type_distribution(df: DataFrame, type_col: str = "vessel_type") -> DataFrame:
    """Rows per type."""
    return df.groupBy(type_col).agg(F.count(F.lit(1)).alias("count"))


def active_by_type(df: DataFrame, as_of, lookback: str = "1 hour", type_col: str = "vessel_type",
                   key_col: str = "mmsi", speed_col: str = "speed_knots", ts_col: str = "ts") -> DataFrame:
    """Distinct vessels and average speed by type in the lookback window."""
    return recent_filter(df, ts_col, as_of, lookback).groupBy(type_col).agg(
        F.count_distinct(key_col).alias("vessel_count"), F.round(F.avg(speed_col), 6).alias("avg_speed")) \
        .orderBy(F.col("vessel_count").desc(), F.col(type_col))


def count_avg_by_type(df: DataFrame, as_of, lookback: str = "1 hour", type_col: str = "vessel_type",
                      speed_col: str = "speed_knots", ts_col: str = "ts") -> DataFrame:
    """A10: rows and average speed by type in the lookback window."""
    return recent_filter(df, ts_col, as_of, lookback).groupBy(type_col).agg(
        F.count(F.lit(1)).alias("count"), F.round(F.avg(speed_col), 6).alias("avg_speed")) \
        .orderBy(F.col("count").desc(), F.col(type_col))


def port_activity_topk(df: DataFrame, as_of, lookback: str = "1 hour", k: int = 10,
                       rest_statuses=("AT_ANCHOR", "MOORED"), port_col: str = "destination",
                       status_col: str = "status", ts_col: str = "ts") -> DataFrame:
    """Fixes at rest per destination port in the window, top ``k``
    (ties broken by port name so the cut is deterministic)."""
    r = recent_filter(df.where(F.col(status_col).isin(list(rest_statuses))), ts_col, as_of, lookback)
    return r.groupBy(F.col(port_col).alias("port")).agg(F.count(F.lit(1)).alias("vessel_count")) \
        .orderBy(F.col("vessel_count").desc(), F.col("port")).limit(k)
