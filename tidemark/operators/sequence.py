"""Ordered per-key computations that survive hot keys.

A window ``partitionBy(key).orderBy(ts)`` puts every row of a key into one
task; a key holding a third of the table would then be sorted by a single
core.  The helpers here split each key into time buckets:

* the window runs over ``(key, bucket)``, so a hot key spreads over many
  tasks; buckets are either fixed time slices or (default) the partitions
  of a range partitioning on the ordering key, whose sampled bounds also
  split a burst of rows at one instant.  The bucket number is written with
  the rows before it is used: the partitioning is sampled, so it must not be
  planned a second time for the edge rows;
* what crosses a bucket border (the last row of the previous bucket, the
  running total of earlier buckets) is taken from one edge row per key and
  bucket, picked in the same window pass, and shifted or summed across
  buckets by a small window per key;
* the two are joined back on ``(key, bucket)``; the rows already have that
  partitioning, so only the small edge frame moves.

The results equal the plain window over the whole key (tests compare them
with DuckDB's ``lag``/``lead``/``sum() over``/``rank()``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path

BUCKET = "_tm_bucket"


def bucket_of(ts: Column, bucket_seconds: int) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(bucket_seconds * 1_000_000)).cast("bigint")


def _with_bucket(df: DataFrame, ts_col: str, bucket_seconds: int | None,
                 order: Sequence[str] = (), keys: Sequence[str] = ()) -> DataFrame:
    """Bucket rows of every key.  ``bucket_seconds`` = fixed time buckets;
    ``None`` = data-driven buckets: the rows are range-partitioned on
    ``(*keys, ts, *order)`` and the range partition is the bucket, so the
    sampled range bounds split a hot key, and a burst (one key, one instant,
    many rows) too, over several tasks.  Buckets keep the ordering key's order.
    The rows are written with their bucket below the shared folder and read
    back, so every branch of the plan sees the same buckets."""
    if bucket_seconds is not None:
        return df.withColumn(BUCKET, bucket_of(F.col(ts_col), bucket_seconds))
    # an explicit count: adaptive execution would merge range partitions, and with them the parts of a hot key
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(parts, *[F.col(c) for c in list(keys) + [ts_col] + list(order)])
    numbered = ranged.withColumn(BUCKET, F.spark_partition_id().cast("bigint"))
    path = scratch_path(df.sparkSession, "sequence")
    numbered.write.parquet(path)
    return df.sparkSession.read.schema(numbered.schema).parquet(path)


def _join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Null-safe equi-join on ``keys + bucket``; right-side key columns dropped."""
    cols = list(keys) + [BUCKET]
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in cols],
                     *[c for c in right.columns if c not in cols])
    cond = reduce(lambda a, b: a & b, [left[c].eqNullSafe(r[f"_r_{c}"]) for c in cols])
    return left.join(r, cond, how).drop(*[f"_r_{c}" for c in cols])


def neighbor_row(df: DataFrame, keys: Sequence[str], ts_col: str, tiebreak: Sequence[str],
                 cols: Sequence[str], out: str = "prev", direction: int = -1,
                 bucket_seconds: int | None = None) -> DataFrame:
    """Add struct column ``out`` = (ts, *tiebreak, *cols) of the previous
    (``direction=-1``, like ``lag``) or next (``+1``, like ``lead``) row of the
    same key in ``(ts, *tiebreak)`` order; null at the ends.

    One shuffle of the rows on ``(key, bucket)``; the bucket edge rows (last
    row of a bucket for ``lag``, first for ``lead``) are picked in the same
    window pass, shifted across buckets per key (one row per bucket) and
    joined back on ``(key, bucket)``, whose partitioning the rows already have."""
    keys, tiebreak, cols = list(keys), list(tiebreak), list(cols)
    fields = [ts_col] + tiebreak + [c for c in cols if c not in tiebreak and c != ts_col]
    rec = F.struct(*[F.col(c) for c in fields])
    order = [F.col(c) for c in [ts_col] + tiebreak]
    b = _with_bucket(df, ts_col, bucket_seconds, tiebreak, keys).withColumn("_rec", rec)
    w = Window.partitionBy(*keys, BUCKET).orderBy(*order)
    b = b.withColumn(out, F.lag("_rec", 1).over(w) if direction < 0 else F.lead("_rec", 1).over(w)) \
        .withColumn("_other", F.lead("_rec", 1).over(w) if direction < 0 else F.lag("_rec", 1).over(w))
    edges = b.where(F.col("_other").isNull()).select(*keys, BUCKET, F.col("_rec").alias("_edge"))
    wb = Window.partitionBy(*keys).orderBy(BUCKET)
    shift = F.lag if direction < 0 else F.lead
    carry = edges.select(*keys, BUCKET, shift("_edge", 1).over(wb).alias("_carry"))
    j = _join_on(b.drop("_other"), carry, keys, "left")
    return j.withColumn(out, F.coalesce(F.col(out), F.col("_carry"))).drop("_carry", "_rec", BUCKET)


def neighbor_rows(df: DataFrame, keys: Sequence[str], ts_col: str, tiebreak: Sequence[str],
                  cols: Sequence[str], prev: str = "prev", next_: str = "next",
                  bucket_seconds: int | None = None) -> DataFrame:
    """Previous and next row (see :func:`neighbor_row`) in one pass: one
    shuffle of the rows, one small frame of first/last rows per bucket."""
    keys, tiebreak, cols = list(keys), list(tiebreak), list(cols)
    fields = [ts_col] + tiebreak + [c for c in cols if c not in tiebreak and c != ts_col]
    order = [F.col(c) for c in [ts_col] + tiebreak]
    b = _with_bucket(df, ts_col, bucket_seconds, tiebreak, keys).withColumn("_rec", F.struct(*[F.col(c) for c in fields]))
    w = Window.partitionBy(*keys, BUCKET).orderBy(*order)
    b = b.withColumn(prev, F.lag("_rec", 1).over(w)).withColumn(next_, F.lead("_rec", 1).over(w))
    edges = b.where(F.col(prev).isNull() | F.col(next_).isNull()).groupBy(*keys, BUCKET).agg(
        F.min("_rec").alias("_first"), F.max("_rec").alias("_last"))  # at most two rows per bucket
    wb = Window.partitionBy(*keys).orderBy(BUCKET)
    carry = edges.select(*keys, BUCKET, F.lag("_last", 1).over(wb).alias("_cp"),
                         F.lead("_first", 1).over(wb).alias("_cn"))
    j = _join_on(b, carry, keys, "left")
    return j.withColumn(prev, F.coalesce(F.col(prev), F.col("_cp"))) \
        .withColumn(next_, F.coalesce(F.col(next_), F.col("_cn"))).drop("_cp", "_cn", "_rec", BUCKET)


def running_sum(df: DataFrame, keys: Sequence[str], ts_col: str, tiebreak: Sequence[str],
                value: Column, out: str, bucket_seconds: int | None = None) -> DataFrame:
    """``sum(value) over (partition by keys order by ts, tiebreak rows
    between unbounded preceding and current row)`` as column ``out``.
    Bucket totals come from the same window pass (one row per bucket is
    kept), their prefix sums per key from a window over those rows."""
    keys, tiebreak = list(keys), list(tiebreak)
    order = [F.col(c) for c in [ts_col] + tiebreak]
    b = _with_bucket(df, ts_col, bucket_seconds, tiebreak, keys).withColumn("_v", value)
    wp = Window.partitionBy(*keys, BUCKET)
    w = wp.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    b = b.withColumn("_local", F.sum("_v").over(w)).withColumn("_tot", F.sum("_v").over(wp)) \
        .withColumn("_first", F.row_number().over(wp.orderBy(*order)) == 1)
    totals = b.where("_first").select(*keys, BUCKET, "_tot")
    wb = Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, BUCKET, F.coalesce(F.sum("_tot").over(wb), F.lit(0)).alias("_off"))
    j = _join_on(b.drop("_tot", "_first"), offsets, keys, "left")
    return j.withColumn(out, F.col("_local") + F.col("_off")).drop("_v", "_local", "_off", BUCKET)


def rank_within(df: DataFrame, keys: Sequence[str], ts_col: str, out: str = "rank",
                bucket_seconds: int | None = None) -> DataFrame:
    """``rank() over (partition by keys order by ts)``.

    Ties collapse first: rows are counted per ``(key, ts)`` (a partial
    aggregate, so even a tie group holding a third of the table is one row),
    the exclusive running count over those distinct values gives the rank,
    and it is joined back on ``(key, ts)`` (AQE splits a hot tie group)."""
    keys = list(keys)
    counts = df.groupBy(*keys, ts_col).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_sum(counts, keys, ts_col, [], F.col("_n"), "_incl", bucket_seconds)
    ranks = ranked.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(ts_col).alias("_k_ts"),
                          (F.col("_incl") - F.col("_n") + 1).cast("bigint").alias(out))
    cond = reduce(lambda a, b: a & b, [df[k].eqNullSafe(ranks[f"_k_{k}"]) for k in keys] +
                  [df[ts_col].eqNullSafe(ranks["_k_ts"])])
    return df.join(ranks, cond, "left").drop(*[f"_k_{k}" for k in keys], "_k_ts")


def latest_per_key(df: DataFrame, keys: Sequence[str], ts_col: str, tiebreak: Sequence[str],
                   cols: Sequence[str] | None = None) -> DataFrame:
    """Newest row per key by ``(ts, *tiebreak)`` via ``max(struct)``: a
    partial (map-side) aggregate, so a hot key is folded before the shuffle."""
    keys, tiebreak = list(keys), list(tiebreak)
    cols = [c for c in (cols if cols is not None else df.columns) if c not in keys]
    fields = [ts_col] + tiebreak + [c for c in cols if c not in tiebreak and c != ts_col]
    agg = df.groupBy(*keys).agg(F.max(F.struct(*[F.col(c) for c in fields])).alias("_last"))
    return agg.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in fields])
