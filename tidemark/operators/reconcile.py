"""Source/target reconciliation (J1-J3, F5 use, A13).

The reference probes a handful of rows one lookup at a time; here both
directions are set operations (anti joins on the content-hash id), either
over a sample or over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import shard_of
from tidemark.operators.filters import recent_filter, shard_predicate, ts_lit
from tidemark.operators.selection import kth_smallest
from tidemark.session import scratch_path


def newest_sample(df: DataFrame, ts_col: str, n: int | None, key: str = "id") -> DataFrame:
    """The ``n`` newest rows (ties broken by key); ``None`` = all rows."""
    if n is None:
        return df
    return df.orderBy(F.col(ts_col).desc(), F.col(key).desc()).limit(n)


def hash_rank(key: str = "id", seed: int = 0):
    """Pseudo-random order of records, the same in every copy of them: 60 bits of a SHA-256."""
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def hash_samples(source_keys: DataFrame, target: DataFrame, ts_col: str, n: int, key: str = "id",
                 seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """V3, hash-random: the records of both sides among the ``n`` smallest hashes
    of the two together.  Both samples end at the same hash, so a record of one
    side is in the sample exactly if its copy on the other side would be: what
    one sample lacks, its table lacks, wherever in time it lies.

    Keys may be hashes of whole records and filters would compute them again
    and again, so key, time and hash of each row are written once.  The bound
    is found there by counting (bottom-k as a partial aggregate, see
    ``selection``): neither table is sorted or moved, and ids that occur on both
    sides or repeatedly count once per row."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(key, ts_col, hash_rank(key, seed).alias("_r"), F.lit(name).alias("_side"))

    both = side(source_keys, "s").unionByName(side(target, "t"))
    path = scratch_path(both.sparkSession, "hash-ranks")
    both.write.parquet(path)
    ranked = both.sparkSession.read.schema(both.schema).parquet(path)
    bound = kth_smallest(ranked, F.col("_r"), 2 * n).get(0)
    inside = ranked.where(F.col("_r") <= F.lit(-1 if bound is None else bound))  # ranks are not negative
    return tuple(inside.where(F.col("_side") == x).select(key, ts_col) for x in ("s", "t"))


def sampled_differences(source_keys: DataFrame, target: DataFrame, ts_col: str, n: int, key: str = "id",
                        seed: int = 0) -> DataFrame:
    """Phantom and missing records within the hash-random samples of both sides
    (about ``n`` records of each), one row per id."""
    s, t = hash_samples(source_keys, target, ts_col, n, key, seed)
    found = full_reconcile(s, t, ts_col, key).where(F.col("status") != "ok")
    return found.select(key, ts_col, F.col("status").alias("issue"))


def phantom_records(target: DataFrame, source_keys: DataFrame, ts_col: str, sample: int | None = None,
                    key: str = "id") -> DataFrame:
    """Target rows (the ``sample`` newest, or all) without a source
    counterpart -> ``phantom_record`` issues.  A bounded sample is broadcast."""
    t = newest_sample(target.select(key, ts_col), ts_col, sample, key)
    return _absent(t, source_keys, key, ts_col, sample).select(
        key, ts_col, F.lit("phantom_record").alias("issue"))


MAX_BROADCAST_SAMPLE = 100_000  # rows of (key, timestamp)


def _absent(probe: DataFrame, other: DataFrame, key: str, ts_col: str, sample: int | None) -> DataFrame:
    """Rows of ``probe`` whose key is not in ``other``.  The key hashes the
    timestamp too, so a sample is looked up in its own time range only (the
    range reaches the scan of ``other``, below its key expressions), in a
    semi join that streams ``other``; the few matches are removed from the
    sample."""
    if sample is None:
        return probe.join(other.select(key), key, "left_anti")
    lo, hi = probe.agg(F.min(ts_col)).scalar(), probe.agg(F.max(ts_col)).scalar()
    near = other.where((F.col(ts_col) >= lo) & (F.col(ts_col) <= hi))
    keys = F.broadcast(probe.select(key)) if sample <= MAX_BROADCAST_SAMPLE else probe.select(key)
    found = near.select(key).join(keys, key, "left_semi")
    return probe.join(found, key, "left_anti")


def missing_records(source_keys: DataFrame, target: DataFrame, ts_col: str, sample: int | None = None,
                    as_of=None, lookback: str | None = None, n_shards: int = 1, shard: int = 0,
                    shard_method: str = "fingerprint", key: str = "id") -> DataFrame:
    """Source rows (of one shard, newer than ``as_of - lookback``, the
    first ``sample`` in time order, or all) without a target row -> ``missing_record``."""
    s = source_keys.select(key, ts_col)
    if n_shards > 1:
        s = s.where(shard_predicate(F.col(ts_col), n_shards, shard, shard_method))
    if as_of is not None and lookback is not None:
        s = recent_filter(s, ts_col, as_of, lookback)
    if sample is not None:
        s = s.orderBy(F.col(ts_col), F.col(key)).limit(sample)
    return _absent(s, target, key, ts_col, sample).select(
        key, ts_col, F.lit("missing_record").alias("issue"))


def full_reconcile(source_keys: DataFrame, target: DataFrame, ts_col: str, key: str = "id") -> DataFrame:
    """Both directions over whole tables: one row per id with ``status`` in
    (``ok``, ``missing_record``, ``phantom_record``).  The sides are united and
    aggregated on the id (partial aggregates, one shuffle of slim rows), so
    repeated ids give one row and a hot id is folded before the shuffle."""
    s = source_keys.select(key, F.col(ts_col).alias("_s_ts"), F.lit(None).cast("timestamp").alias("_t_ts"),
                           F.lit(1).alias("_in_s"), F.lit(0).alias("_in_t"))
    t = target.select(key, F.lit(None).cast("timestamp").alias("_s_ts"), F.col(ts_col).alias("_t_ts"),
                      F.lit(0).alias("_in_s"), F.lit(1).alias("_in_t"))
    g = s.unionByName(t).groupBy(key).agg(F.max("_s_ts").alias("_s_ts"), F.max("_t_ts").alias("_t_ts"),
                                          F.max("_in_s").alias("_in_s"), F.max("_in_t").alias("_in_t"))
    status = (F.when(F.col("_in_s") == 0, "phantom_record")
              .when(F.col("_in_t") == 0, "missing_record").otherwise("ok"))
    return g.select(key, F.coalesce("_s_ts", "_t_ts").alias(ts_col), status.alias("status"))


def reconcile_summary(recon: DataFrame) -> DataFrame:
    return recon.groupBy("status").agg(F.count(F.lit(1)).alias("records"))


def count_drift(source: DataFrame, target: DataFrame, ts_col: str, n_shards: int = 1,
                shard_method: str = "fingerprint", ok_below: int = 100, alert_above: int = 1000) -> DataFrame:
    """Per shard counts on both sides, ``delta = |source - target|``;
    ``ok`` below ``ok_below``, ``alert`` above ``alert_above``, else ``drift``."""
    def counts(df, name):
        return df.where(F.col(ts_col).isNotNull()).groupBy(
            shard_of(F.col(ts_col), n_shards, shard_method).alias("shard")).agg(F.count(F.lit(1)).alias(name))

    j = counts(source, "source_count").join(counts(target, "target_count"), "shard", "full_outer")
    s = F.coalesce("source_count", F.lit(0)).cast("bigint")
    t = F.coalesce("target_count", F.lit(0)).cast("bigint")
    delta = F.abs(s - t)
    status = F.when(delta < ok_below, "ok").when(delta > alert_above, "alert").otherwise("drift")
    return j.select("shard", s.alias("source_count"), t.alias("target_count"), delta.alias("delta"),
                    status.alias("status"))


def late_rows(source: DataFrame, target: DataFrame, ts_col: str, cursor, allowed_lateness: str,
              key: str = "id") -> DataFrame:
    """Rows at or before the cursor (within ``allowed_lateness``) that
    the target lacks: they arrived after the cursor had passed them."""
    lo = ts_lit(cursor) - F.expr(f"INTERVAL {allowed_lateness}")
    window = source.where((F.col(ts_col) > lo) & (F.col(ts_col) <= ts_lit(cursor)))
    tgt = target.where((F.col(ts_col) > lo) & (F.col(ts_col) <= ts_lit(cursor))).select(key)
    return window.join(tgt, key, "left_anti")
