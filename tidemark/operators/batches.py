"""Sort, limit, top-k and batch numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import shard_of
from tidemark.operators.filters import check_shard, cursor_filter, recent_filter, shard_filter
from tidemark.operators.selection import kth_smallest
from tidemark.operators.sequence import running_sum
from tidemark.sources.tables import scan_columns


def next_batch(df: DataFrame, ts_col: str, batch_size: int, cursor=None, n_shards: int = 1,
               shard: int = 0, columns=None, shard_method: str = "micros") -> DataFrame:
    """O1 composed with SRC1, F1/F4, F2, F3: the next batch of one shard after
    the cursor, in timestamp order.

    Tie-safe: the cut ``hi`` is the timestamp of the ``batch_size``-th row
    (found by counting, see ``selection``: no candidate row moves), and the
    batch is every row with ``cursor < ts <= hi``, a range that reaches the
    scan.  Rows tied with the last row are therefore never split across
    batches (the batch may exceed ``batch_size`` by one tie group)."""
    check_shard(n_shards, shard)
    src = scan_columns(df, columns, ts_col)
    if n_shards > 1:
        src = shard_filter(src, ts_col, n_shards, shard, shard_method)
    if cursor is not None:
        src = cursor_filter(src, ts_col, cursor)
    else:
        src = src.where(F.col(ts_col).isNotNull())
    hi = batch_ends(src, ts_col, batch_size).get(0)
    end = F.col(ts_col) <= instant(hi) if hi is not None else F.lit(False)
    return src.where(end).orderBy(F.col(ts_col).asc())


def instant(us: int):
    """Timestamp literal of microseconds since the epoch."""
    return F.timestamp_micros(F.lit(us).cast("long"))


def batch_ends(src: DataFrame, ts_col: str, batch_size, group: str | None = None) -> dict[int, int]:
    """Timestamp (microseconds) of the ``batch_size``-th row of every group in
    time order, of its last row if it has fewer."""
    return kth_smallest(src, F.unix_micros(F.col(ts_col)), batch_size, group,
                        within=lambda lo, hi: F.col(ts_col).between(instant(lo), instant(hi)))


def latest_n(df: DataFrame, ts_col: str, n: int = 10, tiebreak: Sequence[str] = ()) -> DataFrame:
    """O2: newest ``n`` rows (TakeOrderedAndProject)."""
    order = [F.col(ts_col).desc()] + [F.col(c).desc() for c in tiebreak]
    return df.orderBy(*order).limit(n)


def audit_recent(audit: DataFrame, as_of, hours: int = 24, ts_col: str = "timestamp") -> DataFrame:
    """O3: audit rows since ``hours`` before ``as_of``, newest first."""
    return recent_filter(audit, ts_col, as_of, f"{int(hours)} hours").orderBy(F.col(ts_col).desc())


def chronological_output(df: DataFrame, ts_col: str, tiebreak: Sequence[str] = (),
                         partitions: int | None = None) -> DataFrame:
    """Total order by event time.  With ``partitions`` the order is laid
    out as range partitions sorted inside (for files), without a global
    single-task sort."""
    order = [F.col(ts_col)] + [F.col(c) for c in tiebreak]
    if partitions:
        return df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    return df.orderBy(*order)


def checkpoint_listing(checkpoints: DataFrame) -> DataFrame:
    """Checkpoints ordered by table and node (shard)."""
    return checkpoints.orderBy("table_id", "node_id")


def shard_batches(df: DataFrame, ts_col: str, n_shards: int, batch_size: int,
                  shard_method: str = "fingerprint", bucket_seconds: int | None = None) -> DataFrame:
    """Number every batch of every shard at once (instead of polling):
    ``batch = ceil(rank / batch_size)`` with ``rank()`` over the shard in
    timestamp order, so rows tied on ``ts`` share a batch.

    The shard is a function of the timestamp, so rows are first counted per
    timestamp (a partial aggregate: a tie group of any size is one row),
    the shard hash runs on those distinct values only, the exclusive running
    count per shard (skew-safe, see ``sequence``) gives the rank, and the
    rows join it back on the timestamp."""
    rows = df.where(F.col(ts_col).isNotNull())
    counts = rows.groupBy(ts_col).agg(F.count(F.lit(1)).alias("_n")) \
        .withColumn("shard", shard_of(F.col(ts_col), n_shards, shard_method))
    ranked = running_sum(counts, ["shard"], ts_col, [], F.col("_n"), "_incl", bucket_seconds)
    ranks = ranked.select(ts_col, "shard", (F.col("_incl") - F.col("_n") + 1).cast("bigint").alias("ts_rank"))
    return rows.join(ranks, ts_col).withColumn(
        "batch_no", F.ceil(F.col("ts_rank") / F.lit(batch_size)).cast("bigint"))
