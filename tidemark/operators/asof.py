"""Nearest row in time of another table, per key, in time linear in both.

An interval join emits every (event, fix) pair of a key inside the tolerance:
a key with a burst of rows gives a quadratic number of pairs.  Here both
tables become one ordered sequence per key, and what an event needs is carried
along it:

1. fixes are reduced to the two smallest ids of each (key, instant): one of
   them can be the event's own record, so a second one is kept.  Equal ids are
   folded by a partial aggregate and the two are picked by a row-number limit,
   which Spark applies in every map task already: a burst at an instant sends
   two rows per task, not all of them;
2. the instants that events ask about join that sequence: one row per (key,
   instant), whatever the number of fixes or events there;
3. the sequence is cut into skew-safe buckets (see ``sequence``).  A running
   window carries the two latest fixes with different ids through a bucket, the
   same window over one row per bucket carries them across bucket borders;
   once forwards and once backwards;
4. events join the sequence on (key, instant) and choose among at most four
   candidates that are not their own record.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.sequence import BUCKET, _with_bucket

_FIRST, _SECOND = "_tm_first", "_tm_second"


def _two_per_instant(fixes: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``k, t`` and the records of the two smallest ids there (``_SECOND`` null with one id)."""
    one = fixes.groupBy("k", "t", "id").agg(F.min(F.struct("id", "t", *cols)).alias("rec"))
    near = Window.partitionBy("k", "t").orderBy("id")
    two = one.withColumn("_rn", F.row_number().over(near)).where("_rn <= 2")
    return two.groupBy("k", "t").agg(F.min("rec").alias(_FIRST), F.max(F.when(F.col("_rn") == 2, F.col("rec"))).alias(_SECOND))


def _carry(df: DataFrame, part: Sequence[str], order: Column) -> DataFrame:
    """Running pair of the latest records with different ids, the current row
    included, as ``_FIRST`` and ``_SECOND``.

    A row's second record is its own one if it has two; else the latest record
    before it with another id.  That is the row before it or, in a run of rows
    that hold the same single id, what the run's first row had."""
    w = Window.partitionBy(*part).orderBy(order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    have = F.col(_FIRST).isNotNull()
    df = df.withColumn("_prev", F.last(F.when(have, F.struct(_FIRST, _SECOND)), ignorenulls=True).over(before))
    other = F.when(F.col(f"_prev.{_FIRST}.id") != F.col(f"{_FIRST}.id"), F.col(f"_prev.{_FIRST}")) \
        .otherwise(F.col(f"_prev.{_SECOND}"))
    in_run = F.col(_SECOND).isNull() & (F.col(f"_prev.{_FIRST}.id") == F.col(f"{_FIRST}.id")) & F.col(f"_prev.{_SECOND}").isNull()
    # a row inside a run takes over what the run's first row had
    found = F.when(have & ~F.coalesce(in_run, F.lit(False)), F.struct(F.coalesce(F.col(_SECOND), other).alias("r")))
    return df.withColumn("_found", found) \
        .withColumn(_FIRST, F.last(_FIRST, ignorenulls=True).over(upto)) \
        .withColumn(_SECOND, F.last("_found", ignorenulls=True).over(upto)["r"]).drop("_prev", "_found")


def _running_pair(seq: DataFrame, forwards: bool, out: str) -> DataFrame:
    """``k, t, out`` = array of the two nearest records at or before (after) ``t``, one row per row of ``seq``."""
    order = F.col("t").asc() if forwards else F.col("t").desc()
    far = F.col(BUCKET).asc() if forwards else F.col(BUCKET).desc()
    inside = _carry(seq, ["k", BUCKET], order)
    last = Window.partitionBy("k", BUCKET).orderBy(order)
    edge = inside.withColumn("_end", F.lead("t", 1).over(last).isNull()).where("_end").select("k", BUCKET, _FIRST, _SECOND)
    ended = _carry(edge, ["k"], far)
    per_key = Window.partitionBy("k").orderBy(far)
    border = ended.select(F.col("k").alias("_k"), F.col(BUCKET).alias("_b"),
                          F.lag(_FIRST, 1).over(per_key).alias("_c1"), F.lag(_SECOND, 1).over(per_key).alias("_c2"))
    j = inside.join(border, F.col("k").eqNullSafe(F.col("_k")) & (F.col(BUCKET) == F.col("_b")), "left")
    carried = F.when(F.col("_c1.id") != F.col(f"{_FIRST}.id"), F.col("_c1")).otherwise(F.col("_c2"))
    first = F.coalesce(_FIRST, "_c1")
    second = F.when(F.col(_FIRST).isNull(), F.col("_c2")).otherwise(F.coalesce(F.col(_SECOND), carried))
    return j.select("k", "t", F.array(first, second).alias(out))


def nearest_other(events: DataFrame, fixes: DataFrame, key: tuple[str, str], ts: tuple[str, str],
                  ids: tuple[str, str], cols: Sequence[str], tolerance_seconds: float, out: str = "nearest") -> DataFrame:
    """``events`` with the struct ``out`` = (dt in microseconds, id, *cols) of
    the fix of the same key nearest in time, within the tolerance and with
    another id than the event; of equally near ones the smallest id.

    ``key``, ``ts`` and ``ids`` name the columns in (events, fixes).  Events
    without such a fix, or with a null key or time, get null; fixes with a null
    key, time or id are no candidates; an event with a null id has no own
    record, so every fix is another one."""
    slim = fixes.select(F.col(key[1]).alias("k"), F.unix_micros(F.col(ts[1])).alias("t"), F.col(ids[1]).alias("id"), *cols)
    two = _two_per_instant(slim.where("k is not null and t is not null and id is not null"), cols)
    asked = events.select(F.col(key[0]).alias("k"), F.unix_micros(F.col(ts[0])).alias("t")) \
        .where("k is not null and t is not null").distinct()
    none = lambda c: F.lit(None).cast(two.schema[c].dataType).alias(c)
    both = two.withColumn("_asked", F.lit(0)).unionByName(asked.select("k", "t", none(_FIRST), none(_SECOND), F.lit(1).alias("_asked")))
    rows = both.groupBy("k", "t").agg(F.max(_FIRST).alias(_FIRST), F.max(_SECOND).alias(_SECOND), F.max("_asked").alias("_asked"))
    seq = _with_bucket(rows, "t", None, (), ["k"])  # one row per instant, written once for both directions
    before, after = _running_pair(seq, True, "_before"), _running_pair(seq, False, "_after")
    asked_rows = seq.where("_asked = 1").select(F.col("k").alias("_qk"), F.col("t").alias("_qt"))
    near = asked_rows.join(before, (F.col("_qk") == F.col("k")) & (F.col("_qt") == F.col("t"))).drop("k", "t")
    near = near.join(after, (F.col("_qk") == F.col("k")) & (F.col("_qt") == F.col("t"))).select(
        "_qk", "_qt", F.concat("_before", "_after").alias("_near"))
    j = events.join(near, (F.col(key[0]) == F.col("_qk")) & (F.unix_micros(F.col(ts[0])) == F.col("_qt")), "left")
    at = F.unix_micros(F.col(ts[0]))

    def candidate(x: Column) -> Column:
        return F.struct(F.abs(x["t"] - at).alias("dt"), x["id"].alias("id"), *[x[c].alias(c) for c in cols])

    own = F.col(ids[0])
    valid = lambda x: x.isNotNull() & (own.isNull() | (x["id"] != own)) & (F.abs(x["t"] - at) <= F.lit(int(tolerance_seconds * 1_000_000)))
    best = F.array_min(F.transform(F.filter("_near", valid), candidate))
    return j.withColumn(out, best).drop("_qk", "_qt", "_near")
