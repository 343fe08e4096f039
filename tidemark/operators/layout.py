"""Physical layouts of stored copies (F7, SNK6, J3): Z-ordered files and bucketed tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 16  # per dimension: three of them fit a long
Z_COL = "_z"


def cell(value: Column, lo: float, hi: float, bits: int = BITS) -> Column:
    """The number of the value's cell, of 2**bits equal ones between ``lo`` and
    ``hi``; values outside take the nearest cell, missing ones the first."""
    if not hi > lo:
        return F.lit(0).cast("long")
    scaled = F.floor((value - F.lit(lo)) / F.lit(hi - lo) * F.lit(1 << bits))
    return F.coalesce(F.least(F.greatest(scaled, F.lit(0)), F.lit((1 << bits) - 1)), F.lit(0)).cast("long")


def z_value(cells: Sequence[Column], bits: int = BITS) -> Column:
    """Z-order value: the cells' bits interleaved, so that rows near each other
    in every dimension are near each other in one order."""
    if len(cells) * bits > 63:
        raise ValueError(f"{len(cells)} dimensions of {bits} bits do not fit a long")
    z = F.lit(0).cast("long")
    for i in range(bits):
        for d, c in enumerate(cells):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(c, i).bitwiseAND(F.lit(1).cast("long")), i * len(cells) + d))
    return z


def with_z_value(df: DataFrame, dims: Mapping[str, tuple | None], bits: int = BITS) -> DataFrame:
    """``df`` with its Z-order value over ``dims``: column -> (lowest, highest)
    value, or ``None`` for the range that the table holds (one aggregate)."""
    value = {}
    for c in dims:
        instant = isinstance(df.schema[c].dataType, (T.TimestampType, T.TimestampNTZType))
        value[c] = F.unix_micros(F.col(c).cast("timestamp")).cast("double") if instant else F.col(c).cast("double")
    held = [c for c, r in dims.items() if r is None]
    found = df.agg(*[f(value[c]) for c in held for f in (F.min, F.max)]).first() if held else ()
    span = {c: (found[2 * i] or 0.0, found[2 * i + 1] or 0.0) for i, c in enumerate(held)}
    cells = [cell(value[c], *(r or span[c]), bits) for c, r in dims.items()]
    return df.withColumn(Z_COL, z_value(cells, bits))


def write_z_ordered(df: DataFrame, path: str, dims: Mapping[str, tuple | None], tiebreak: Sequence[str],
                    partitions: int | None = None, row_group_bytes: int | None = None) -> DataFrame:
    """A copy of ``df`` in Z-order of ``dims``: every file and row group covers a
    small box, so minima and maxima prune on any of the dimensions.

    The range partitioning goes on with ``tiebreak``: a cell that holds a third
    of all rows is split over tasks like any other."""
    keys = [F.col(Z_COL), *[F.col(c) for c in tiebreak]]
    out = with_z_value(df, dims)
    out = out.repartitionByRange(partitions, *keys) if partitions else out.repartitionByRange(*keys)
    w = out.sortWithinPartitions(*keys).drop(Z_COL).write.mode("overwrite")
    if row_group_bytes:
        w = w.option("parquet.block.size", row_group_bytes)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed_copy(df: DataFrame, table: str, path: str, key: str = "id", buckets: int = 200) -> DataFrame:
    """A catalog table of ``df`` at ``path``, hashed into ``buckets`` files by ``key`` and
    sorted by it: joins and groups on the key with a table of as many buckets move no row."""
    w = df.repartition(buckets, F.col(key)).write.mode("overwrite").format("parquet").option("path", path)
    w.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def reconcile_bucketed(source: DataFrame, target: DataFrame, ts_col: str, key: str = "id") -> DataFrame:
    """J3 over two bucketed copies: one row per id with ``status`` in (``ok``,
    ``missing_record``, ``phantom_record``).  Both sides fold repeated ids and meet in
    a full join, all inside their buckets.  Ids are never null (they are hashes)."""
    s = source.groupBy(key).agg(F.max(ts_col).alias("_s_ts"), F.lit(1).alias("_in_s"))
    t = target.groupBy(key).agg(F.max(ts_col).alias("_t_ts"), F.lit(1).alias("_in_t"))
    status = (F.when(F.col("_in_s").isNull(), "phantom_record").when(F.col("_in_t").isNull(), "missing_record").otherwise("ok"))
    return s.hint("merge").join(t, key, "full_outer").select(key, F.coalesce("_s_ts", "_t_ts").alias(ts_col), status.alias("status"))
