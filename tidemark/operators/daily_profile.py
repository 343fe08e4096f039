"""Table profiles kept per day (A2, incrementally).

A profile of a whole table reads the whole table.  Here each day's row count,
time range and mergeable distinct-count sketches are stored, one small row per
day, in a table written in epochs: a batch adds the rows of its own days, and
the table's profile merges the days without reading the table.  A day can be
replaced (its rows were rewritten), and retention drops days.

A day's rows are merged from its newest replacement on, so a replay of an
epoch, which replaces the epoch's rows, never counts twice.  Rows without a
timestamp are a day of their own, which retention leaves alone (as R1 does).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.filters import ts_lit
from tidemark.sources.versioned import VersionedTable

LG_K = 12  # 2^12 registers: a relative standard error of about 1.6 %

PROFILE_COLUMNS = {"unique_vessels": ["mmsi"], "vessel_types": ["vessel_type"], "unique_positions": ["latitude", "longitude"]}


def _value(cols: list[str]) -> Column:
    """One text per distinct combination; null, which is not counted, where a part is null."""
    parts = [F.col(c).cast("string") for c in cols]
    texts = [F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts] if len(parts) > 1 else parts
    return F.concat(*texts)  # null if any part is


class DailyProfile:
    """The stored days of one table.  ``distinct`` names each distinct count and
    its columns; ``epoch`` numbers grow, and a retried step repeats its number."""

    def __init__(self, spark: SparkSession, root: str, ts_col: str = "ts",
                 distinct: Mapping[str, list[str]] = PROFILE_COLUMNS, lg_k: int = LG_K):
        self.spark, self.ts_col, self.distinct, self.lg_k = spark, ts_col, dict(distinct), lg_k
        self.schema = T.StructType([
            T.StructField("day", T.DateType()), T.StructField("epoch", T.LongType()), T.StructField("replaces", T.BooleanType()),
            T.StructField("rows", T.LongType()), T.StructField("oldest", T.TimestampType()), T.StructField("newest", T.TimestampType()),
            *[T.StructField(name, T.BinaryType()) for name in self.distinct]])
        self.table = VersionedTable(spark, root, self.schema, self._merged)

    def _merged(self, rows: DataFrame) -> DataFrame:
        """One row per day.  A day has a row per epoch that touched it since the last compaction."""
        latest = F.max(F.when(F.col("replaces"), F.col("epoch"))).over(Window.partitionBy("day"))
        live = rows.withColumn("since", latest).where(F.col("since").isNull() | (F.col("epoch") >= F.col("since")))
        return live.groupBy("day").agg(
            F.max("epoch").alias("epoch"), F.bool_or("replaces").alias("replaces"), F.sum("rows").alias("rows"),
            F.min("oldest").alias("oldest"), F.max("newest").alias("newest"),
            *[F.hll_union_agg(name).alias(name) for name in self.distinct]).select(*self.schema.names)

    def _daily(self, rows: DataFrame, epoch: int, replaces: bool) -> DataFrame:
        day = F.to_date(F.col(self.ts_col))
        return rows.groupBy(day.alias("day")).agg(
            F.count(F.lit(1)).alias("rows"), F.min(self.ts_col).alias("oldest"), F.max(self.ts_col).alias("newest"),
            *[F.hll_sketch_agg(_value(cols), self.lg_k).alias(name) for name, cols in self.distinct.items()],
        ).withColumns({"epoch": F.lit(epoch).cast("bigint"), "replaces": F.lit(replaces)}).select(*self.schema.names)

    def add(self, rows: DataFrame, epoch: int) -> bool:
        """New rows of any days (one shuffle of partial aggregates, a row per day and task)."""
        return self.table.append(self._daily(rows, epoch, False).coalesce(1), epoch)

    def replace(self, rows: DataFrame, epoch: int) -> bool:
        """All rows of the days in ``rows``: what was known of these days goes."""
        return self.table.append(self._daily(rows, epoch, True).coalesce(1), epoch)

    def retain(self, table: DataFrame, as_of, days: int, epoch: int) -> bool:
        """After R1 on ``table``: days before the cutoff go, and the cutoff's day is
        taken again from the rows it kept (a scan of that day alone)."""
        cut = ts_lit(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
        ts = F.col(self.ts_col)
        kept = self._daily(table.where((ts >= cut) & (ts < F.date_add(F.to_date(cut), 1).cast("timestamp"))), epoch, True)
        # (without this epoch: a retry sees what its first try saw)
        gone = self.table.read("main", before=epoch).where(F.col("day") <= F.to_date(cut)).join(kept.select("day"), "day", "left_anti")
        none = {name: F.lit(None).cast("binary") for name in self.distinct} | {c: F.lit(None).cast("timestamp") for c in ("oldest", "newest")}
        empty = gone.withColumns({"epoch": F.lit(epoch).cast("bigint"), "replaces": F.lit(True), "rows": F.lit(0).cast("bigint"), **none})
        return self.table.append(kept.unionByName(empty.select(*self.schema.names)).coalesce(1), epoch)

    def days(self) -> DataFrame:
        """Rows, time range and estimated distinct counts of each day that has rows."""
        return self.table.read().where("rows > 0").select(
            "day", "rows", "oldest", "newest", *[F.hll_sketch_estimate(n).alias(n) for n in self.distinct])

    def profile(self) -> DataFrame:
        """A2 from the stored days: exact counts and times, estimated distinct counts."""
        return self.table.read().where("rows > 0").agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("total_records"), F.min("oldest").alias("oldest_record"),
            F.max("newest").alias("newest_record"),
            *[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(n)), F.lit(0)).cast("bigint").alias(n) for n in self.distinct])
