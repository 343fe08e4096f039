"""Vessel metadata (slowly changing dimension) operators (W1, W2, A7, M6 use)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.lookups import deadweight, gross_tonnage
from tidemark.operators.sequence import latest_per_key, neighbor_rows

TRACKED_ATTRIBUTES = ("status", "owner", "home_port")


def latest_by_key(updates: DataFrame, key: str = "mmsi", ts_col: str = "last_updated",
                  tiebreak: str = "version_key") -> DataFrame:
    """Current version per vessel (newest ``ts``, then highest tiebreak)."""
    return latest_per_key(updates, [key], ts_col, [tiebreak])


def attribute_changes(updates: DataFrame, key: str = "mmsi", ts_col: str = "last_updated",
                      tiebreak: str = "version_key", attributes=TRACKED_ATTRIBUTES,
                      bucket_seconds: int | None = None) -> DataFrame:
    """Every version with ``valid_from``/``valid_to`` (next version's
    time, NULL for the current one) and the attributes that changed from the
    previous version (``initial`` for the first)."""
    attrs = list(attributes)
    u = updates.select(key, ts_col, tiebreak, *attrs)
    u = neighbor_rows(u, [key], ts_col, [tiebreak], attrs, prev="_prev", next_="_next", bucket_seconds=bucket_seconds)
    changed = F.concat_ws(",", *[F.when(~F.col(a).eqNullSafe(F.col(f"_prev.{a}")), F.lit(a)) for a in attrs])
    changed = F.when(F.col("_prev").isNull(), F.lit("initial")).when(changed == "", F.lit(None)).otherwise(changed)
    return u.select(key, tiebreak, F.col(ts_col).alias("valid_from"), F.col(f"_next.{ts_col}").alias("valid_to"),
                    *attrs, changed.alias("changed_fields"))


def fleet_stats(vessels: DataFrame, as_of_year: int, type_col: str = "vessel_type", flag_col: str = "flag",
                ts_col: str = "last_updated") -> DataFrame:
    """Total, by type and by flag (grouping sets): vessels, floor of the
    average age (``as_of_year - year_built``) and length, first/last update.
    An empty input gives the total row with zeros."""
    g = vessels.groupingSets([[], [type_col], [flag_col]], type_col, flag_col)
    agg = g.agg(
        F.count(F.lit(1)).alias("vessels"),
        F.coalesce(F.floor(F.avg(F.lit(as_of_year) - F.col("year_built"))), F.lit(0)).cast("bigint").alias("avg_age"),
        F.coalesce(F.floor(F.avg("length")), F.lit(0)).cast("bigint").alias("avg_length"),
        F.min(ts_col).alias("first_update"), F.max(ts_col).alias("last_update"),
        F.grouping(type_col).alias("_gt"), F.grouping(flag_col).alias("_gf"))
    dim = F.when(F.col("_gt") == 0, "type").when(F.col("_gf") == 0, "flag").otherwise("total")
    return agg.select(dim.alias("dimension"), F.coalesce(type_col, flag_col).alias("key"), "vessels", "avg_age",
                      "avg_length", "first_update", "last_update")


def tonnage_columns(vessels: DataFrame) -> DataFrame:
    """M6: gross tonnage and deadweight derived from dimensions and type."""
    return vessels.select("mmsi", "vessel_type", "length", "beam",
                          gross_tonnage(F.col("length"), F.col("beam")).alias("gross_tonnage"),
                          deadweight(F.col("vessel_type"), F.col("length")).alias("deadweight"))
