"""Port event log operators (W3, W4, A6, M5 use)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.lookups import INITIAL_STATE, legal_next, status_from_event
from tidemark.operators.sequence import neighbor_row, running_sum


def with_status(events: DataFrame, type_col: str = "event_type") -> DataFrame:
    """M5: add the navigation status of every event."""
    return events.withColumn("status", status_from_event(F.col(type_col)))


def transition_check(events: DataFrame, key: str = "vessel_mmsi", ts_col: str = "event_time",
                     tiebreak: str = "event_id", bucket_seconds: int | None = None) -> DataFrame:
    """Every event with its predecessor (initial state UNDERWAY) and
    whether the transition is legal."""
    p = neighbor_row(events, [key], ts_col, [tiebreak], ["event_type"], out="_prev", direction=-1,
                     bucket_seconds=bucket_seconds)
    prev = F.coalesce(F.col("_prev.event_type"), F.lit(INITIAL_STATE))
    return p.select(tiebreak, key, ts_col, prev.alias("prev_event_type"), "event_type",
                    F.array_contains(legal_next(prev), F.col("event_type")).alias("legal"))


def port_calls(events: DataFrame, key: str = "vessel_mmsi", ts_col: str = "event_time",
               tiebreak: str = "event_id", bucket_seconds: int | None = None) -> DataFrame:
    """ARRIVAL -> BERTHED -> DEPARTURE assembled into calls.  A call runs
    from one ARRIVAL to the next; the first BERTHED and DEPARTURE in it are
    taken; incomplete calls keep NULLs."""
    is_arrival = (F.col("event_type") == "ARRIVAL").cast("int")
    p = running_sum(events, [key], ts_col, [tiebreak], is_arrival, "call_no", bucket_seconds)
    p = p.where(F.col("call_no") > 0)

    def first(t):
        return F.min(F.when(F.col("event_type") == t, F.col(ts_col)))

    calls = p.groupBy(key, "call_no").agg(
        F.min(F.when(F.col("event_type") == "ARRIVAL", F.struct(F.col(ts_col), F.col("port_id")))).alias("_arr"),
        first("BERTHED").alias("berthed_at"),
        first("DEPARTURE").alias("departed_at"),
        F.count(F.lit(1)).alias("events"))
    dwell = (F.unix_micros("departed_at") - F.unix_micros("arrived_at")) / F.lit(3.6e9)
    return calls.select(key, "call_no", F.col(f"_arr.{ts_col}").alias("arrived_at"),
                        F.col("_arr.port_id").alias("port_id"), "berthed_at", "departed_at", "events") \
        .withColumn("dwell_hours", F.round(dwell, 6))


def port_event_stats(events: DataFrame, type_col: str = "event_type", port_col: str = "port_id",
                     vessel_col: str = "vessel_mmsi", ts_col: str = "event_time") -> DataFrame:
    """Total, by type, by port and by vessel in one pass (grouping sets),
    each with first/last event time and the span in milliseconds."""
    g = events.groupingSets([[], [type_col], [port_col], [vessel_col]], type_col, port_col, vessel_col)
    agg = g.agg(
        F.count(F.lit(1)).alias("events"), F.min(ts_col).alias("first_event"), F.max(ts_col).alias("last_event"),
        F.grouping(type_col).alias("_gt"), F.grouping(port_col).alias("_gp"), F.grouping(vessel_col).alias("_gv"))
    dim = (F.when(F.col("_gt") == 0, "type").when(F.col("_gp") == 0, "port")
           .when(F.col("_gv") == 0, "vessel").otherwise("total"))
    key = F.coalesce(F.col(type_col), F.col(port_col), F.col(vessel_col).cast("string"))
    span = F.floor((F.unix_micros("last_event") - F.unix_micros("first_event")) / 1000).cast("bigint")
    return agg.select(dim.alias("dimension"), key.alias("key"), "events", "first_event", "last_event",
                      span.alias("duration_ms"))
