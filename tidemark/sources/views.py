"""Domain views derived from the driver's tables.

The reference works on vessel positions, port events and a vessel metadata
update log.  The driver ships TPC-H-like tables and an ``events`` stream, so
the domain tables are *derived* from them with deterministic column
expressions (the same text is used by the DuckDB oracle).  Their size grows
with the inputs; nothing here is made up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import with_record_id

# Port ids of the sample port events and status thresholds.
SAMPLE_PORT_IDS = ["SFO", "LAX", "SEA", "SIN", "SHA"]
EVENT_TYPE_OF = {
    "signup": "ARRIVAL",
    "view": "BERTHED",
    "click": "DEPARTURE",
    "purchase": "UNDERWAY",
    "error": "ANCHORED",
}
SEGMENT_TO_VESSEL_TYPE = {
    "FURNITURE": "Container Ship",
    "HOUSEHOLD": "Cargo Ship",
    "MACHINERY": "Bulk Carrier",
    "BUILDING": "Tanker",
}
OTHER_VESSEL_TYPE = "Passenger Ship"
ANCHOR_BELOW_KNOTS = 2.0
MOORED_BELOW_KNOTS = 5.0


def _case(col: Column, mapping: dict, default) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default))


def derived_latitude(event_id: Column) -> Column:
    return (event_id * 7919 % 18000).cast("double") / 100 - 90


def derived_longitude(event_id: Column) -> Column:
    return (event_id * 104729 % 36000).cast("double") / 100 - 180


def positions(events: DataFrame) -> DataFrame:
    """Vessel positions: one fix per event (mmsi = user_id, type = event_type,
    speed = value, latitude/longitude derived from event_id)."""
    speed = F.col("value")
    return events.select(
        "event_id",
        "ts",
        F.col("user_id").alias("mmsi"),
        F.col("event_type").alias("vessel_type"),
        speed.alias("speed_knots"),
        derived_latitude(F.col("event_id")).alias("latitude"),
        derived_longitude(F.col("event_id")).alias("longitude"),
        F.when(speed < ANCHOR_BELOW_KNOTS, F.lit("AT_ANCHOR"))
        .when(speed < MOORED_BELOW_KNOTS, F.lit("MOORED"))
        .otherwise(F.lit("UNDERWAY_USING_ENGINE"))
        .alias("status"),
        F.concat(F.lit("PORT-"), F.lpad((F.col("user_id") % 17).cast("string"), 2, "0")).alias("destination"),
    )


def port_events(events: DataFrame) -> DataFrame:
    """Port event log: (event_time, vessel_mmsi, event_type, port_id)."""
    port = F.col("event_id") % len(SAMPLE_PORT_IDS)
    return events.select(
        "event_id",
        F.col("ts").alias("event_time"),
        F.col("user_id").alias("vessel_mmsi"),
        _case(F.col("event_type"), EVENT_TYPE_OF, None).alias("event_type"),
        _case(port, dict(enumerate(SAMPLE_PORT_IDS)), SAMPLE_PORT_IDS[-1]).alias("port_id"),
    )


def vessel_updates(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Slowly changing vessel metadata: every order is one version of the
    customer's 'vessel' (status/owner/home_port change between versions)."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice")
    c = customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    n = nation.select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("c_custkey")
    return j.select(
        F.col("o_orderkey").alias("version_key"),
        F.col("o_custkey").alias("mmsi"),
        F.col("o_orderdate").alias("last_updated"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("owner"),
        F.concat(F.lit("HP-"), F.floor(F.col("o_totalprice") / 100000).cast("bigint").cast("string")).alias("home_port"),
        _case(F.col("c_mktsegment"), SEGMENT_TO_VESSEL_TYPE, OTHER_VESSEL_TYPE).alias("vessel_type"),
        F.col("n_name").alias("flag"),
        (F.lit(50) + key * 37 % 351).alias("length"),
        (F.lit(10) + key * 13 % 51).alias("beam"),
        (F.lit(1970) + key * 11 % 55).alias("year_built"),
    )


def defective_feed(events: DataFrame) -> DataFrame:
    """The source as a faulty pipeline delivered it: rows with
    ``event_id % 97 = 0`` lost, shifted copies (``+10,000,000``) of
    ``event_id % 101 = 0`` invented, and ``ts`` nulled for ``event_id % 89 = 0``."""
    eid = F.col("event_id")
    kept = events.where(eid % 97 != 0)
    phantom = events.where(eid % 101 == 0).withColumn("event_id", eid + 10000000)
    feed = kept.unionByName(phantom)
    return feed.withColumn("ts", F.when(F.col("event_id") % 89 == 0, F.lit(None)).otherwise(F.col("ts")))


def synced_target(feed: DataFrame, ts_col: str, as_of: str) -> DataFrame:
    """What the sync writes for ``feed``: valid rows, keyed, stamped."""
    keyed = with_record_id(feed.where(F.col(ts_col).isNotNull()), ts_col)
    return keyed.withColumn("_synced_at", F.lit(as_of).cast("timestamp"))
