"""Track analytics over positions (J4, J6, J7, W5, W6, M3 use)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.geo import bearing_deg, dead_reckon, haversine_nm
from tidemark.operators.asof import nearest_other
from tidemark.operators.sequence import neighbor_row, running_sum

# Major ports (name, latitude, longitude) used for nearest-port lookups.
MAJOR_PORTS = [
    ("Singapore", 1.2644, 103.8223),
    ("Shanghai", 31.2304, 121.4737),
    ("Hong Kong", 22.3193, 114.1694),
    ("Busan", 35.1796, 129.0756),
    ("Guangzhou", 23.1291, 113.2644),
    ("Qingdao", 36.0671, 120.3826),
    ("Tokyo", 35.6528, 139.8394),
    ("Port Klang", 3.0041, 101.3653),
    ("Kaohsiung", 22.6163, 120.2997),
    ("Tianjin", 39.0842, 117.201),
    ("Rotterdam", 51.9225, 4.4792),
    ("Antwerp", 51.2194, 4.4025),
    ("Hamburg", 53.5511, 9.9937),
    ("Valencia", 39.4699, -0.3763),
    ("Piraeus", 37.9472, 23.6472),
    ("Felixstowe", 51.9542, 1.3511),
    ("Dubai", 25.2769, 55.2963),
    ("Jeddah", 21.5433, 39.1728),
    ("Los Angeles", 33.7405, -118.272),
    ("Long Beach", 33.7683, -118.1956),
    ("New York/New Jersey", 40.67, -74.04),
    ("Savannah", 32.0809, -81.0912),
    ("Houston", 29.7604, -95.3698),
    ("Vancouver", 49.2827, -123.1207),
    ("Santos", -23.9618, -46.3322),
    ("Manzanillo", 19.0544, -104.3188),
    ("Cape Town", -33.9249, 18.4241),
    ("Durban", -29.8587, 31.0218),
    ("Lagos", 6.4526, 3.3958),
]

# Sample ports of the port event log (id, latitude, longitude).
SAMPLE_PORTS = [
    ("SFO", 37.7749, -122.4194),
    ("LAX", 33.7405, -118.272),
    ("SEA", 47.6062, -122.3321),
    ("SIN", 1.2644, 103.8223),
    ("SHA", 31.2304, 121.4737),
]

REST_STATUSES = ("AT_ANCHOR", "MOORED")
MIN_PORT_STAY_HOURS = 12


def _r6(c):
    return F.round(c, 6)


def nearest_port(df: DataFrame, lat_col: str = "latitude", lon_col: str = "longitude",
                 ports: Sequence[tuple[str, float, float]] = MAJOR_PORTS) -> DataFrame:
    """Nearest port of every row by great-circle distance.  The port list
    is a fixed, bounded literal, so it is evaluated as plain column
    expressions per row (``least`` of the distances, then the first port in
    name order at that distance): no join, no shuffle, whole-stage codegen."""
    lat, lon = F.col(lat_col), F.col(lon_col)
    ordered = sorted(ports)
    dists = [haversine_nm(lat, lon, F.lit(plat), F.lit(plon)) for _, plat, plon in ordered]
    out = df.select(*df.columns, *[d.alias(f"_d{i}") for i, d in enumerate(dists)])
    best = F.least(*[F.col(f"_d{i}") for i in range(len(ordered))])
    name = None
    for i, (pname, _, _) in enumerate(ordered):
        cond = F.col(f"_d{i}") == F.col("port_distance_nm")
        name = F.when(cond, F.lit(pname)) if name is None else name.when(cond, F.lit(pname))
    out = out.withColumn("port_distance_nm", best)
    return out.select(*df.columns, name.alias("nearest_port"), _r6(F.col("port_distance_nm")).alias("port_distance_nm"))


def track_legs(positions: DataFrame, key: str = "mmsi", ts_col: str = "ts", tiebreak: str = "event_id",
               bucket_seconds: int | None = None) -> DataFrame:
    """Consecutive fixes per vessel -> distance (nm), hours, implied
    knots and initial bearing of every leg."""
    p = neighbor_row(positions, [key], ts_col, [tiebreak], ["latitude", "longitude", "speed_knots"],
                     out="prev", direction=-1, bucket_seconds=bucket_seconds)
    p = p.where(F.col("prev").isNotNull())
    lat0, lon0 = F.col("prev.latitude"), F.col("prev.longitude")
    hours = (F.unix_micros(F.col(ts_col)) - F.unix_micros(F.col(f"prev.{ts_col}"))) / F.lit(3.6e9)
    dist = haversine_nm(lat0, lon0, F.col("latitude"), F.col("longitude"))
    return p.select(
        F.col(key), F.col(tiebreak), F.col(f"prev.{tiebreak}").alias(f"prev_{tiebreak}"), F.col(ts_col),
        _r6(dist).alias("distance_nm"), _r6(hours).alias("hours"),
        _r6(F.when(hours > 0, dist / hours)).alias("implied_knots"),
        _r6(bearing_deg(lat0, lon0, F.col("latitude"), F.col("longitude"))).alias("bearing_deg"),
    )


def dead_reckon_check(positions: DataFrame, key: str = "mmsi", ts_col: str = "ts", tiebreak: str = "event_id",
                      outlier_nm: float = 50.0, bucket_seconds: int | None = None) -> DataFrame:
    """M3 applied: project every fix from the previous one (its reported speed
    over the elapsed time, along the leg's bearing) and measure the error
    against the actual fix; flag errors above ``outlier_nm``."""
    p = neighbor_row(positions, [key], ts_col, [tiebreak], ["latitude", "longitude", "speed_knots"],
                     out="prev", direction=-1, bucket_seconds=bucket_seconds)
    p = p.where(F.col("prev").isNotNull())
    lat0, lon0 = F.col("prev.latitude"), F.col("prev.longitude")
    hours = (F.unix_micros(F.col(ts_col)) - F.unix_micros(F.col(f"prev.{ts_col}"))) / F.lit(3.6e9)
    brg = bearing_deg(lat0, lon0, F.col("latitude"), F.col("longitude"))
    plat, plon = dead_reckon(lat0, lon0, brg, F.col("prev.speed_knots") * hours)
    err = haversine_nm(plat, plon, F.col("latitude"), F.col("longitude"))
    return p.select(
        F.col(key), F.col(tiebreak), F.col(ts_col),
        _r6(plat).alias("predicted_lat"), _r6(plon).alias("predicted_lon"),
        _r6(err).alias("error_nm"), (err > F.lit(outlier_nm)).alias("outlier"),
    )


def port_stays(positions: DataFrame, key: str = "mmsi", ts_col: str = "ts", tiebreak: str = "event_id",
               status_col: str = "status", rest_statuses: Sequence[str] = REST_STATUSES,
               min_hours: float = MIN_PORT_STAY_HOURS, bucket_seconds: int | None = None) -> DataFrame:
    """Runs of consecutive at-rest fixes per vessel (gaps and islands);
    a stay is complete when it lasts at least ``min_hours``."""
    rest = F.col(status_col).isin(list(rest_statuses))
    p = positions.withColumn("_rest", rest)
    p = neighbor_row(p, [key], ts_col, [tiebreak], ["_rest"], out="_prev", direction=-1,
                     bucket_seconds=bucket_seconds)
    change = F.when(F.col("_prev").isNull() | (F.col("_prev._rest") != F.col("_rest")), 1).otherwise(0)
    p = running_sum(p, [key], ts_col, [tiebreak], change, "_run", bucket_seconds)
    stays = p.where(F.col("_rest")).groupBy(key, "_run").agg(
        F.min(ts_col).alias("stay_start"), F.max(ts_col).alias("stay_end"), F.count(F.lit(1)).alias("fixes"))
    dur = (F.unix_micros("stay_end") - F.unix_micros("stay_start")) / F.lit(3.6e9)
    return stays.select(key, "stay_start", "stay_end", "fixes", _r6(dur).alias("duration_hours"),
                        (dur >= F.lit(float(min_hours))).alias("complete"))


def event_position_match(events: DataFrame, positions: DataFrame, tolerance_seconds: int = 6 * 3600,
                         event_types: Sequence[str] = ("ARRIVAL",),
                         ports: Sequence[tuple[str, float, float]] = SAMPLE_PORTS) -> DataFrame:
    """For every port event of ``event_types``, the nearest position fix
    in time of the same vessel within ``tolerance_seconds`` (other than the
    event's own record), and its distance to the port.

    Linear in both tables (see ``asof``): events and fixes become one ordered
    sequence per vessel, so neither a vessel with a third of all rows nor a
    burst inside the tolerance multiplies rows."""
    ev = events.where(F.col("event_type").isin(list(event_types))).select(
        "event_id", "vessel_mmsi", "event_time", "port_id").distinct()
    best = nearest_other(ev, positions, ("vessel_mmsi", "mmsi"), ("event_time", "ts"), ("event_id", "event_id"),
                         ["latitude", "longitude"], tolerance_seconds, out="b").where(F.col("b").isNotNull())
    port_lat = F.create_map(*[x for p, la, _ in ports for x in (F.lit(p), F.lit(la))])[F.col("port_id")]
    port_lon = F.create_map(*[x for p, _, lo in ports for x in (F.lit(p), F.lit(lo))])[F.col("port_id")]
    return best.select(
        "event_id", "vessel_mmsi", "event_time", "port_id", F.col("b.id").alias("fix_id"),
        (F.col("b.dt") / F.lit(1e6)).alias("dt_seconds"),
        _r6(haversine_nm(F.col("b.latitude"), F.col("b.longitude"), port_lat, port_lon)).alias("distance_nm"),
    )


def join_synced_tables(positions: DataFrame, vessels: DataFrame, key: str = "mmsi") -> DataFrame:
    """Positions enriched with the current vessel metadata on the shared
    key (left join: a fix without metadata keeps NULLs).  The join strategy is
    left to Catalyst/AQE (broadcast only when the statistics prove it small)."""
    v = vessels.select(key, F.col("vessel_type").alias("meta_vessel_type"), "flag",
                       F.col("status").alias("meta_status"), "length")
    return positions.join(v, key, "left")
