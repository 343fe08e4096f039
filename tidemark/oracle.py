"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each text runs on the driver's tables (pre-registered views) and must give
the same rows, column names and values as the Spark query of the same key.
"""

from __future__ import annotations

from tidemark.operators.tracks import MAJOR_PORTS, SAMPLE_PORTS

# ---------------------------------------------------------------- fragments

EVENT_COLS = [("event_id", "long"), ("ts", "ts"), ("user_id", "long"), ("event_type", "string"),
              ("value", "double"), ("props", "string")]


def _text(col: str, kind: str) -> str:
    if kind == "ts":
        s = f"CAST(epoch_us({col}) AS VARCHAR)"
    elif kind == "double":
        exact = f"TRY_CAST({col} AS DECIMAL(38,9))"
        s = f"CASE WHEN CAST({exact} AS DOUBLE) = {col} THEN CAST({exact} AS VARCHAR) ELSE CAST({col} AS VARCHAR) END"
    else:
        s = f"CAST({col} AS VARCHAR)"
    return f"coalesce(CAST(length({s}) AS VARCHAR) || ':' || {s}, '-')"


def record_id_sql(ts_col: str, cols=EVENT_COLS) -> str:
    text = " || ".join([_text(ts_col, "ts")] + [_text(c, k) for c, k in cols])
    u = f"('0x' || substr(sha256({text}), 1, 16))::UBIGINT"
    mag = f"(CASE WHEN {u} >= 9223372036854775808 THEN 18446744073709551616::HUGEINT - {u} ELSE {u}::HUGEINT END)"
    return f"(({mag})::DOUBLE::HUGEINT % 9007199254740991::HUGEINT)::BIGINT"


def fp_shard_sql(ts: str, n: int) -> str:
    return f"(('0x' || substr(sha256(CAST(epoch_us({ts}) AS VARCHAR)), 1, 15))::BIGINT % {n})"


POSITIONS = """positions AS (
  SELECT event_id, ts, user_id AS mmsi, event_type AS vessel_type, value AS speed_knots,
         CAST(event_id * 7919 % 18000 AS DOUBLE) / 100 - 90 AS latitude,
         CAST(event_id * 104729 % 36000 AS DOUBLE) / 100 - 180 AS longitude,
         CASE WHEN value < 2 THEN 'AT_ANCHOR' WHEN value < 5 THEN 'MOORED'
              ELSE 'UNDERWAY_USING_ENGINE' END AS status,
         'PORT-' || lpad(CAST(user_id % 17 AS VARCHAR), 2, '0') AS destination
  FROM events)"""

PORT_EVENTS = """port_events AS (
  SELECT event_id, ts AS event_time, user_id AS vessel_mmsi,
         CASE event_type WHEN 'signup' THEN 'ARRIVAL' WHEN 'view' THEN 'BERTHED'
              WHEN 'click' THEN 'DEPARTURE' WHEN 'purchase' THEN 'UNDERWAY'
              WHEN 'error' THEN 'ANCHORED' END AS event_type,
         CASE event_id % 5 WHEN 0 THEN 'SFO' WHEN 1 THEN 'LAX' WHEN 2 THEN 'SEA'
              WHEN 3 THEN 'SIN' ELSE 'SHA' END AS port_id
  FROM events)"""

VESSEL_UPDATES = """vessel_updates AS (
  SELECT o_orderkey AS version_key, o_custkey AS mmsi, o_orderdate AS last_updated,
         o_orderstatus AS status, o_orderpriority AS owner,
         'HP-' || CAST(CAST(floor(o_totalprice / 100000) AS BIGINT) AS VARCHAR) AS home_port,
         CASE c_mktsegment WHEN 'FURNITURE' THEN 'Container Ship' WHEN 'HOUSEHOLD' THEN 'Cargo Ship'
              WHEN 'MACHINERY' THEN 'Bulk Carrier' WHEN 'BUILDING' THEN 'Tanker'
              ELSE 'Passenger Ship' END AS vessel_type,
         n_name AS flag,
         50 + c_custkey * 37 % 351 AS length,
         10 + c_custkey * 13 % 51 AS beam,
         1970 + c_custkey * 11 % 55 AS year_built
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

FEED = """feed AS (
  SELECT event_id, CASE WHEN event_id % 89 = 0 THEN NULL ELSE ts END AS ts,
         user_id, event_type, value, props
  FROM (SELECT * FROM events WHERE event_id % 97 <> 0
        UNION ALL
        SELECT event_id + 10000000 AS event_id, ts, user_id, event_type, value, props
        FROM events WHERE event_id % 101 = 0))"""

AS_OF = "2024-01-31 00:00:00"


def target_sql(as_of: str = AS_OF) -> str:
    return f"""target AS (
  SELECT {record_id_sql('ts')} AS id, event_id, ts, user_id, event_type, value, props,
         TIMESTAMP '{as_of}' AS _synced_at
  FROM feed WHERE ts IS NOT NULL)"""


def source_keyed_sql() -> str:
    return f"""source AS (
  SELECT {record_id_sql('ts')} AS id, event_id, ts, user_id, event_type, value, props FROM events)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLE: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


# ------------------------------------------------------- sources and filters

register("scan_columns", "SELECT event_id, ts, user_id FROM events")
register("shard_filter", "SELECT * FROM events WHERE epoch_us(ts) % 3 = 1")
register("cursor_filter", "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'")
register("fingerprint_shard", f"""
SELECT {fp_shard_sql('l_shipdate', 3)} AS shard, count(*) AS n FROM lineitem GROUP BY 1""")
register("next_batch", f"""
WITH cand AS (
  SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem
  WHERE {fp_shard_sql('l_shipdate', 3)} = 1 AND l_shipdate > TIMESTAMP '1996-01-01 00:00:00'),
hi AS (SELECT max(l_shipdate) AS m FROM (SELECT l_shipdate FROM cand ORDER BY l_shipdate LIMIT 10000))
SELECT * FROM cand WHERE l_shipdate <= (SELECT m FROM hi)""")
register("record_id", f"SELECT event_id, {record_id_sql('ts')} AS id FROM events")
register("filter_by_type", with_(POSITIONS) + """
SELECT * FROM positions WHERE vessel_type = 'click' ORDER BY ts DESC, event_id LIMIT 100""")
register("bounding_box", with_(POSITIONS) + f"""
SELECT * FROM positions
WHERE latitude BETWEEN -45 AND 45 AND longitude BETWEEN -90 AND 90
  AND ts >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY
ORDER BY ts DESC, event_id LIMIT 1000""")
register("z_ordered_box", with_(POSITIONS) + """
SELECT * FROM positions WHERE latitude BETWEEN -30 AND 30 AND (longitude >= 150 OR longitude <= -150)""")
register("recent_filter", f"SELECT * FROM events WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR")
register("status_in", with_(POSITIONS) + "SELECT * FROM positions WHERE status IN ('AT_ANCHOR', 'MOORED')")
register("pk_lookup", """
SELECT * FROM customer WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase')""")
register("dynamic_search", """
SELECT * FROM lineitem WHERE l_quantity > 45 AND l_returnflag IN ('R', 'A')
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 500""")
register("range_scan_window", """
SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-02-01'""")
register("existence_probe", with_(FEED, target_sql()) + """
SELECT * FROM target WHERE event_id IN (SELECT event_id FROM events)""")
register("latest_n", "SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 10")
register("chronological_output", "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey")
register("shard_batches", f"""
WITH s AS (SELECT l_orderkey, l_linenumber, l_shipdate, {fp_shard_sql('l_shipdate', 3)} AS shard FROM lineitem),
r AS (SELECT *, rank() OVER (PARTITION BY shard ORDER BY l_shipdate) AS ts_rank FROM s)
SELECT *, CAST(ceil(ts_rank / 1000) AS BIGINT) AS batch_no FROM r""")


# --------------------------------------------------------- geometry in SQL

def _rad(x: str) -> str:
    return f"(({x}) * pi() / 180)"


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    dlat = _rad(f"({lat2}) - ({lat1})")
    dlon = _rad(f"({lon2}) - ({lon1})")
    a = (f"(sin({dlat} / 2) * sin({dlat} / 2) + cos({_rad(lat1)}) * cos({_rad(lat2)})"
         f" * sin({dlon} / 2) * sin({dlon} / 2))")
    return f"(6371.0 * (2 * atan2(sqrt({a}), sqrt(1 - {a}))) * 0.539957)"


def bearing_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    dlon = _rad(f"({lon2}) - ({lon1})")
    y = f"(sin({dlon}) * cos({_rad(lat2)}))"
    x = f"(cos({_rad(lat1)}) * sin({_rad(lat2)}) - sin({_rad(lat1)}) * cos({_rad(lat2)}) * cos({dlon}))"
    return f"((atan2({y}, {x}) * 180 / pi() + 360) % 360)"


def dead_reckon_sql(lat: str, lon: str, brg: str, nm: str) -> tuple[str, str]:
    d = f"(({nm}) * 1.852 / 6371.0)"
    th, p1, l1 = _rad(brg), _rad(lat), _rad(lon)
    p2 = f"asin(sin({p1}) * cos({d}) + cos({p1}) * sin({d}) * cos({th}))"
    l2 = f"({l1} + atan2(sin({th}) * sin({d}) * cos({p1}), cos({d}) - sin({p1}) * sin({p2})))"
    return f"({p2} * 180 / pi())", f"({l2} * 180 / pi())"


def _ports_sql(head: str, ports) -> str:
    return f"{head} AS (VALUES " + ", ".join(f"('{n}', {lat}, {lon})" for n, lat, lon in ports) + ")"


MAJOR_PORTS_SQL = _ports_sql("major_ports(port, plat, plon)", MAJOR_PORTS)

SAMPLE_PORTS_SQL = _ports_sql("sample_ports(port_id, plat, plon)", SAMPLE_PORTS)

LEGS = """legs AS (
  SELECT *, lag(event_id) OVER w AS prev_event_id, lag(ts) OVER w AS prev_ts,
         lag(latitude) OVER w AS plat, lag(longitude) OVER w AS plon, lag(speed_knots) OVER w AS pspeed
  FROM positions WINDOW w AS (PARTITION BY mmsi ORDER BY ts, event_id))"""

FLEET = """fleet AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY last_updated DESC, version_key DESC) AS rn
    FROM vessel_updates) WHERE rn = 1)"""

_hours = "((epoch_us(ts) - epoch_us(prev_ts)) / 3.6e9)"
_dist = haversine_sql("plat", "plon", "latitude", "longitude")

register("nearest_port", with_(POSITIONS, MAJOR_PORTS_SQL) + f"""
SELECT event_id, nearest_port, round(port_distance_nm, 6) AS port_distance_nm FROM (
  SELECT event_id, port AS nearest_port, d AS port_distance_nm,
         row_number() OVER (PARTITION BY event_id ORDER BY d, port) AS rn
  FROM (SELECT event_id, port, {haversine_sql('latitude', 'longitude', 'plat', 'plon')} AS d
        FROM positions, major_ports)) WHERE rn = 1""")

register("track_legs", with_(POSITIONS, LEGS) + f"""
SELECT mmsi, event_id, prev_event_id, ts, round({_dist}, 6) AS distance_nm, round({_hours}, 6) AS hours,
       round(CASE WHEN {_hours} > 0 THEN {_dist} / {_hours} END, 6) AS implied_knots,
       round({bearing_sql('plat', 'plon', 'latitude', 'longitude')}, 6) AS bearing_deg
FROM legs WHERE prev_ts IS NOT NULL""")

_plat, _plon = dead_reckon_sql("plat", "plon", bearing_sql("plat", "plon", "latitude", "longitude"),
                               f"pspeed * {_hours}")
register("dead_reckon", with_(POSITIONS, LEGS) + f"""
SELECT mmsi, event_id, ts, round({_plat}, 6) AS predicted_lat, round({_plon}, 6) AS predicted_lon,
       round({haversine_sql(_plat, _plon, 'latitude', 'longitude')}, 6) AS error_nm,
       {haversine_sql(_plat, _plon, 'latitude', 'longitude')} > 50.0 AS outlier
FROM legs WHERE prev_ts IS NOT NULL""")

register("port_stay", with_(POSITIONS) + """,
r AS (SELECT *, status IN ('AT_ANCHOR', 'MOORED') AS rest FROM positions),
c AS (SELECT *, CASE WHEN lag(rest) OVER w IS NULL OR lag(rest) OVER w <> rest THEN 1 ELSE 0 END AS chg
      FROM r WINDOW w AS (PARTITION BY mmsi ORDER BY ts, event_id)),
g AS (SELECT *, sum(chg) OVER (PARTITION BY mmsi ORDER BY ts, event_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM c),
s AS (SELECT mmsi, run, min(ts) AS stay_start, max(ts) AS stay_end, count(*) AS fixes
      FROM g WHERE rest GROUP BY mmsi, run)
SELECT mmsi, stay_start, stay_end, fixes,
       round((epoch_us(stay_end) - epoch_us(stay_start)) / 3.6e9, 6) AS duration_hours,
       (epoch_us(stay_end) - epoch_us(stay_start)) / 3.6e9 >= 12 AS complete
FROM s""")

register("event_position_match", with_(POSITIONS, PORT_EVENTS, SAMPLE_PORTS_SQL) + f""",
m AS (
  SELECT e.event_id, e.vessel_mmsi, e.event_time, e.port_id, p.event_id AS fix_id, p.latitude, p.longitude,
         abs(epoch_us(p.ts) - epoch_us(e.event_time)) AS dt
  FROM port_events e JOIN positions p
    ON p.mmsi = e.vessel_mmsi AND p.event_id <> e.event_id
   AND abs(epoch_us(p.ts) - epoch_us(e.event_time)) <= 21600000000
  WHERE e.event_type = 'ARRIVAL'),
b AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY dt, fix_id) AS rn FROM m)
SELECT event_id, vessel_mmsi, event_time, b.port_id, fix_id, dt / 1e6 AS dt_seconds,
       round({haversine_sql('latitude', 'longitude', 'plat', 'plon')}, 6) AS distance_nm
FROM b JOIN sample_ports s ON s.port_id = b.port_id WHERE rn = 1""")

register("join_synced_tables", with_(POSITIONS, VESSEL_UPDATES, FLEET) + """
SELECT p.*, f.vessel_type AS meta_vessel_type, f.flag, f.status AS meta_status, f.length
FROM positions p LEFT JOIN fleet f ON p.mmsi = f.mmsi""")

register("status_from_event", with_(PORT_EVENTS) + """
SELECT *, coalesce(CASE event_type WHEN 'ARRIVAL' THEN 'Arriving' WHEN 'DEPARTURE' THEN 'Departing'
  WHEN 'BERTHED' THEN 'Moored' WHEN 'ANCHORED' THEN 'At anchor'
  WHEN 'UNDERWAY' THEN 'Under way using engine' END, 'Unknown') AS status FROM port_events""")

register("event_transition_check", with_(PORT_EVENTS) + """,
t AS (SELECT *, coalesce(lag(event_type) OVER (PARTITION BY vessel_mmsi ORDER BY event_time, event_id),
                         'UNDERWAY') AS prev_event_type FROM port_events)
SELECT event_id, vessel_mmsi, event_time, prev_event_type, event_type,
       CASE prev_event_type
         WHEN 'UNDERWAY' THEN event_type IN ('ARRIVAL', 'ANCHORED')
         WHEN 'ARRIVAL' THEN event_type IN ('BERTHED')
         WHEN 'BERTHED' THEN event_type IN ('DEPARTURE')
         WHEN 'ANCHORED' THEN event_type IN ('UNDERWAY', 'ARRIVAL')
         WHEN 'DEPARTURE' THEN event_type IN ('UNDERWAY')
         ELSE event_type IN ('ARRIVAL') END AS legal
FROM t""")

register("port_calls", with_(PORT_EVENTS) + """,
c AS (SELECT *, CAST(sum(CASE WHEN event_type = 'ARRIVAL' THEN 1 ELSE 0 END)
          OVER (PARTITION BY vessel_mmsi ORDER BY event_time, event_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS call_no FROM port_events),
g AS (SELECT vessel_mmsi, call_no,
             min(CASE WHEN event_type = 'ARRIVAL' THEN event_time END) AS arrived_at,
             arg_min(CASE WHEN event_type = 'ARRIVAL' THEN port_id END,
                     CASE WHEN event_type = 'ARRIVAL' THEN event_time END) AS port_id,
             min(CASE WHEN event_type = 'BERTHED' THEN event_time END) AS berthed_at,
             min(CASE WHEN event_type = 'DEPARTURE' THEN event_time END) AS departed_at,
             count(*) AS events
      FROM c WHERE call_no > 0 GROUP BY vessel_mmsi, call_no)
SELECT *, round((epoch_us(departed_at) - epoch_us(arrived_at)) / 3.6e9, 6) AS dwell_hours FROM g""")

register("port_event_stats", with_(PORT_EVENTS) + """
SELECT CASE WHEN grouping(event_type) = 0 THEN 'type' WHEN grouping(port_id) = 0 THEN 'port'
            WHEN grouping(vessel_mmsi) = 0 THEN 'vessel' ELSE 'total' END AS dimension,
       coalesce(event_type, port_id, CAST(vessel_mmsi AS VARCHAR)) AS key,
       count(*) AS events, min(event_time) AS first_event, max(event_time) AS last_event,
       (epoch_us(max(event_time)) - epoch_us(min(event_time))) // 1000 AS duration_ms
FROM port_events GROUP BY GROUPING SETS ((), (event_type), (port_id), (vessel_mmsi))""")

register("latest_by_key", with_(VESSEL_UPDATES, FLEET) + """
SELECT mmsi, last_updated, version_key, status, owner, home_port, vessel_type, flag, length, beam, year_built
FROM fleet""")

register("attribute_changes", with_(VESSEL_UPDATES) + """,
v AS (SELECT mmsi, version_key, last_updated, status, owner, home_port,
             lag(version_key) OVER w AS pk, lag(status) OVER w AS ps, lag(owner) OVER w AS po,
             lag(home_port) OVER w AS ph, lead(last_updated) OVER w AS valid_to
      FROM vessel_updates WINDOW w AS (PARTITION BY mmsi ORDER BY last_updated, version_key)),
x AS (SELECT *, concat_ws(',', CASE WHEN status IS DISTINCT FROM ps THEN 'status' END,
                               CASE WHEN owner IS DISTINCT FROM po THEN 'owner' END,
                               CASE WHEN home_port IS DISTINCT FROM ph THEN 'home_port' END) AS chg FROM v)
SELECT mmsi, version_key, last_updated AS valid_from, valid_to, status, owner, home_port,
       CASE WHEN pk IS NULL THEN 'initial' WHEN chg = '' THEN NULL ELSE chg END AS changed_fields
FROM x""")

register("fleet_stats", with_(VESSEL_UPDATES, FLEET) + """
SELECT CASE WHEN grouping(vessel_type) = 0 THEN 'type' WHEN grouping(flag) = 0 THEN 'flag' ELSE 'total' END
         AS dimension,
       coalesce(vessel_type, flag) AS key, count(*) AS vessels,
       CAST(coalesce(floor(avg(2024 - year_built)), 0) AS BIGINT) AS avg_age,
       CAST(coalesce(floor(avg(length)), 0) AS BIGINT) AS avg_length,
       min(last_updated) AS first_update, max(last_updated) AS last_update
FROM fleet GROUP BY GROUPING SETS ((), (vessel_type), (flag))""")

register("tonnage_columns", with_(VESSEL_UPDATES, FLEET) + """
SELECT mmsi, vessel_type, length, beam, CAST(floor(0.2::DOUBLE * length * beam * 10) AS BIGINT) AS gross_tonnage,
       CAST(floor(length * coalesce(CASE vessel_type WHEN 'Container Ship' THEN 1.5 WHEN 'Bulk Carrier' THEN 2.0
         WHEN 'Tanker' THEN 2.5 WHEN 'Cargo Ship' THEN 1.2 WHEN 'Passenger Ship' THEN 0.5
         WHEN 'Fishing Vessel' THEN 0.3 WHEN 'Tug' THEN 0.2 WHEN 'Naval Vessel' THEN 0.8
         WHEN 'Yacht' THEN 0.1 WHEN 'Other' THEN 1.0 END::DOUBLE, 1.0::DOUBLE) * 10) AS BIGINT) AS deadweight
FROM fleet""")


# ------------------------------------------------------------ sync and control

def _lag(ts: str, as_of: str = AS_OF) -> str:
    return f"((epoch_us(TIMESTAMP '{as_of}') - epoch_us({ts})) / 1e6)"


def _phase(lag: str) -> str:
    return f"(CASE WHEN {lag} > 3600 THEN 'initial' WHEN {lag} > 300 THEN 'catchup' ELSE 'steady' END)"


def _batch(phase: str, initial: int = 10000) -> str:
    return f"(CASE {phase} WHEN 'initial' THEN {initial} WHEN 'catchup' THEN 1000 WHEN 'steady' THEN 500 ELSE 1000 END)"


def _poll(phase: str) -> str:
    return f"(CASE {phase} WHEN 'initial' THEN 1 WHEN 'catchup' THEN 5 WHEN 'steady' THEN 30 ELSE 10 END)"


def _cp_rows(table_id: str, table: str, ts: str, n: int) -> str:
    return (f"SELECT '{table_id}' AS table_id, CAST({fp_shard_sql(ts, n)} AS INTEGER) AS node_id, max({ts}) AS last_timestamp, "
            f"count(*) AS n, CAST({n} AS INTEGER) AS n_shards FROM {table} WHERE {ts} IS NOT NULL GROUP BY 2")


def checkpoints_sql(as_of: str = AS_OF) -> str:
    raw = " UNION ALL ".join([_cp_rows("events", "events", "ts", 3), _cp_rows("orders", "orders", "o_orderdate", 2),
                              _cp_rows("lineitem", "lineitem", "l_shipdate", 4)])
    ph = _phase(_lag("last_timestamp", as_of))
    return f"""cps AS (
  SELECT table_id || '_' || CAST(node_id AS VARCHAR) AS checkpoint_id, table_id, node_id, last_timestamp,
         n AS records_ingested, n AS records_pulled, TIMESTAMP '{as_of}' AS last_sync_time,
         {ph} AS phase, {_batch(ph)} AS batch_size, CAST(1 AS BIGINT) AS seq, n_shards
  FROM ({raw}))"""


CPS = checkpoints_sql()
SPECS = """specs(table_id, n_shards) AS (VALUES ('events', 3), ('orders', 2), ('lineitem', 4), ('pending', 1))"""
SHARDS = """shards AS (SELECT table_id, n_shards, CAST(r.range AS INTEGER) AS node_id FROM specs, range(n_shards) r)"""
TARGET = target_sql()
SOURCE = source_keyed_sql()

register("incremental_sync", with_(FEED, TARGET) + "SELECT * FROM target")
register("dedupe_replay", with_(FEED, TARGET) + "SELECT * FROM target")
register("keyed_write", with_(FEED, TARGET) + "SELECT * FROM target")
register("stamp_synced", with_(SOURCE) + f"SELECT *, TIMESTAMP '{AS_OF}' AS _synced_at FROM source")
register("quarantine_split", with_(FEED) + "SELECT event_id, CASE WHEN ts IS NULL THEN 'missing_ts' END AS reason FROM feed")
register("quarantine_log", with_(FEED) + """
SELECT 'events' AS table_id, 0 AS node_id, 'skipped' AS status, 'missing_ts' AS reason, event_id
FROM feed WHERE ts IS NULL""")
register("skip_summary", with_(FEED) + """
SELECT 'events' AS table_id, 'missing_ts' AS reason, count(*) AS skipped FROM feed WHERE ts IS NULL""")
register("ingest_totals", with_(FEED) + f""",
s AS (SELECT CAST(CASE WHEN ts IS NULL THEN 0 ELSE {fp_shard_sql('ts', 3)} END AS INTEGER) AS node_id, ts FROM feed)
SELECT 'events' AS table_id, node_id, count(*) AS records_pulled, count(ts) AS records_ingested,
       count(*) - count(ts) AS records_quarantined, CAST(1 AS BIGINT) AS batches
FROM s GROUP BY node_id""")
register("advance_checkpoint", with_(CPS) + "SELECT * FROM cps")

_ph_new = _phase(_lag("last_timestamp"))
register("upsert_checkpoint", with_(CPS) + f""",
o AS (SELECT CAST({fp_shard_sql('ts', 3)} AS INTEGER) AS node_id, max(ts) AS mts, count(*) AS n FROM events
      WHERE ts < TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1),
nw AS (SELECT CAST({fp_shard_sql('ts', 3)} AS INTEGER) AS node_id, max(ts) AS mts, count(*) AS n FROM events
       WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1),
e AS (SELECT 'events_' || CAST(node_id AS VARCHAR) AS checkpoint_id, 'events' AS table_id, node_id,
             greatest(nw.mts, o.mts) AS last_timestamp, o.n + nw.n AS records_ingested,
             o.n + nw.n AS records_pulled, TIMESTAMP '{AS_OF}' AS last_sync_time FROM nw JOIN o USING (node_id))
SELECT *, {_ph_new} AS phase, {_batch(_ph_new)} AS batch_size, CAST(2 AS BIGINT) AS seq,
       CAST(3 AS INTEGER) AS n_shards FROM e
UNION ALL SELECT * FROM cps WHERE table_id <> 'events'""")

register("load_checkpoint", with_(CPS) + """
SELECT 'lineitem' AS table_id, CAST(range AS INTEGER) AS node_id,
       (SELECT min(last_timestamp) FROM cps WHERE table_id = 'lineitem') AS cursor, false AS restarted,
       CAST(0 AS BIGINT) AS records_ingested, CAST(0 AS BIGINT) AS records_pulled
FROM range(6)""")
register("load_checkpoint_same_layout", with_(CPS) + """
SELECT 'events' AS table_id, s.node_id, coalesce(c.last_timestamp, TIMESTAMP '1970-01-01 00:00:00') AS cursor,
       c.last_timestamp IS NULL AS restarted, coalesce(c.records_ingested, 0) AS records_ingested,
       coalesce(c.records_pulled, 0) AS records_pulled
FROM (SELECT CAST(range AS INTEGER) AS node_id FROM range(3)) s
LEFT JOIN cps c ON c.table_id = 'events' AND c.node_id = s.node_id AND c.node_id <> 1""")

_L = _lag("last_timestamp")
register("lag_view", with_(CPS) + f"""
SELECT checkpoint_id, table_id, node_id, last_timestamp, round({_L}, 3) AS lag_seconds, {_phase(_L)} AS phase,
       {_batch(_phase(_L))} AS batch_size, {_poll(_phase(_L))} AS poll_interval_s FROM cps""")
register("sync_phase", with_(CPS) + f"""
SELECT checkpoint_id, round({_L}, 3) AS lag_seconds, {_phase(_L)} AS phase FROM cps""")
register("batch_size", with_(CPS) + f"""
SELECT checkpoint_id, {_phase(_L)} AS phase,
       CASE WHEN table_id = 'orders' THEN {_batch(_phase(_L), 5000)} ELSE {_batch(_phase(_L))} END AS batch_size
FROM cps""")
register("poll_interval", with_(CPS) + f"""
SELECT checkpoint_id, {_phase(_L)} AS phase, {_poll(_phase(_L))} AS poll_interval_s FROM cps""")
register("checkpoint_listing", with_(CPS) + "SELECT * FROM cps ORDER BY table_id, node_id")
register("status_view", with_(CPS, SPECS, SHARDS) + f"""
SELECT s.table_id, s.node_id, s.n_shards AS cluster_size,
       CASE WHEN c.last_timestamp IS NULL THEN 'initial' ELSE {_phase(_L)} END AS phase,
       c.last_timestamp AS cursor, round({_L}, 3) AS lag_seconds
FROM shards s LEFT JOIN cps c ON c.table_id = s.table_id AND c.node_id = s.node_id""")

_since = f"((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(sync_time)) / 1000)"
PROGRESS = f"""progress AS (
  SELECT s.table_id, s.node_id, 'progress' AS "check",
         CASE WHEN sync_time IS NULL THEN 'no_checkpoint' WHEN {_since} > 600000 THEN 'stalled'
              WHEN {_L} > 3600 THEN 'severely_lagging' WHEN {_L} > 300 THEN 'lagging' ELSE 'healthy' END AS status,
         round({_L}, 3) AS lag_seconds, records_ingested, phase
  FROM shards s LEFT JOIN (
    SELECT *, CASE WHEN checkpoint_id = 'lineitem_1' THEN TIMESTAMP '2024-01-30 23:49:00'
                   ELSE last_sync_time END AS sync_time FROM cps) c
    ON c.table_id = s.table_id AND c.node_id = s.node_id)"""
register("progress_check", with_(CPS, SPECS, SHARDS, PROGRESS) + "SELECT * FROM progress")

_FRESH_AS_OF = "2024-01-30 23:59:00"


def _fresh(table_id: str, table: str, ts: str) -> str:
    lat = f"max({ts}) FILTER (WHERE {ts} > TIMESTAMP '{_FRESH_AS_OF}' - INTERVAL 5 MINUTE)"
    return (f"SELECT '{table_id}' AS table_id, 'smoke_test' AS \"check\", "
            f"CASE WHEN {lat} IS NULL THEN 'no_recent_data' ELSE 'healthy' END AS status, "
            f"{lat} AS latest_timestamp, round({_lag(lat, _FRESH_AS_OF)}, 3) AS lag_seconds FROM {table}")


FRESH = ("fresh AS (" + " UNION ALL ".join([
    _fresh("events", "events", "ts"), _fresh("orders", "orders", "o_orderdate"),
    _fresh("lineitem", "lineitem", "l_shipdate"),
    "SELECT 'pending', 'smoke_test', 'table_not_found', NULL::TIMESTAMP, NULL::DOUBLE"]) + ")")
register("freshness_check", with_(FRESH) + "SELECT * FROM fresh")

register("phantom_records", with_(FEED, TARGET, SOURCE) + """
SELECT id, ts, 'phantom_record' AS issue FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.id = t.id)""")
register("missing_records", with_(FEED, TARGET, SOURCE) + """
SELECT id, ts, 'missing_record' AS issue FROM source s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE s.id = t.id)""")
register("full_reconcile", with_(FEED, TARGET, SOURCE) + """
SELECT coalesce(s.id, t.id) AS id, coalesce(s.ts, t.ts) AS ts,
       CASE WHEN s.id IS NULL THEN 'phantom_record' WHEN t.id IS NULL THEN 'missing_record' ELSE 'ok' END AS status
FROM source s FULL OUTER JOIN target t ON s.id = t.id""")

register("bucketed_reconcile", with_(FEED, TARGET, SOURCE) + """
SELECT coalesce(s.id, t.id) AS id, coalesce(s.ts, t.ts) AS ts,
       CASE WHEN s.id IS NULL THEN 'phantom_record' WHEN t.id IS NULL THEN 'missing_record' ELSE 'ok' END AS status
FROM (SELECT id, max(ts) AS ts FROM source GROUP BY id) s
FULL OUTER JOIN (SELECT id, max(ts) AS ts FROM target GROUP BY id) t ON s.id = t.id""")

SPOT = f"""ts5 AS (SELECT id, ts FROM target ORDER BY ts DESC, id DESC LIMIT 5),
ss AS (SELECT id, ts FROM source WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 36 HOUR ORDER BY ts, id LIMIT 50),
spot AS (
  SELECT 'events' AS table_id, 'spot_check' AS "check",
         CASE WHEN (SELECT count(*) FROM ts5) = 0 THEN 'no_data'
              WHEN ph + mi = 0 THEN 'healthy' ELSE 'issues_found' END AS status,
         (SELECT count(*) FROM ts5) + (SELECT count(*) FROM ss) AS samples_checked,
         ph AS phantom_records, mi AS missing_records
  FROM (SELECT (SELECT count(*) FROM ts5 WHERE id NOT IN (SELECT id FROM source)) AS ph,
               (SELECT count(*) FROM ss WHERE id NOT IN (SELECT id FROM target)) AS mi))"""
register("sampled_differences", with_(FEED, TARGET, SOURCE) + """,
ranked AS (
  SELECT id, ts, side, ('0x' || substr(sha256('0:' || id::VARCHAR), 1, 15))::BIGINT AS r
  FROM (SELECT id, ts, 's' AS side FROM source UNION ALL SELECT id, ts, 't' FROM target)),
sampled AS (SELECT * FROM ranked WHERE r <= (SELECT max(r) FROM (SELECT r FROM ranked ORDER BY r LIMIT 4000)))
SELECT id, max(ts) AS ts, CASE WHEN min(side) = 't' THEN 'phantom_record' ELSE 'missing_record' END AS issue
FROM sampled GROUP BY id HAVING count(DISTINCT side) = 1""")
register("spot_check", with_(FEED, TARGET, SOURCE, SPOT) + "SELECT * FROM spot")

register("count_drift", with_(FEED, TARGET) + f""",
s AS (SELECT {fp_shard_sql('ts', 3)} AS shard, count(*) AS source_count FROM events WHERE ts IS NOT NULL GROUP BY 1),
t AS (SELECT {fp_shard_sql('ts', 3)} AS shard, count(*) AS target_count FROM target GROUP BY 1)
SELECT coalesce(s.shard, t.shard) AS shard, coalesce(source_count, 0) AS source_count,
       coalesce(target_count, 0) AS target_count,
       abs(coalesce(source_count, 0) - coalesce(target_count, 0)) AS delta,
       CASE WHEN abs(coalesce(source_count, 0) - coalesce(target_count, 0)) < 30 THEN 'ok'
            WHEN abs(coalesce(source_count, 0) - coalesce(target_count, 0)) > 40 THEN 'alert' ELSE 'drift' END AS status
FROM s FULL OUTER JOIN t ON s.shard = t.shard""")

register("late_rows", with_(FEED, TARGET, SOURCE) + """
SELECT id, event_id, ts FROM source s
WHERE ts > TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 2 DAY AND ts <= TIMESTAMP '2024-01-20 00:00:00'
  AND NOT EXISTS (SELECT 1 FROM target t WHERE t.id = s.id)""")

CHECKS = """checks AS (
  SELECT table_id, 'progress' AS "check",
         CASE WHEN bool_and(status = 'healthy') THEN 'healthy' ELSE 'lagging' END AS status
  FROM progress WHERE table_id <> 'pending' GROUP BY table_id
  UNION ALL SELECT table_id, "check", status FROM fresh
  UNION ALL SELECT table_id, "check", status FROM spot)"""
register("health_rollup", with_(FEED, TARGET, SOURCE, SPOT, CPS, SPECS, SHARDS, PROGRESS, FRESH, CHECKS) + """,
pt AS (SELECT table_id, bool_and(status IN ('healthy', 'ok')) AS ok, count(*) AS checks FROM checks GROUP BY table_id)
SELECT table_id, checks, CASE WHEN ok THEN 'healthy' ELSE 'issues_detected' END AS overall_status FROM pt
UNION ALL
SELECT NULL, CAST(sum(checks) AS BIGINT), CASE WHEN bool_and(ok) THEN 'healthy' ELSE 'issues_detected' END FROM pt""")

_ALERT_AS_OF = "2024-01-31 00:10:00"
register("alerts", with_(FEED, TARGET, CPS, SPECS, SHARDS, PROGRESS.replace(
    "WHEN checkpoint_id = 'lineitem_1' THEN TIMESTAMP '2024-01-30 23:49:00'", "WHEN FALSE THEN NULL")) + f""",
s AS (SELECT {fp_shard_sql('ts', 3)} AS shard, count(*) AS sc FROM events WHERE ts IS NOT NULL GROUP BY 1),
t AS (SELECT {fp_shard_sql('ts', 3)} AS shard, count(*) AS tc FROM target GROUP BY 1),
drift AS (SELECT coalesce(s.shard, t.shard) AS shard, abs(coalesce(sc, 0) - coalesce(tc, 0)) AS delta
          FROM s FULL OUTER JOIN t ON s.shard = t.shard)
SELECT NULL AS table_id, CAST(shard AS INTEGER) AS node_id, 'count_drift' AS alert, CAST(delta AS DOUBLE) AS value FROM drift
WHERE delta > 1000
UNION ALL
SELECT table_id, node_id, 'lag', CAST(lag_seconds AS DOUBLE) FROM progress WHERE lag_seconds > 1800
UNION ALL
SELECT table_id, node_id, 'no_checkpoint_update',
       (epoch_us(TIMESTAMP '{_ALERT_AS_OF}') - epoch_us(last_sync_time)) / 1e6 FROM cps
WHERE (epoch_us(TIMESTAMP '{_ALERT_AS_OF}') - epoch_us(last_sync_time)) / 1e6 > 300""")

register("shard_balance", """
WITH c AS (SELECT epoch_us(ts) % 3 AS shard, count(*) AS rows FROM events GROUP BY 1),
a AS (SELECT r.range AS shard, coalesce(c.rows, 0) AS rows FROM range(3) r LEFT JOIN c ON c.shard = r.range),
m AS (SELECT *, sum(rows) OVER () / 3.0 AS share FROM a)
SELECT shard, rows, round(CASE WHEN share > 0 THEN abs(rows - share) / share ELSE 0 END, 6) AS deviation,
       CASE WHEN share > 0 THEN abs(rows - share) / share ELSE 0 END <= 0.10 AS balanced FROM m""")

register("multi_table_sync", """
SELECT 'events' AS table_id, 'ok' AS status, count(*) AS pulled, count(*) AS written,
       CAST(0 AS BIGINT) AS quarantined, CAST(NULL AS VARCHAR) AS error FROM events
UNION ALL SELECT 'orders', 'ok', count(*), count(*), 0, NULL FROM orders
UNION ALL SELECT 'lineitem', 'ok', count(*), count(*), 0, NULL FROM lineitem""")

register("audit_recent", with_(FEED) + f"""
SELECT 'events' AS table_id, 'skipped' AS status, 'missing_ts' AS reason, TIMESTAMP '{AS_OF}' AS timestamp
FROM feed WHERE ts IS NULL""")


# ------------------------------------------------------------ profiles

register("count_partition", "SELECT epoch_us(ts) % 4 AS shard, count(*) AS rows FROM events GROUP BY 1")
register("table_profile", with_(POSITIONS) + """
SELECT count(*) AS total_records, count(DISTINCT mmsi) AS unique_vessels, count(DISTINCT vessel_type) AS vessel_types,
       min(ts) AS oldest_record, max(ts) AS newest_record,
       count(DISTINCT (latitude, longitude)) AS unique_positions FROM positions""")


register("daily_profile", with_(POSITIONS) + """
SELECT count(*) AS total_records, min(ts) AS oldest_record, max(ts) AS newest_record, true AS unique_vessels_close,
       true AS vessel_types_close, true AS unique_positions_close
FROM positions WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 10 DAYS""")


def _range(table: str, ts: str, name: str | None = None) -> str:
    head = f"'{name}' AS table_name, " if name else ""
    return (f"SELECT {head}min({ts}) AS oldest, max({ts}) AS newest, count(*) AS total_records, "
            f"count(*) > 0 AS has_data, "
            f"coalesce(CAST(floor((epoch_us(max({ts})) - epoch_us(min({ts}))) / 86400000000) AS BIGINT), 0) "
            f"AS days_covered FROM {table}")


register("data_range", _range("events", "ts"))
RANGES = ("ranges AS (" + " UNION ALL ".join([
    _range("events", "ts", "events"), _range("orders", "o_orderdate", "orders"),
    _range("lineitem", "l_shipdate", "lineitem"),
    "SELECT 'vessel_metadata', NULL::TIMESTAMP, NULL::TIMESTAMP, 0, false, 0"]) + ")")
register("verify_tables", with_(RANGES) + """
SELECT *, table_name = 'vessel_metadata' AS failed FROM ranges""")
register("type_distribution", with_(POSITIONS) + "SELECT vessel_type, count(*) AS count FROM positions GROUP BY 1")
register("active_by_type", with_(POSITIONS) + f"""
SELECT vessel_type, count(DISTINCT mmsi) AS vessel_count, round(avg(speed_knots), 6) AS avg_speed FROM positions
WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 6 HOUR GROUP BY 1""")
register("count_avg_by_type", with_(POSITIONS) + f"""
SELECT vessel_type, count(*) AS count, round(avg(speed_knots), 6) AS avg_speed FROM positions
WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 6 HOUR GROUP BY 1""")
register("port_activity_topk", with_(POSITIONS) + f"""
SELECT destination AS port, count(*) AS vessel_count FROM positions
WHERE status IN ('AT_ANCHOR', 'MOORED') AND ts >= TIMESTAMP '{AS_OF}' - INTERVAL 3 DAY
GROUP BY 1 ORDER BY vessel_count DESC, port LIMIT 10""")

# ------------------------------------------------------------ sinks and conversion

register("append_load", "SELECT * FROM events")
register("strict_stream_append", "SELECT * FROM events")
register("insert_method", "SELECT * FROM events")
register("create_partitioned_table", """
SELECT *, CAST(ts AS DATE) AS _day FROM events
WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-12 00:00:00'""")
register("truncate_keep_schema", """
SELECT count(*) AS rows_before, CAST(0 AS BIGINT) AS rows_after, CAST(6 AS BIGINT) AS columns_kept FROM events""")
register("drop_table", """
SELECT count(*) AS rows_before, CAST(0 AS BIGINT) AS rows_after FROM events""")
register("sync_batches", with_(FEED) + """
SELECT 'events' AS table_id, count(*) AS rows_pulled, count(ts) AS rows_valid, CAST(1 AS BIGINT) AS batches FROM feed""")
register("retention_all", f"""
SELECT t AS table_name, TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY AS cutoff,
       count(*) FILTER (WHERE ts < TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY) AS deleted, CAST(NULL AS VARCHAR) AS error
FROM events, (VALUES ('by_day'), ('by_month')) v(t) GROUP BY t""")

_TS_BACK = """CASE WHEN event_id % 3 = 0 THEN ts
            WHEN event_id % 3 = 1 THEN make_timestamp((epoch_us(ts) // 1000) * 1000)
            ELSE date_trunc('second', ts) END"""
register("type_projection", f"""
SELECT event_id, {_TS_BACK} AS ts, user_id, event_type,
       CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(value AS DECIMAL(38,9)) END AS value, props,
       CASE WHEN event_id % 50 = 0 THEN 'value' END AS _conversion_error
FROM events""")
register("normalize_ts", f"""
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE {_TS_BACK} END AS ts_norm FROM events""")

# ------------------------------------------------------------ coverage and windows

register("retention_delete", f"SELECT * FROM events WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY")
register("range_retained", f"SELECT * FROM events WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY")
register("backfill_plan", with_(RANGES) + f""",
p AS (SELECT table_name, has_data, oldest,
             CASE WHEN NOT has_data THEN 40 WHEN 40 - days_covered > 1 THEN floor(40 - days_covered) END AS days
      FROM ranges)
SELECT table_name, CASE WHEN days IS NULL THEN 'none' ELSE 'backfill' END AS action,
       CASE WHEN days IS NOT NULL THEN
         (CASE WHEN NOT has_data THEN TIMESTAMP '{AS_OF}' ELSE oldest END) - to_days(CAST(days AS INTEGER)) END
         AS backfill_from,
       CASE WHEN days IS NOT NULL THEN (CASE WHEN NOT has_data THEN TIMESTAMP '{AS_OF}' ELSE oldest END) END
         AS backfill_to,
       CAST(coalesce(days, 0) AS BIGINT) AS days
FROM p""")


def _window_keep(first_ts: str, target_days: int) -> str:
    return f"""r AS (SELECT min(ts) AS oldest,
                  floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 86400000000) AS dc
           FROM events WHERE ts >= TIMESTAMP '{first_ts}'),
lo AS (SELECT CASE WHEN {target_days} - dc > 1
                   THEN oldest - to_days(CAST(floor({target_days} - dc) AS INTEGER)) ELSE oldest END AS lo FROM r)"""


register("backfill_load", with_(SOURCE, _window_keep("2024-01-15 00:00:00", 30)) + """
SELECT id, event_id, ts FROM source WHERE ts >= (SELECT lo FROM lo)""")
register("rolling_window", with_(SOURCE, _window_keep("2024-01-20 00:00:00", 15)) + f"""
SELECT id, event_id, ts FROM source
WHERE ts >= (SELECT lo FROM lo) AND ts >= TIMESTAMP '{AS_OF}' - INTERVAL 15 DAY""")
register("coverage_gaps", """
SELECT CAST(d AS DATE) AS day FROM range(TIMESTAMP '1994-12-25', TIMESTAMP '2001-08-11', INTERVAL 1 DAY) t(d)
WHERE CAST(d AS DATE) NOT IN (SELECT DISTINCT CAST(o_orderdate AS DATE) FROM orders)""")
register("apply_migration", """
SELECT event_id, ts, user_id, event_type, value, props, NULL::VARCHAR AS value_v2, NULL::BIGINT AS k
FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00'
UNION ALL
SELECT event_id, ts, user_id, event_type, NULL, props, CAST(value AS VARCHAR),
       CAST(json_extract_string(props, '$.k') AS BIGINT)
FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'""")

register("evolving_sync", """
SELECT event_id, ts, user_id, event_type, props,
       CASE WHEN ts < TIMESTAMP '2024-01-10' THEN value END AS value,
       CASE WHEN ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' THEN CAST(value AS VARCHAR) END AS value_v2,
       CASE WHEN ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'
            THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
       CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN CAST(floor(value * 1000) AS BIGINT) END AS value_v3
FROM (SELECT * REPLACE (CASE WHEN ts < TIMESTAMP '2024-01-20' THEN props END AS props) FROM events)
WHERE ts IS NOT NULL""")

# ------------------------------------------------------------ streaming

register("stream_sync", with_(FEED, TARGET) + "SELECT * FROM target")
_RATE = """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR
       AS window_end, count(*) AS events FROM events WHERE ts IS NOT NULL GROUP BY 1, 2"""
register("rate_by_interval", _RATE)
register("rate_by_interval_stream", _RATE)


# ------------------------------------------------------------ geometry columns and monitoring

register("haversine_nm", with_(POSITIONS) + f"""
SELECT event_id, round({haversine_sql('latitude', 'longitude', '1.2644', '103.8223')}, 6) AS distance_nm
FROM positions""")
register("bearing_deg", with_(POSITIONS) + f"""
SELECT event_id, round({bearing_sql('latitude', 'longitude', '1.2644', '103.8223')}, 6) AS bearing_deg
FROM positions""")

_SHARD_LAST = f"""sl AS (SELECT {fp_shard_sql('ts', 3)} AS node_id, max(ts) AS last_ts FROM feed
       WHERE ts IS NOT NULL GROUP BY 1)"""
register("monitoring_aggregates", with_(FEED, _SHARD_LAST) + f"""
SELECT 'errors_by_table' AS metric, 'events' AS key, CAST(count(*) AS DOUBLE) AS value FROM feed WHERE ts IS NULL
UNION ALL
SELECT 'batches_by_phase', {_phase(_lag('last_ts'))}, CAST(count(*) AS DOUBLE) FROM sl GROUP BY 2
UNION ALL
SELECT 'avg_lag_by_shard', CAST(node_id AS VARCHAR), round({_lag('last_ts')}, 3) FROM sl""")


# ------------------------------------------------------------ validation plan checks

_FEED_KEYED = f"""fk AS (SELECT {record_id_sql('ts')} AS id, ts FROM feed)"""
register("validation_checks", with_(FEED, TARGET, _FEED_KEYED) + f""",
sl AS (SELECT {fp_shard_sql('ts', 3)} AS node_id, max(ts) AS last_ts FROM feed WHERE ts IS NOT NULL GROUP BY 1),
p AS (SELECT CASE WHEN {_lag('last_ts')} > 3600 THEN 2 WHEN {_lag('last_ts')} > 300 THEN 1 ELSE 0 END AS sev FROM sl),
t5 AS (SELECT id, ts FROM target ORDER BY ts DESC, id DESC LIMIT 5),
s5 AS (SELECT id, ts FROM fk WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR ORDER BY ts, id LIMIT 5),
sp AS (SELECT (SELECT count(*) FROM t5) AS tn,
              (SELECT count(*) FROM t5 WHERE id NOT IN (SELECT id FROM fk)) +
              (SELECT count(*) FROM s5 WHERE id NOT IN (SELECT id FROM target)) AS issues)
SELECT 'events' AS table_id, 'progress' AS "check",
       CASE max(sev) WHEN 2 THEN 'severely_lagging' WHEN 1 THEN 'lagging' ELSE 'healthy' END AS status FROM p
UNION ALL
SELECT 'events', 'smoke_test',
       CASE WHEN max(ts) FILTER (WHERE ts > TIMESTAMP '{AS_OF}' - INTERVAL 5 MINUTE) IS NULL
            THEN 'no_recent_data' ELSE 'healthy' END FROM target
UNION ALL
SELECT 'events', 'spot_check', CASE WHEN tn = 0 THEN 'no_data' WHEN issues = 0 THEN 'healthy'
                                    ELSE 'issues_found' END FROM sp"""
)
