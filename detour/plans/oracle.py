"""DuckDB SQL for every registered batch query, written independently of the Spark
plans: brute force where the Spark side is clever (radius join), window functions
where it pre-limits (nearest paths)."""

from __future__ import annotations

from detour.sources.vocabulary import TUBE_LINES


def _lat(key: str, a: int) -> str:
    return f"(51.45 + (CAST(({key} * {a}) % 10007 AS DOUBLE) / CAST(10007 AS DOUBLE)) * CAST(0.1 AS DOUBLE))"


def _lon(key: str, b: int) -> str:
    return f"(CAST(-0.2 AS DOUBLE) + (CAST(({key} * {b}) % 10009 AS DOUBLE) / CAST(10009 AS DOUBLE)) * CAST(0.16 AS DOUBLE))"


def _title(x: str) -> str:
    """initcap(replace(x, '-', ' ')) in DuckDB terms, without lambda syntax."""
    return (f"(SELECT string_agg(upper(substr(w, 1, 1)) || lower(substr(w, 2)), ' ' ORDER BY i) "
            f"FROM (SELECT unnest(string_split(replace({x}, '-', ' '), ' ')) AS w, "
            f"generate_subscripts(string_split(replace({x}, '-', ' '), ' '), 1) AS i))")


def _iso(ts: str) -> str:
    return (f"CASE WHEN {ts} IS NULL THEN NULL WHEN epoch_us({ts}) % 1000000 <> 0 "
            f"THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f+00:00') "
            f"ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%S+00:00') END")


def _pystr(ts: str) -> str:
    return (f"CASE WHEN {ts} IS NULL THEN NULL WHEN epoch_us({ts}) % 1000000 <> 0 "
            f"THEN strftime({ts}, '%Y-%m-%d %H:%M:%S.%f') "
            f"ELSE strftime({ts}, '%Y-%m-%d %H:%M:%S') END")


_DIST = """CAST(12742017.6 AS DOUBLE) * asin(sqrt(least(
               pow(sin(radians(lat2 - lat1) / 2), 2)
               + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2),
               CAST(1.0 AS DOUBLE))))"""

_LISTED_EDGES = """edges AS (
  SELECT l_suppkey AS station_id, l_partkey AS stop_id, min(l_extendedprice) AS distance_metres
  FROM lineitem GROUP BY l_suppkey, l_partkey)"""

# Brute force: the distance of every supplier and part.
_RADIUS_EDGES = f"""edges AS (
  SELECT station_id, stop_id, round(dist, 3) AS distance_metres FROM (
    SELECT station_id, stop_id, {_DIST} AS dist
    FROM (SELECT s_suppkey AS station_id, {_lat('s_suppkey', 7919)} AS lat1, {_lon('s_suppkey', 6151)} AS lon1 FROM supplier),
         (SELECT p_partkey AS stop_id, {_lat('p_partkey', 4421)} AS lat2, {_lon('p_partkey', 9203)} AS lon2 FROM part))
  WHERE dist <= 300.0)"""


def _paths(listed: bool = False, gaps: bool = False) -> str:
    dist = "CASE WHEN p.p_size > 40 THEN NULL ELSE e.distance_metres END" if gaps else "e.distance_metres"
    rname = "CASE WHEN p.p_brand = 'Brand#13' THEN NULL ELSE p.p_brand END" if gaps else "p.p_brand"
    return f"""
{_LISTED_EDGES if listed else _RADIUS_EDGES},
paths AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS line_id, s.s_suppkey AS station_id, p.p_partkey AS stop_id,
         p.p_brand AS route_id, s.s_name AS station_name, p.p_name AS bus_stop_name,
         p.p_partkey AS bus_stop_id, {_lat('p.p_partkey', 4421)} AS lat, {_lon('p.p_partkey', 9203)} AS lon,
         {dist} AS distance_metres, {rname} AS route_name
  FROM nation n
  JOIN supplier s ON s.s_nationkey = n.n_nationkey
  JOIN edges e ON e.station_id = s.s_suppkey
  JOIN part p ON p.p_partkey = e.stop_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY line_id ORDER BY distance_metres ASC NULLS LAST,
                                    station_id, stop_id, route_id) AS INTEGER) AS rn
  FROM paths)"""


def _options(listed: bool = False, gaps: bool = False) -> str:
    # A null route name is one more distinct route; it sorts first, so it also takes
    # one of the ten display slots (and prints as nothing).
    return _paths(listed, gaps) + """,
capped AS (SELECT * FROM ranked WHERE rn <= 100),
opts AS (
  SELECT line_id, count(DISTINCT station_name) AS n_stations,
         count(DISTINCT route_name) + max(CASE WHEN route_name IS NULL THEN 1 ELSE 0 END) AS n_routes,
         count(*) AS n_path_rows,
         string_agg(DISTINCT station_name, '|' ORDER BY station_name) AS affected_stations,
         string_agg(DISTINCT route_name, '|' ORDER BY route_name) AS available_routes,
         array_to_string(list_slice(list_sort(list_distinct(list(route_name))), 1,
                                    10 - max(CASE WHEN route_name IS NULL THEN 1 ELSE 0 END)), '|') AS display_routes
  FROM capped GROUP BY line_id)"""


_EV = """
ev AS (
  SELECT event_id, ts, user_id % 30 AS line_id, 'LINE_' || CAST(user_id % 30 AS VARCHAR) AS line_name,
         CAST(floor(value) AS INTEGER) AS severity_code, event_type AS severity_desc, props AS disruption_detail,
         date_trunc('hour', ts) AS poll_ts
  FROM events)"""


def _alerts(min_routes: int = 3) -> str:
    return "WITH " + _options() + "," + _EV + f""",
alerts AS (
  SELECT ev.event_id, ev.ts, ev.line_id, ev.line_name, ev.severity_desc AS severity,
         (kn.n_nationkey IS NOT NULL) AS is_known_line,
         CAST(coalesce(o.n_stations, 0) AS INTEGER) AS n_stations,
         CAST(coalesce(o.n_routes, 0) AS INTEGER) AS n_routes,
         coalesce(o.n_routes, 0) < {min_routes} AS gridlock_alert,
         coalesce(o.affected_stations, '') AS affected_stations_text,
         coalesce(o.available_routes, '') AS available_routes_text,
         {_iso("ev.poll_ts")} AS ingested_at_utc, {_pystr("ev.ts")} AS processed_at_utc
  FROM ev LEFT JOIN nation kn ON kn.n_nationkey = ev.line_id
  LEFT JOIN opts o ON o.line_id = ev.line_id
  WHERE ev.severity_code < 10)
"""


def _worst() -> str:
    return """WITH st AS (
  SELECT user_id % 30 AS line_id, date_trunc('hour', ts) AS poll_ts, event_id,
         CASE WHEN event_type = 'view' THEN NULL ELSE CAST(floor(value) AS INTEGER) END AS sev,
         event_type, props
  FROM events),
r AS (
  SELECT *, row_number() OVER (PARTITION BY line_id, poll_ts ORDER BY coalesce(sev, 99), event_id) AS rn,
         count(*) OVER (PARTITION BY line_id, poll_ts) AS n_statuses
  FROM st),
w AS (
  SELECT 'tube_line_status' AS event_type, line_id, 'LINE_' || CAST(line_id AS VARCHAR) AS line_name,
         CAST(coalesce(sev, 10) AS INTEGER) AS severity_code, coalesce(event_type, 'Unknown') AS severity_desc,
         coalesce(sev, 10) < 10 AS is_disrupted, props AS disruption_detail,
         """ + _iso("poll_ts") + """ AS ingested_at_utc,
         event_id AS worst_event_id, n_statuses
  FROM r WHERE rn = 1)
"""


_LINE_OPTIONS_SELECT = """
SELECT CAST(n.n_nationkey AS BIGINT) AS line_id, n.n_name AS graph_line_name,
       CAST(coalesce(o.n_path_rows, 0) AS BIGINT) AS n_path_rows,
       CAST(coalesce(o.n_stations, 0) AS INTEGER) AS n_stations,
       CAST(coalesce(o.n_routes, 0) AS INTEGER) AS n_routes,
       coalesce(o.n_routes, 0) < 3 AS gridlock_alert,
       coalesce(o.affected_stations, '') AS affected_stations,
       coalesce(o.available_routes, '') AS available_routes,
       coalesce(o.display_routes, '') AS display_routes
FROM nation n LEFT JOIN opts o ON o.line_id = n.n_nationkey"""

_VOCAB = ", ".join(f"({i}, '{x}')" for i, x in enumerate(TUBE_LINES))

_EVENT_COLS = f"""event_id, 'tube_line_status' AS event_type, line_id, line_name, severity_code, severity_desc,
         severity_code < 10 AS is_disrupted, disruption_detail, {_iso('poll_ts')} AS ingested_at_utc"""


def oracle_sql() -> dict[str, str]:
    sql = _oracle_sql()
    # The streaming jobs, and the other ways to the same tables, must give the plain answers exactly.
    for name, plain in {"stream_disrupted": "disrupted_events", "stream_alerts": "gridlock_alerts", "stream_replay": "gridlock_alerts",
                        "history_compacted": "gridlock_alerts", "partial_summary": "alert_summary", "partial_latest": "latest_alerts",
                        "intake_stream": "intake_status_events", "edge_upsert_buckets": "edge_upsert", "line_lookup_clustered": "line_lookup",
                        "line_paths_bucketed": "line_paths"}.items():
        sql[name] = sql[plain]
    return sql


def _crowded(key: str, a: int, b: int) -> str:
    lat = f"(51.5 + (CAST(({key} * {a}) % 10007 AS DOUBLE) / CAST(10007 AS DOUBLE)) * CAST(0.004 AS DOUBLE))"
    lon = f"(CAST(-0.1 AS DOUBLE) + (CAST(({key} * {b}) % 10009 AS DOUBLE) / CAST(10009 AS DOUBLE)) * CAST(0.004 AS DOUBLE))"
    return f"CASE WHEN {key} % 3 = 0 THEN {lat} ELSE {_lat(key, a)} END, CASE WHEN {key} % 3 = 0 THEN {lon} ELSE {_lon(key, b)} END"


def _oracle_sql() -> dict[str, str]:
    a = _alerts()
    return {
        "gridlock_alerts": a + """SELECT event_id, line_id, line_name, severity, is_known_line, n_stations,
       n_routes, gridlock_alert FROM alerts""",
        "gridlock_alerts_strict": _alerts(10) + """SELECT event_id, line_id, line_name, severity, is_known_line,
       n_stations, n_routes, gridlock_alert FROM alerts""",
        "alert_options_exploded": a + """SELECT a.event_id, CAST(0 AS BIGINT) AS batch_id, a.ingested_at_utc, a.processed_at_utc,
       CAST(coalesce(r.rn - 1, -1) AS INTEGER) AS pos, r.station_name, r.bus_stop_name, coalesce(r.bus_stop_id, -1) AS bus_stop_id, r.lat, r.lon,
       r.distance_metres, r.route_name
FROM alerts a LEFT JOIN (SELECT * FROM ranked WHERE rn <= 20) r ON r.line_id = a.line_id""",
        "history_options_exploded": a + """SELECT a.event_id, CAST(0 AS BIGINT) AS batch_id, a.ingested_at_utc, a.processed_at_utc,
       a.processed_at_utc AS event_hub_time,
       CAST(coalesce(r.rn - 1, -1) AS INTEGER) AS pos, r.station_name, r.bus_stop_name, coalesce(r.bus_stop_id, -1) AS bus_stop_id, r.lat, r.lon,
       r.distance_metres, r.route_name
FROM alerts a LEFT JOIN (SELECT * FROM ranked WHERE rn <= 20) r ON r.line_id = a.line_id""",
        "disrupted_events": "WITH " + _EV.strip() + f"""
SELECT {_EVENT_COLS} FROM ev WHERE severity_code < 10""",
        "worst_status": _worst() + "SELECT * FROM w",
        "document_status_events": f"""WITH d AS (
  SELECT event_id, date_trunc('hour', ts) AS poll_ts, CAST(user_id % 30 AS VARCHAR) AS line_id,
         'LINE_' || CAST(user_id % 30 AS VARCHAR) AS line_name,
         CASE WHEN event_type = 'view' THEN NULL ELSE CAST(floor(value) AS INTEGER) END AS s1,
         event_type AS d1, props AS t1,
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 25 AS INTEGER) AS s2
  FROM events),
w AS (
  SELECT *, coalesce(s1, 99) <= coalesce(s2, 99) AS first_wins FROM d)
SELECT event_id, 'tube_line_status' AS event_type, line_id, line_name,
       CAST(coalesce(CASE WHEN first_wins THEN s1 ELSE s2 END, 10) AS INTEGER) AS severity_code,
       coalesce(CASE WHEN first_wins THEN d1 ELSE 'k' END, 'Unknown') AS severity_desc,
       coalesce(CASE WHEN first_wins THEN s1 ELSE s2 END, 10) < 10 AS is_disrupted,
       CASE WHEN first_wins THEN t1 ELSE NULL END AS disruption_detail,
       {_iso('poll_ts')} AS ingested_at_utc
FROM w""",
        "disruption_split": _worst() + """SELECT line_id, count(*) AS n_events, 'ok' AS part FROM w WHERE NOT is_disrupted GROUP BY line_id
UNION ALL SELECT line_id, count(*), 'disrupted' FROM w WHERE is_disrupted GROUP BY line_id""",
        "intake_status_events": """WITH d AS (
  SELECT event_id AS e, CASE WHEN event_id % 11 <> 0 THEN CAST(user_id % 30 AS VARCHAR) END AS line_id,
         CASE WHEN event_id % 13 <> 0 THEN 'LINE_' || CAST(user_id % 30 AS VARCHAR) END AS line_name,
         CASE WHEN event_type = 'view' THEN NULL ELSE CAST(floor(value) AS INTEGER) END AS s1, event_type AS d1,
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 25 AS INTEGER) AS s2
  FROM events),
w AS (SELECT *, coalesce(s1, 99) <= coalesce(s2, 99) AS first_wins FROM d WHERE e % 17 <> 0 AND e % 7 <> 0)
SELECT 'accepted' AS state, coalesce(line_id, 'unknown') AS line_id, coalesce(line_name, 'Unknown Line') AS line_name,
       CAST(coalesce(CASE WHEN first_wins THEN s1 ELSE s2 END, 10) AS INTEGER) AS severity_code,
       CASE WHEN first_wins THEN d1 ELSE 'k' END AS severity_desc, count(*) AS n
FROM w GROUP BY 1, 2, 3, 4, 5
UNION ALL SELECT 'rejected', 'line status', 'not parsed', -1, '', count(*) FROM events WHERE event_id % 17 = 0 HAVING count(*) > 0""",
        "intake_stations": """SELECT 'accepted' AS state, CAST(s_suppkey AS VARCHAR) AS station_id,
       CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE s_name || ' old' END AS name, CAST(1 AS BIGINT) AS n
FROM supplier WHERE s_suppkey % 2 = 0 OR (s_suppkey % 25 <> 3 AND s_suppkey % 10 NOT IN (7, 9))
UNION ALL SELECT 'rejected', 'station document', 'not parsed', count(*) FROM supplier WHERE s_suppkey % 25 = 3 HAVING count(*) > 0
UNION ALL SELECT 'rejected', 'station', 'lacks one of id, commonName, lat, lon', count(*) FROM supplier
WHERE s_suppkey % 25 <> 3 AND s_suppkey % 10 IN (7, 9) HAVING count(*) > 0""",
        "intake_network": f"""WITH {_LISTED_EDGES},
n AS (SELECT CAST(station_id AS VARCHAR) AS name, stop_id FROM edges WHERE stop_id IN (SELECT p_partkey FROM part)),
m AS (SELECT CAST(s_nationkey AS VARCHAR) AS name, s_suppkey AS k FROM supplier),
r AS (SELECT 'stops' AS kind, name FROM n WHERE stop_id % 17 <> 0 AND stop_id % 13 <> 0
UNION ALL SELECT 'routes', name FROM n WHERE stop_id % 17 <> 0 AND stop_id % 13 <> 0 AND stop_id % 11 <> 0
UNION ALL SELECT 'members', name FROM m WHERE k % 9 <> 0 AND k % 10 <> 3
UNION ALL SELECT 'rejected nearby document', 'not parsed' FROM n WHERE stop_id % 17 = 0
UNION ALL SELECT 'rejected stop', 'lacks one of station_id, id, commonName, lat, lon' FROM n WHERE stop_id % 17 <> 0 AND stop_id % 13 = 0
UNION ALL SELECT 'rejected route', 'lacks one of id' FROM n WHERE stop_id % 17 <> 0 AND stop_id % 11 = 0
UNION ALL SELECT 'rejected member', 'lacks one of line_id, id' FROM m WHERE k % 9 = 0)
SELECT kind, name, count(*) AS n FROM r GROUP BY kind, name""",
        "status_counts": _worst() + """SELECT ingested_at_utc, count(*) AS n_lines,
       count(*) FILTER (WHERE NOT is_disrupted) AS n_ok, count(*) FILTER (WHERE is_disrupted) AS n_disrupted
FROM w GROUP BY ingested_at_utc""",
        "parse_props": f"""SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       {_pystr('ts')} AS event_hub_time FROM events""",
        "quarantine_counts": """SELECT count(*) AS n_records,
       count(*) FILTER (WHERE TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NULL) AS n_rejected
FROM events""",
        "field_faults": """WITH e AS (SELECT event_id AS e FROM events),
f AS (SELECT '' AS field, 'not an object' AS fault, CAST(NULL AS VARCHAR) AS given FROM e WHERE e % 23 = 0
UNION ALL SELECT 'severity_code', 'wrong type', 'x' FROM e WHERE e % 23 <> 0 AND (e % 7 = 0 OR e % 11 = 0)
UNION ALL SELECT 'is_disrupted', 'wrong type', 'x' FROM e WHERE e % 23 <> 0 AND e % 13 = 0
UNION ALL SELECT 'line_id', 'missing', NULL FROM e WHERE e % 23 <> 0 AND e % 17 = 0
UNION ALL SELECT 'depot', 'unknown field', 'x' FROM e WHERE e % 23 <> 0 AND e % 19 = 0)
SELECT field, fault, count(*) AS n, count(given) AS n_given FROM f GROUP BY field, fault""",
        "event_payload": "WITH " + _EV.strip() + f"""
SELECT {_EVENT_COLS} FROM ev""",
        "iso_timestamp": f"""SELECT event_id, {_iso('ts')} AS ingested_at_utc, {_pystr('ts')} AS processed_at_utc,
       {_iso("date_trunc('hour', ts)")} AS poll_at_utc FROM events""",
        "type_filter": """SELECT p_partkey AS stop_id, p_name AS name, p_type AS stop_type
FROM part WHERE p_type = 'ECONOMY'""",
        "line_names": f"""SELECT o_orderpriority AS line_id, {_title('o_orderpriority')} AS line_name,
       count(*) AS n_orders FROM orders GROUP BY o_orderpriority""",
        "flatten_members": """SELECT stop_id, CAST(pos AS INTEGER) AS pos, route_name, CAST(len(arr) AS INTEGER) AS list_size
FROM (SELECT p_partkey AS stop_id, string_split(p_name, ' ') AS arr,
             unnest(string_split(p_name, ' ')) AS route_name,
             generate_subscripts(string_split(p_name, ' '), 1) - 1 AS pos FROM part)""",
        "node_upsert": """WITH u AS (
  SELECT c_custkey AS node_id, c_acctbal AS value, 0 AS src, CAST(NULL AS TIMESTAMP) AS s1, CAST(NULL AS BIGINT) AS s2
  FROM customer
  UNION ALL
  SELECT o_custkey, o_totalprice, 1, o_orderdate, o_orderkey FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY src DESC, s1 DESC NULLS LAST, s2 DESC NULLS LAST) AS rn
      FROM u)
SELECT node_id, value, src = 1 AS is_updated FROM r WHERE rn = 1""",
        "edge_upsert": """SELECT station_id, stop_id, distance_metres FROM (
  SELECT l_suppkey AS station_id, l_partkey AS stop_id, l_extendedprice AS distance_metres,
         row_number() OVER (PARTITION BY l_suppkey, l_partkey
                            ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) AS rn
  FROM lineitem) WHERE rn = 1""",
        "document_upsert": """SELECT d.doc_id AS node_id, coalesce(l.quality, d.n_chars) AS value, l.doc_id IS NOT NULL AS is_updated
FROM documents d LEFT JOIN labels l USING (doc_id)
UNION ALL
SELECT doc_id, quality, TRUE FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)""",
        "edge_upsert_existing": "WITH " + _LISTED_EDGES.replace("edges AS", "listed AS") + "," + _RADIUS_EDGES + """
SELECT coalesce(e.station_id, l.station_id) AS station_id, coalesce(e.stop_id, l.stop_id) AS stop_id,
       coalesce(e.distance_metres, l.distance_metres) AS distance_metres, e.station_id IS NOT NULL AS is_updated
FROM listed l FULL JOIN edges e ON e.station_id = l.station_id AND e.stop_id = l.stop_id""",
        "guarded_edges": """SELECT source, doc_id, doc_id % 250 AS conv_id FROM documents
WHERE doc_id IN (SELECT doc_id FROM labels) AND doc_id % 250 IN (SELECT conv_id FROM conversations)""",
        "line_vocabulary": f"""WITH vocab(position, line_id) AS (VALUES {_VOCAB})
SELECT v.line_id, {_title('v.line_id')} AS line_name, count(*) AS n_stations
FROM vocab v JOIN supplier s ON s.s_nationkey = v.position GROUP BY v.line_id""",
        "link_counts": """SELECT d.source AS line_id, count(*) AS n_members,
       count(*) FILTER (WHERE l.doc_id IS NOT NULL) AS linked, count(*) FILTER (WHERE l.doc_id IS NULL) AS missing
FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) GROUP BY d.source""",
        "audited_publish": """WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n,
       l_orderkey IS NULL OR l_linenumber IS NULL AS lacks FROM lineitem)
SELECT 'kept' AS state, '' AS reason, l_orderkey, l_linenumber, l_partkey FROM r WHERE n = 1 AND NOT lacks
UNION ALL SELECT 'quarantined', CASE WHEN lacks THEN 'lacks its key' ELSE 'key occurs more than once' END, l_orderkey, l_linenumber, l_partkey
FROM r WHERE n > 1 OR lacks
UNION ALL SELECT 'current', CASE WHEN EXISTS (SELECT 1 FROM r WHERE n > 1 OR lacks) THEN 'old' ELSE 'new' END, -1, -1, -1""",
        "stream_quarantine": a + """SELECT 'alert' AS state, line_id, gridlock_alert, count(*) AS n FROM alerts WHERE event_id % 17 <> 0 GROUP BY ALL
UNION ALL SELECT 'rejected', -1, FALSE, count(*) FROM events WHERE event_id % 17 = 0 HAVING count(*) > 0""",
        "key_violations": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
        "graph_summary": "WITH " + _RADIUS_EDGES + """,
stops AS (SELECT p_partkey, p_brand FROM part
          WHERE p_partkey IN (SELECT e.stop_id FROM edges e JOIN supplier s ON s.s_suppkey = e.station_id))
SELECT (SELECT count(*) FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier)) AS lines,
       (SELECT count(*) FROM supplier) AS stations,
       (SELECT count(*) FROM stops) AS bus_stops,
       (SELECT count(DISTINCT p_brand) FROM stops) AS routes""",
        "line_paths": "WITH " + _paths() + """
SELECT line_id, station_id, stop_id, route_id, station_name, bus_stop_name, bus_stop_id, lat, lon,
       distance_metres, route_name FROM paths""",
        "line_lookup": "WITH " + _paths(True) + """
SELECT * FROM ranked WHERE line_id = 7 AND rn <= 100""",
        "uncapped_options": "WITH " + _paths(True, gaps=True) + """,
opts AS (
  SELECT line_id, count(DISTINCT station_name) AS n_stations, max(CASE WHEN route_name IS NULL THEN 1 ELSE 0 END) AS unnamed,
         count(DISTINCT route_name) + max(CASE WHEN route_name IS NULL THEN 1 ELSE 0 END) AS n_routes,
         list_sort(list_distinct(list(route_name))) AS routes
  FROM paths GROUP BY line_id)
SELECT CAST(n.n_nationkey AS BIGINT) AS line_id, n.n_name AS graph_line_name, CAST(coalesce(o.n_stations, 0) AS INTEGER) AS n_stations,
       CAST(coalesce(o.n_routes, 0) AS INTEGER) AS n_routes,
       coalesce(array_to_string(list_slice(o.routes, 1, 10 - o.unnamed), '|'), '') AS display_routes, coalesce(o.n_routes, 0) < 3 AS gridlock_alert
FROM nation n LEFT JOIN opts o ON o.line_id = n.n_nationkey""",
        "uncapped_gridlock": "WITH " + _paths() + """
SELECT CAST(n.n_nationkey AS BIGINT) AS line_id, count(DISTINCT p.route_name) < 10 AS gridlock_alert
FROM nation n LEFT JOIN paths p ON p.line_id = n.n_nationkey GROUP BY n.n_nationkey""",
        "nearest_paths": "WITH " + _paths(True) + """
SELECT * FROM ranked WHERE rn <= 100""",
        "nearby_stops_top20": "WITH " + _paths(True) + """
SELECT line_id, rn - 1 AS pos, station_name, bus_stop_name, bus_stop_id, lat, lon, distance_metres, route_name
FROM ranked WHERE rn <= 20""",
        "nearest_paths_gaps": "WITH " + _paths(True, gaps=True) + """
SELECT * FROM ranked WHERE rn <= 100""",
        "line_options_gaps": "WITH " + _options(True, gaps=True) + _LINE_OPTIONS_SELECT,
        "document_graph_options": """WITH edges AS (
  SELECT l_suppkey AS station_id, l_partkey AS stop_id, min(l_extendedprice) AS distance_metres
  FROM lineitem GROUP BY l_suppkey, l_partkey),
paths AS (
  SELECT CAST(s.s_nationkey AS VARCHAR) AS line_id, CAST(s.s_suppkey AS VARCHAR) AS station_id,
         CAST(p.p_partkey AS VARCHAR) AS stop_id, p.p_brand AS route_id, s.s_name AS station_name,
         e.distance_metres, p.p_brand AS route_name
  FROM supplier s JOIN edges e ON e.station_id = s.s_suppkey JOIN part p ON p.p_partkey = e.stop_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY distance_metres ASC NULLS LAST,
                               station_id, stop_id, route_id) AS rn
  FROM paths),
capped AS (SELECT * FROM ranked WHERE rn <= 100),
opts AS (
  SELECT line_id, count(DISTINCT station_name) AS n_stations, count(DISTINCT route_name) AS n_routes,
         count(*) AS n_path_rows,
         string_agg(DISTINCT station_name, '|' ORDER BY station_name) AS affected_stations,
         string_agg(DISTINCT route_name, '|' ORDER BY route_name) AS available_routes,
         array_to_string(list_slice(list_sort(list_distinct(list(route_name))), 1, 10), '|') AS display_routes
  FROM capped GROUP BY line_id),
lines AS (SELECT DISTINCT CAST(s_nationkey AS VARCHAR) AS line_id FROM supplier)
SELECT l.line_id, l.line_id AS graph_line_name,
       CAST(coalesce(o.n_path_rows, 0) AS BIGINT) AS n_path_rows,
       CAST(coalesce(o.n_stations, 0) AS INTEGER) AS n_stations,
       CAST(coalesce(o.n_routes, 0) AS INTEGER) AS n_routes,
       coalesce(o.n_routes, 0) < 3 AS gridlock_alert,
       coalesce(o.affected_stations, '') AS affected_stations,
       coalesce(o.available_routes, '') AS available_routes,
       coalesce(o.display_routes, '') AS display_routes
FROM lines l LEFT JOIN opts o ON o.line_id = l.line_id""",
        "line_options": "WITH " + _options(True) + """
SELECT CAST(n.n_nationkey AS BIGINT) AS line_id, n.n_name AS graph_line_name,
       CAST(coalesce(o.n_path_rows, 0) AS BIGINT) AS n_path_rows,
       CAST(coalesce(o.n_stations, 0) AS INTEGER) AS n_stations,
       CAST(coalesce(o.n_routes, 0) AS INTEGER) AS n_routes,
       coalesce(o.n_routes, 0) < 3 AS gridlock_alert,
       coalesce(o.affected_stations, '') AS affected_stations,
       coalesce(o.available_routes, '') AS available_routes,
       coalesce(o.display_routes, '') AS display_routes
FROM nation n LEFT JOIN opts o ON o.line_id = n.n_nationkey""",
        "gridlock_label": a + """SELECT event_id, line_id, gridlock_alert,
       CASE WHEN gridlock_alert THEN 'GRIDLOCK ALERT' ELSE 'Alternatives available' END AS status_label
FROM alerts""",
        "radius_join": f"""WITH st AS (SELECT s_suppkey AS station_id, {_lat('s_suppkey', 7919)} AS lat1,
                   {_lon('s_suppkey', 6151)} AS lon1 FROM supplier),
cu AS (SELECT c_custkey AS stop_id, {_lat('c_custkey', 4421)} AS lat2, {_lon('c_custkey', 9203)} AS lon2
       FROM customer),
d AS (SELECT station_id, stop_id,
             CAST(12742017.6 AS DOUBLE) * asin(sqrt(least(
               pow(sin(radians(lat2 - lat1) / 2), 2)
               + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2),
               CAST(1.0 AS DOUBLE)))) AS dist
      FROM st, cu)
SELECT station_id, stop_id, round(dist, 3) AS distance_metres FROM d WHERE dist <= 300.0""",
        "radius_join_crowded": f"""WITH st(station_id, lat1, lon1) AS (SELECT s_suppkey, {_crowded('s_suppkey', 7919, 6151)} FROM supplier),
cu(stop_id, lat2, lon2) AS (SELECT c_custkey, {_crowded('c_custkey', 4421, 9203)} FROM customer),
d AS (SELECT station_id, stop_id, {_DIST} AS dist FROM st, cu)
SELECT station_id, stop_id, round(dist, 3) AS distance_metres FROM d WHERE dist <= 300.0""",
        "nearby_seed": f"""WITH st AS (SELECT s_suppkey AS station_id, {_lat('s_suppkey', 7919)} AS lat1,
                   {_lon('s_suppkey', 6151)} AS lon1 FROM supplier),
cu AS (SELECT c_custkey AS stop_id, 'N' || CAST(c_nationkey AS VARCHAR) AS route_id,
              {_lat('c_custkey', 4421)} AS lat2, {_lon('c_custkey', 9203)} AS lon2
       FROM customer WHERE c_mktsegment = 'BUILDING'),
d AS (SELECT station_id, stop_id, route_id,
             CAST(12742017.6 AS DOUBLE) * asin(sqrt(least(
               pow(sin(radians(lat2 - lat1) / 2), 2)
               + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2),
               CAST(1.0 AS DOUBLE)))) AS dist
      FROM st, cu)
SELECT station_id, stop_id, round(dist, 3) AS distance_metres, route_id FROM d WHERE dist <= 300.0""",
        "stations_per_line": """SELECT CAST(s_nationkey AS BIGINT) AS line_id, count(*) AS n_stations
FROM supplier GROUP BY s_nationkey""",
        "stops_per_station": "WITH " + _RADIUS_EDGES + """
SELECT station_id, count(*) AS n_stops, min(distance_metres) AS nearest_metres FROM edges GROUP BY station_id""",
        "alert_lines": a + "SELECT DISTINCT line_name FROM alerts",
        "alert_summary": a + """SELECT count(*) AS total_alerts, count(DISTINCT line_name) AS unique_lines,
       min(processed_at_utc) AS first_processed_at, max(processed_at_utc) AS last_processed_at FROM alerts""",
        "latest_alerts": a + """SELECT line_name, severity, gridlock_alert, processed_at_utc, event_id FROM alerts
ORDER BY processed_at_utc DESC, event_id LIMIT 10""",
        "first_alerts": a + """SELECT line_name, severity, gridlock_alert, processed_at_utc, event_id FROM alerts
ORDER BY processed_at_utc, event_id LIMIT 20""",
        "alert_preview": a + """SELECT event_id, substring(to_json(struct_pack(
    line_id := line_id, line_name := line_name, severity := severity, gridlock_alert := gridlock_alert,
    affected_stations := CASE WHEN affected_stations_text = '' THEN CAST([] AS VARCHAR[])
                              ELSE string_split(affected_stations_text, '|') END,
    available_routes := CASE WHEN available_routes_text = '' THEN CAST([] AS VARCHAR[])
                             ELSE string_split(available_routes_text, '|') END)), 1, 200) AS preview
FROM alerts""",
    }
