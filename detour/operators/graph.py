"""The line -> station -> bus stop -> bus route network as node and edge tables.

Nodes:  lines(line_id, name)  stations(station_id, name, lat, lon)
        bus_stops(stop_id, name, lat, lon)  bus_routes(route_id, name)
Edges:  serves(line_id, station_id)  has_nearby_stop(station_id, stop_id, distance_metres)
        served_by(stop_id, route_id)

Covers P7-P9 (type filters, renames), P14, F3, F9, F10, J4, J6, U1, U2, A10, A11.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from detour.functions.columns import title_from_id
from detour.operators.geo_join import radius_join
from detour.operators.nearby import Nearby
from detour.operators.upsert import distinct_edges, latest_per_key, upsert
from detour.schemas import BUS_STOP_TYPE, METRO_STATION_TYPE
from detour.sources import documents as D


@dataclass(frozen=True)
class Graph:
    lines: DataFrame
    stations: DataFrame
    bus_stops: DataFrame
    bus_routes: DataFrame
    serves: DataFrame
    has_nearby_stop: DataFrame | Nearby
    served_by: DataFrame

    def __getattribute__(self, name: str):
        value = object.__getattribute__(self, name)
        return value.edges if isinstance(value, Nearby) else value

    def nearby(self) -> Nearby | None:
        """How ``has_nearby_stop`` is made where it isn't a table: a graph may be built with either."""
        value = object.__getattribute__(self, "has_nearby_stop")
        return value if isinstance(value, Nearby) else None

    def tables(self) -> dict[str, DataFrame]:
        return {k: getattr(self, k) for k in self.__dataclass_fields__}


# ---- documents -> rows ------------------------------------------------------------

def select_type(points: DataFrame, type_col: str, wanted: str) -> DataFrame:
    """Keep stop points of one type (a plain predicate, pushed into scans)."""
    return points.filter(F.col(type_col) == F.lit(wanted))


def flatten_list(rows: DataFrame, key: str, array_col: str, out: str) -> DataFrame:
    """F9 + F10: one row per list element with its position and the list length."""
    return rows.select(key, F.size(F.coalesce(F.col(array_col), F.array())).alias("list_size"),
                       F.posexplode(array_col).alias("pos", out)).select(key, "pos", out, "list_size")


def stations_from_documents(station_docs: DataFrame, stop_type: str = METRO_STATION_TYPE) -> DataFrame:
    """S4 + P7 + P9: metro stations only, renamed to node columns; ``seq`` = document and list position."""
    return (select_type(D.complete(D.station_points(station_docs), D.REQUIRED_POINT), "stopType", stop_type)
            .select(F.col("id").alias("station_id"), F.col("commonName").alias("name"),
                    "lat", "lon", "seq"))


def nearby_from_documents(nearby_docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """S5 + F9: nearby-stop lists -> (stop rows, has_nearby_stop rows, route rows, served_by rows).

    Each output carries ``seq`` (station_id, position) so that a later upsert can
    tell which write came last. A missing distance is 0 metres, stored as double (D13).
    """
    pts = D.complete(D.nearby_stop_points(nearby_docs), ("station_id", *D.REQUIRED_POINT))
    stops = pts.select(F.col("id").alias("stop_id"), F.col("commonName").alias("name"),
                       "lat", "lon", "station_id", "seq")
    near = pts.select("station_id", F.col("id").alias("stop_id"),
                      F.coalesce(F.col("distance").cast("double"), F.lit(0.0)).alias("distance_metres"),
                      "seq")
    rl = pts.select(F.col("id").alias("stop_id"), "station_id", "seq",
                    F.posexplode(F.coalesce(F.col("lines"), F.array())).alias("lpos", "l")).filter(F.col("l.id").isNotNull())
    routes = rl.select(F.col("l.id").alias("route_id"), F.col("l.name").alias("name"),
                       "station_id", "seq", "lpos")
    served = rl.select("stop_id", F.col("l.id").alias("route_id"), "station_id")
    return stops, near, routes, served


def members_from_documents(member_docs: DataFrame, stop_type: str = METRO_STATION_TYPE) -> DataFrame:
    """S6 + P7: (line_id, station_id) for metro-station members, in list order."""
    return (select_type(D.complete(D.membership_points(member_docs), ("line_id", "id")), "stopType", stop_type)
            .select("line_id", F.col("id").alias("station_id"), "seq"))


def nearby_pairs(stations: DataFrame, stop_points: DataFrame, radius_m: float,
                 stop_type: str | None = BUS_STOP_TYPE) -> DataFrame:
    """P8 + J3, re-aimed S5: nearby stops from a table of all stop points instead of one
    radius request per station.

    ``stop_points``: (id, commonName, lat, lon, stopType, lines[]{id, name}). P8 keeps bus stops,
    J3 pairs them with stations within ``radius_m``. One row per pair with the stop's
    attributes: (station_id, stop_id, distance_metres, name, stop_lat, stop_lon, lines).
    """
    pts = stop_points if stop_type is None else select_type(stop_points, "stopType", stop_type)
    pts = pts.select(F.col("id").alias("stop_id"), F.col("commonName").alias("name"), "lat", "lon",
                     F.col("lat").alias("stop_lat"), F.col("lon").alias("stop_lon"), "lines")
    return radius_join(stations.select("station_id", "lat", "lon"), pts, radius_m,
                       carry=["name", "stop_lat", "stop_lon", "lines"])


def nearby_documents(pairs: DataFrame) -> DataFrame:
    """:func:`nearby_pairs` in the shape of nearby-stop documents: one pair per document, so no grouping."""
    return pairs.select("station_id", F.array(F.struct(
        F.col("stop_id").alias("id"), F.col("name").alias("commonName"), F.col("stop_lat").alias("lat"), F.col("stop_lon").alias("lon"),
        F.col("distance_metres").alias("distance"), "lines")).alias("stopPoints"))


def nearby_tables(pairs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The (bus_stops, has_nearby_stop, bus_routes, served_by) of :func:`nearby_pairs` — only
    stops near some station and only their routes, as the per-station requests would give.
    Write the pairs first where more than one of the four is used."""
    stops = pairs.select("stop_id", "name", F.col("stop_lat").alias("lat"), F.col("stop_lon").alias("lon")).dropDuplicates(["stop_id"])
    rl = pairs.select("stop_id", F.posexplode(F.coalesce(F.col("lines"), F.array())).alias("lpos", "l"))
    routes = latest_per_key(rl.select(F.col("l.id").alias("route_id"), F.col("l.name").alias("name"),
                                      "stop_id", "lpos"), ["route_id"], ["stop_id", "lpos"])
    served = distinct_edges(rl.select("stop_id", F.col("l.id").alias("route_id")), ["stop_id", "route_id"])
    return stops, pairs.select("station_id", "stop_id", "distance_metres"), routes.select("route_id", "name"), served


def nearby_by_radius(stations: DataFrame, stop_points: DataFrame, radius_m: float,
                     stop_type: str | None = BUS_STOP_TYPE) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """:func:`nearby_tables` of :func:`nearby_pairs`."""
    return nearby_tables(nearby_pairs(stations, stop_points, radius_m, stop_type))


def lines_from_members(members: DataFrame, count_as: str | None = None) -> DataFrame:
    """P14 + F3: a line becomes a node only when it has at least one station.
    With ``count_as`` the number of member rows per line (A11) comes along in the
    same aggregate."""
    if count_as:
        agg = members.groupBy("line_id").agg(F.count(F.lit(1)).alias(count_as))
        return agg.select("line_id", title_from_id(F.col("line_id")).alias("name"), count_as)
    return (members.select("line_id").distinct()
            .select("line_id", title_from_id(F.col("line_id")).alias("name")))


def build_graph(station_docs: DataFrame, nearby_docs: DataFrame, member_docs: DataFrame,
                current: Graph | None = None, mode: str = "upsert", guard: bool = True) -> Graph:
    """Documents -> upserted node and edge tables (U1: a stop reached from many
    stations is one node; T6: the last write of a key wins, nulls included).

    Write order is station-document order (file and place in it, then list position), then
    each station's nearby list in list order. Nearby lists of stations not in the station
    documents are ignored, as the original only requests lists for the stations it
    fetched; a station in several documents counts with its last place. Rows without the
    keys of a node are left out (``sources.documents.rejected_documents`` has them).
    ``guard=False`` leaves the J4 edge checks to the caller (``jobs.write_graph``
    applies them against the written node tables).
    """
    st = stations_from_documents(station_docs)
    stops, near, routes, served = nearby_from_documents(nearby_docs)
    members = members_from_documents(member_docs)

    stations = upsert(current.stations if current else None, st, ["station_id"], ["seq"], mode)
    st = st.groupBy("station_id").agg(F.max("seq").alias("seq"))
    # Order of writes: stations in document order, then each station's stops in list order.
    stop_rows = stops.join(st.select("station_id", F.col("seq").alias("station_seq")), "station_id")
    stop_rows = stop_rows.select("stop_id", "name", "lat", "lon", "station_seq", "seq")
    bus_stops = upsert(current.bus_stops if current else None, stop_rows,
                       ["stop_id"], ["station_seq", "seq"], mode)
    route_rows = routes.join(st.select("station_id", F.col("seq").alias("station_seq")), "station_id")
    route_rows = route_rows.select("route_id", "name", "station_seq", "seq", "lpos")
    bus_routes = upsert(current.bus_routes if current else None, route_rows,
                        ["route_id"], ["station_seq", "seq", "lpos"], mode)
    near_rows = near.join(st.select("station_id", F.col("seq").alias("station_seq")), "station_id")
    has_near = upsert(current.has_nearby_stop if current else None,
                      near_rows.select("station_id", "stop_id", "distance_metres", "station_seq", "seq"),
                      ["station_id", "stop_id"], ["station_seq", "seq"], mode)
    lines = lines_from_members(members)
    if current is not None and mode == "upsert":
        lines = latest_per_key(current.lines.withColumn("_s", F.lit(0))
                               .unionByName(lines.withColumn("_s", F.lit(1))), ["line_id"], ["_s"]).drop("_s")
    serves = distinct_edges(members, ["line_id", "station_id"])
    # Only the nearby lists of listed stations are processed, as for stops and routes.
    served = served.join(st.select("station_id"), "station_id", "left_semi")
    served_by = distinct_edges(served, ["stop_id", "route_id"])
    if current is not None and mode == "upsert":
        serves = distinct_edges(current.serves.unionByName(serves), ["line_id", "station_id"])
        served_by = distinct_edges(current.served_by.unionByName(served_by), ["stop_id", "route_id"])
    g = Graph(lines=lines, stations=stations.drop("is_updated"), bus_stops=bus_stops.drop("is_updated"),
              bus_routes=bus_routes.drop("is_updated"), serves=serves,
              has_nearby_stop=has_near.drop("is_updated"), served_by=served_by)
    return guard_graph(g) if guard else g


# ---- integrity ----------------------------------------------------------------------

def guard_edges(edges: DataFrame, src: DataFrame, src_key: str, dst: DataFrame, dst_key: str,
                edge_src: str | None = None, edge_dst: str | None = None) -> DataFrame:
    """An edge exists only when both endpoint nodes exist (two semi joins)."""
    edge_src, edge_dst = edge_src or src_key, edge_dst or dst_key
    s = src.select(F.col(src_key).alias("_k"))
    d = dst.select(F.col(dst_key).alias("_k"))
    return (edges.join(s, edges[edge_src] == s["_k"], "left_semi")
                 .join(d, edges[edge_dst] == d["_k"], "left_semi"))


def guard_graph(g: Graph) -> Graph:
    return replace(
        g,
        serves=guard_edges(g.serves, g.lines, "line_id", g.stations, "station_id"),
        has_nearby_stop=guard_edges(g.has_nearby_stop, g.stations, "station_id", g.bus_stops, "stop_id"),
        served_by=guard_edges(g.served_by, g.bus_stops, "stop_id", g.bus_routes, "route_id"),
    )


def prune_unreferenced(g: Graph) -> Graph:
    """The graph as seeding leaves it: a line exists only with a station (P14), a stop
    only when some station lists it, a route only when some remaining stop lists it."""
    stops = g.bus_stops.join(g.has_nearby_stop.select("stop_id"), "stop_id", "left_semi")
    served_by = g.served_by.join(stops.select("stop_id"), "stop_id", "left_semi")
    return replace(
        g,
        lines=g.lines.join(g.serves.select("line_id"), "line_id", "left_semi"),
        bus_stops=stops,
        served_by=served_by,
        bus_routes=g.bus_routes.join(served_by.select("route_id"), "route_id", "left_semi"),
    )


def link_counts(members: DataFrame, nodes: DataFrame, member_line: str, member_node: str,
                node_key: str) -> DataFrame:
    """J6 + D9 + A11: per line, members whose node exists (``linked``) and those
    whose node is missing. Left join then conditional counts."""
    n = nodes.select(F.col(node_key).alias("_k"), F.lit(True).alias("_hit")).dropDuplicates(["_k"])
    j = members.join(n, members[member_node] == n["_k"], "left")
    return j.groupBy(member_line).agg(
        F.count(F.lit(1)).alias("n_members"),
        F.count_if(F.col("_hit").isNotNull()).alias("linked"),
        F.count_if(F.col("_hit").isNull()).alias("missing"),
    )


def key_violations(table: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once or are null (a uniqueness constraint as a check)."""
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    return (table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter((F.col("n_rows") > 1) | null_key))


def graph_summary(g: Graph) -> DataFrame:
    """A10: node counts per label, always exactly one row.

    Four global counts unioned as (label, n) and folded by conditional sums; no
    cross join, and an empty label reports 0 instead of removing the row.
    """
    parts = [g.lines.agg(F.count(F.lit(1)).alias("n")).select(F.lit("lines").alias("label"), "n"),
             g.stations.agg(F.count(F.lit(1)).alias("n")).select(F.lit("stations").alias("label"), "n"),
             g.bus_stops.agg(F.count(F.lit(1)).alias("n")).select(F.lit("bus_stops").alias("label"), "n"),
             g.bus_routes.agg(F.count(F.lit(1)).alias("n")).select(F.lit("routes").alias("label"), "n")]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(*[F.coalesce(F.sum(F.when(F.col("label") == lbl, F.col("n"))), F.lit(0)).cast("long").alias(lbl)
                   for lbl in ("lines", "stations", "bus_stops", "routes")])
