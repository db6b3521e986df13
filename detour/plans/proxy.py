"""Domain tables derived from the warehouse tables (the test proxy).

line        <- nation                       station <- supplier (serves: s_nationkey)
bus stop    <- part                         has_nearby_stop <- parts within 300 m of a supplier,
bus route   <- part.p_brand (served_by)        or lineitem pairs, distance = min(l_extendedprice)
status      <- events: line = user_id % 30, severity = floor(value)
poll        <- (line, hour of ts); list order = event_id

Coordinates are synthesised from the key: the radius join finds the nearby stops of the
alert and graph queries; the nearest-100 queries take every listed pair, so that the cap
decides and no distance does.
``documents`` and ``status_documents`` rebuild the feed's JSON shapes row by row (one
document per row, no grouping); ``graph_with_gaps`` blanks some distances and one
route name so null handling meets real data. Every function returns a lazy DataFrame
over the parquet scans; nothing is collected.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from detour.functions.columns import iso_utc
from detour.operators.geo_join import radius_join
from detour.operators.graph import Graph
from detour.operators.growing import Within, gridlock_edges, nearest_edges
from detour.operators.nearby import Nearby
from detour.params import DEFAULT, Params
from detour.sources.tables import load_table

N_PROXY_LINES = 30          # events map onto 30 line ids; 25..29 are unknown to the graph
STATION_MULT = (7919, 6151)
STOP_MULT = (4421, 9203)


def coord(key: str, mult: int, modulus: int, origin: float, span: float) -> Column:
    """origin + ((key * mult) % modulus) / modulus * span, evaluated in double."""
    frac = ((F.col(key) * F.lit(mult)) % F.lit(modulus)).cast("double") / F.lit(float(modulus))
    return F.lit(origin) + frac * F.lit(span)


def lat_lon(key: str, mults: tuple[int, int]) -> list[Column]:
    return [coord(key, mults[0], 10007, 51.45, 0.1).alias("lat"),
            coord(key, mults[1], 10009, -0.2, 0.16).alias("lon")]


def stations(spark: SparkSession, base: str) -> DataFrame:
    return load_table(spark, base, "supplier").select(
        F.col("s_suppkey").alias("station_id"), F.col("s_name").alias("name"), *lat_lon("s_suppkey", STATION_MULT))


def bus_stops(spark: SparkSession, base: str) -> DataFrame:
    return load_table(spark, base, "part").select(
        F.col("p_partkey").alias("stop_id"), F.col("p_name").alias("name"), *lat_lon("p_partkey", STOP_MULT))


def listed_edges(spark: SparkSession, base: str) -> DataFrame:
    """(station_id, stop_id, distance_metres): one edge per supplier/part pair of lineitem."""
    return (load_table(spark, base, "lineitem")
            .groupBy(F.col("l_suppkey").alias("station_id"), F.col("l_partkey").alias("stop_id"))
            .agg(F.min("l_extendedprice").alias("distance_metres")))


def radius_edges(spark: SparkSession, base: str, p: Params = DEFAULT) -> DataFrame:
    """(station_id, stop_id, distance_metres): the stops within the documented radius of each
    station (J3), the distance to the millimetre."""
    return nearby(spark, base, p).edges


def nearby(spark: SparkSession, base: str, p: Params = DEFAULT) -> Nearby:
    """:func:`radius_edges` as its two sides."""
    return Nearby(stations(spark, base), bus_stops(spark, base), p.radius_m, p.earth_radius_m, digits=3)


def _edges_within(spark: SparkSession, base: str, p: Params) -> Within:
    def within(around: DataFrame, radius_m: float) -> DataFrame:
        pairs = radius_join(around, bus_stops(spark, base), radius_m, earth_radius_m=p.earth_radius_m)
        return pairs.withColumn("distance_metres", F.round("distance_metres", 3))
    return within


def _graph(spark: SparkSession, base: str, near: DataFrame | Nearby | None) -> Graph:
    nation = load_table(spark, base, "nation")
    supplier = load_table(spark, base, "supplier")
    part = load_table(spark, base, "part")
    return Graph(
        lines=nation.select(F.col("n_nationkey").cast("long").alias("line_id"), F.col("n_name").alias("name")),
        stations=stations(spark, base),
        bus_stops=bus_stops(spark, base),
        bus_routes=part.select(F.col("p_brand").alias("route_id")).distinct()
                       .select("route_id", F.col("route_id").alias("name")),
        serves=supplier.select(F.col("s_nationkey").cast("long").alias("line_id"),
                               F.col("s_suppkey").alias("station_id")),
        has_nearby_stop=near,
        served_by=part.select(F.col("p_partkey").alias("stop_id"), F.col("p_brand").alias("route_id")),
    )


def graph(spark: SparkSession, base: str, p: Params = DEFAULT) -> Graph:
    """The network whose nearby stops are those within the documented radius."""
    return _graph(spark, base, nearby(spark, base, p))


def nearest_graph(spark: SparkSession, base: str, p: Params = DEFAULT) -> Graph:
    """:func:`graph` with the nearby stops that can hold one of a line's first ``path_limit`` path rows."""
    if p.path_limit is None:
        return graph(spark, base, p)
    g = _graph(spark, base, None)
    return replace(g, has_nearby_stop=nearest_edges(g, _edges_within(spark, base, p), p.path_limit, p))


def gridlock_graph(spark: SparkSession, base: str, p: Params = DEFAULT) -> Graph:
    """:func:`graph` with the nearby stops that decide each line's flag."""
    g = _graph(spark, base, None)
    return replace(g, has_nearby_stop=gridlock_edges(g, _edges_within(spark, base, p), p))


def listed_graph(spark: SparkSession, base: str) -> Graph:
    """The network whose nearby stops are all those listed in lineitem: lines with far more
    path rows than the cap."""
    return _graph(spark, base, listed_edges(spark, base))


def line_name_of(line_id: Column) -> Column:
    return F.concat(F.lit("LINE_"), line_id.cast("string"))


def status_rows(events: DataFrame, view_has_no_severity: bool) -> DataFrame:
    """One status per event row: event_id, ts, line_id, poll_ts, severity, desc, detail."""
    sev = F.floor(F.col("value")).cast("int")
    if view_has_no_severity:
        sev = F.when(F.col("event_type") == F.lit("view"), F.lit(None).cast("int")).otherwise(sev)
    return events.select(
        "event_id", "ts",
        (F.col("user_id") % F.lit(N_PROXY_LINES)).alias("line_id"),
        F.date_trunc("hour", F.col("ts")).alias("poll_ts"),
        sev.alias("severity"),
        F.col("event_type").alias("severity_desc"),
        F.col("props").alias("disruption_detail"),
    )


def status_events(events: DataFrame, p, disrupted_only: bool = False) -> DataFrame:
    """Status events (the broker contract) with event_id and ts kept alongside.
    Each event row is its line's only status in this form.

    ``disrupted_only`` adds ``value < threshold`` on the raw rows, which equals
    ``floor(value) < threshold`` and, unlike it, is pushed into the parquet scan.
    """
    from detour.operators.status import events_from_worst
    if disrupted_only:
        events = events.filter(F.col("value") < F.lit(float(p.severity_threshold)))
    rows = status_rows(events, view_has_no_severity=False)
    return events_from_worst(rows, F.col("line_id"), line_name_of(F.col("line_id")),
                             iso_utc(F.col("poll_ts")), p, keep=["event_id", "ts"])


# Gaps: attributes that the feed may leave out.
GAP_MIN_SIZE = 40          # a stop of a part larger than this has no distance
GAP_BRAND = "Brand#13"     # this route has no name


def graph_with_gaps(spark: SparkSession, base: str) -> Graph:
    """The listed network with missing values: null distances (stops of large parts)
    and a route without a name, so ordering and distinct counting meet nulls."""
    g = listed_graph(spark, base)
    big = load_table(spark, base, "part").select(F.col("p_partkey").alias("stop_id"),
                                                 (F.col("p_size") > GAP_MIN_SIZE).alias("_gap"))
    near = g.has_nearby_stop.join(big, "stop_id").select(
        "station_id", "stop_id",
        F.when(F.col("_gap"), F.lit(None).cast("double")).otherwise(F.col("distance_metres")).alias("distance_metres"))
    routes = g.bus_routes.select(
        "route_id", F.when(F.col("route_id") == F.lit(GAP_BRAND), F.lit(None).cast("string"))
        .otherwise(F.col("name")).alias("name"))
    return Graph(lines=g.lines, stations=g.stations, bus_stops=g.bus_stops, bus_routes=routes,
                 serves=g.serves, has_nearby_stop=near, served_by=g.served_by)


def documents(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The feed's documents rebuilt from the tables, one document per row (each list
    holds one entry, so no grouping is needed): station documents (suppliers),
    nearby-stop documents (supplier/part pairs of lineitem, the part's brand as its one
    route) and line membership documents (supplier under its nation)."""
    from detour.fixed import METRO_STATION_TYPE
    supplier = load_table(spark, base, "supplier")
    part = load_table(spark, base, "part")
    sid = F.col("s_suppkey").cast("string")
    stations = supplier.select(F.array(F.struct(
        sid.alias("id"), F.col("s_name").alias("commonName"), *lat_lon("s_suppkey", STATION_MULT),
        F.lit(METRO_STATION_TYPE).alias("stopType"))).alias("stopPoints"))
    edges = listed_edges(spark, base).join(
        part.select(F.col("p_partkey").alias("stop_id"), "p_name", "p_brand"), "stop_id")
    nearby = edges.select(
        F.col("station_id").cast("string").alias("station_id"),
        F.array(F.struct(
            F.col("stop_id").cast("string").alias("id"), F.col("p_name").alias("commonName"),
            *lat_lon("stop_id", STOP_MULT), F.col("distance_metres").alias("distance"),
            F.array(F.struct(F.col("p_brand").alias("id"), F.col("p_brand").alias("name"))).alias("lines"),
        )).alias("stopPoints"))
    members = supplier.select(
        F.col("s_nationkey").cast("string").alias("line_id"),
        F.array(F.struct(sid.alias("id"), F.lit(METRO_STATION_TYPE).alias("stopType"))).alias("stops"))
    return stations, nearby, members


def status_documents(events: DataFrame) -> DataFrame:
    """Line-status documents rebuilt from events rows (one document per row, two
    statuses each): the first from the event (no severity for views, the event's
    props as disruption text), the second from the props value ``k`` (k % 25, no
    disruption). Carries ``event_id`` and ``poll_ts`` alongside."""
    k = F.from_json(F.col("props"), "k int")["k"]
    first = F.struct(
        F.when(F.col("event_type") == F.lit("view"), F.lit(None).cast("int"))
         .otherwise(F.floor(F.col("value")).cast("int")).alias("statusSeverity"),
        F.col("event_type").alias("statusSeverityDescription"),
        F.struct(F.col("props").alias("description")).alias("disruption"))
    second = F.struct(
        (k % F.lit(25)).cast("int").alias("statusSeverity"),
        F.lit("k").alias("statusSeverityDescription"),
        F.lit(None).cast("struct<description:string>").alias("disruption"))
    line = F.col("user_id") % F.lit(N_PROXY_LINES)
    return events.select(
        "event_id", F.date_trunc("hour", F.col("ts")).alias("poll_ts"),
        line.cast("string").alias("id"), line_name_of(line).alias("name"),
        F.array(first, second).alias("lineStatuses"))
