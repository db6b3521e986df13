"""A2-A4 without a path cap: what an alert shows of a line's alternatives, in bounded memory.

Without a cap, the names of a line's routes have no bound, and a ``collect_set`` holds them in one row. Here the distinct pairs of
line and route are rows: they are found before any path row exists (lines meet stops, then stops meet routes, each made distinct
map-side first), counted, and only the first ``max(min_routes, display_routes)`` names of a line are gathered. A line of a
third of all paths costs its distinct names in rows, and a list of that bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from detour.operators.graph import Graph
from detour.params import DEFAULT, Params


def line_stops(g: Graph) -> DataFrame:
    """(line_id, station_name, stop_id), distinct: the hops of all paths up to the stop, stations by their names."""
    return (g.serves.join(g.lines.select("line_id"), "line_id", "left_semi")
            .join(g.stations.select("station_id", F.col("name").alias("station_name")), "station_id")
            .join(g.has_nearby_stop.select("station_id", "stop_id"), "station_id")
            .select("line_id", "station_name", "stop_id").distinct())


def _served(g: Graph) -> DataFrame:
    """(stop_id, route_name), distinct, of stops that are nodes."""
    return (g.served_by.join(g.bus_stops.select("stop_id"), "stop_id", "left_semi")
            .join(g.bus_routes.select("route_id", F.col("name").alias("route_name")), "route_id")
            .select("stop_id", "route_name").distinct())


def line_routes(g: Graph) -> DataFrame:
    """(line_id, route_name), distinct, over all paths."""
    return line_stops(g).select("line_id", "stop_id").distinct().join(_served(g), "stop_id").select("line_id", "route_name").distinct()


def first_names(pairs: DataFrame, key: str, name: str, most: int) -> DataFrame:
    """(key, names: the first ``most`` in order, null first, n_first: how many of them). ``pairs`` must be distinct. Each task
    sends at most ``most`` rows a key (a partial ``WindowGroupLimit``)."""
    w = Window.partitionBy(key).orderBy(F.col(name).asc_nulls_first())
    first = pairs.select(key, name).withColumn("_at", F.row_number().over(w)).filter(F.col("_at") <= most)
    held = F.sort_array(F.collect_list(F.struct("_at", F.col(name).alias("name"))))
    return first.groupBy(key).agg(F.transform(held, lambda x: x["name"]).alias("names"), F.count(F.lit(1)).alias("n_first"))


def _reached(n_first: Column, p: Params) -> Column:
    return F.coalesce(n_first, F.lit(0)) < F.lit(p.min_routes)


def uncapped_options(g: Graph, p: Params = DEFAULT) -> DataFrame:
    """(line_id, graph_line_name, n_stations, n_routes, display_routes, gridlock_alert) of every line over all of its paths: what
    ``line_options(nearest_paths(g, None), ...)`` gives for these columns. A null name counts as one."""
    served, stops = _served(g), line_stops(g)
    routes = stops.select("line_id", "stop_id").distinct().join(served, "stop_id").select("line_id", "route_name").distinct()
    # A station counts where one of its stops has a route; its name counts once.
    named = stops.join(served.select("stop_id").distinct(), "stop_id", "left_semi").select("line_id", "station_name").distinct()
    first = first_names(routes, "line_id", "route_name", max(p.min_routes, p.display_routes))
    counts = named.groupBy("line_id").agg(F.count(F.lit(1)).alias("_st")).join(
        routes.groupBy("line_id").agg(F.count(F.lit(1)).alias("_rt")), "line_id")
    return (g.lines.select("line_id", F.col("name").alias("graph_line_name")).join(first, "line_id", "left").join(counts, "line_id", "left")
            .select("line_id", "graph_line_name", F.coalesce("_st", F.lit(0)).cast("int").alias("n_stations"),
                    F.coalesce("_rt", F.lit(0)).cast("int").alias("n_routes"),
                    F.coalesce(F.slice("names", 1, p.display_routes), F.array().cast("array<string>")).alias("display_routes"),
                    _reached(F.col("n_first"), p).alias("gridlock_alert")))


def gridlock_lines(g: Graph, p: Params = DEFAULT) -> DataFrame:
    """(line_id, gridlock_alert) of every line over all of its paths: only the first ``min_routes`` names of a line are looked for."""
    first = first_names(line_routes(g), "line_id", "route_name", p.min_routes)
    return g.lines.select("line_id").join(first, "line_id", "left").select("line_id", _reached(F.col("n_first"), p).alias("gridlock_alert"))
