"""Path rows line -> station -> bus stop -> bus route.

A path row is one (line, station, stop, route) combination; every hop is an inner
join, so a dangling edge or a missing node drops the path. Ordering is by the
nearby-stop distance ascending with nulls last (D3), then station, stop and route
ids so that the cut at ``limit`` is deterministic (D2).
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from detour.operators.graph import Graph
from detour.operators.nearby import Nearby
from detour.operators.sizing import broadcast_while_few

PATH_COLUMNS = ["station_name", "bus_stop_name", "bus_stop_id", "lat", "lon", "distance_metres", "route_name"]
ID_COLUMNS = ["line_id", "station_id", "stop_id", "route_id"]


def row_order():
    """The order of path rows within a line (public for consumers that rank)."""
    return _row_order()


def _pair_order():
    return [F.col("distance_metres").asc_nulls_last(), F.col("station_id").asc_nulls_last(),
            F.col("stop_id").asc_nulls_last()]


def _row_order():
    return _pair_order() + [F.col("route_id").asc_nulls_last()]


def _station_stop_pairs(g: Graph) -> DataFrame:
    serves = g.serves.join(g.lines.select("line_id"), "line_id", "left_semi")
    stations = g.stations.select("station_id", F.col("name").alias("station_name"))
    stops = g.bus_stops.select("stop_id", F.col("name").alias("bus_stop_name"), "lat", "lon")
    return (serves.join(stations, "station_id")
                  .join(g.has_nearby_stop.select("station_id", "stop_id", "distance_metres"), "station_id")
                  .join(stops, "stop_id"))


def _stop_routes(g: Graph) -> DataFrame:
    return g.served_by.select("stop_id", "route_id").join(
        g.bus_routes.select("route_id", F.col("name").alias("route_name")), "route_id")


def _finish(rows: DataFrame) -> DataFrame:
    return rows.select(*ID_COLUMNS, "station_name", "bus_stop_name", F.col("stop_id").alias("bus_stop_id"),
                       "lat", "lon", "distance_metres", "route_name")


# What the sides of path rows carry besides keys and places.
PLACED_LEFT, PLACED_RIGHT = ["line_id", "station_name"], ["bus_stop_name", "stop_lat", "stop_lon", "route_id", "route_name"]


def placed_sides(g: Graph, near: Nearby) -> tuple[DataFrame, DataFrame]:
    """The path rows of ``g`` before stations meet stops: (lines' calls by the places of their stations, hops from stops to
    routes by the places of the stops)."""
    calls = (g.serves.join(g.lines.select("line_id"), "line_id", "left_semi")
             .join(g.stations.select("station_id", F.col("name").alias("station_name")), "station_id"))
    hops = (g.bus_stops.select("stop_id", F.col("name").alias("bus_stop_name"), F.col("lat").alias("stop_lat"), F.col("lon").alias("stop_lon"))
            .join(_stop_routes(g), "stop_id"))
    return (near.stations.select("station_id", "lat", "lon").join(calls, "station_id"),
            near.stops.select("stop_id", "lat", "lon").join(hops, "stop_id"))


def finish_placed(pairs: DataFrame) -> DataFrame:
    """The path rows of joined :func:`placed_sides`."""
    return _finish(pairs.withColumnsRenamed({"stop_lat": "lat", "stop_lon": "lon"}))


def path_rows(g: Graph) -> DataFrame:
    """Every path row, unordered. Edges that follow from places are made last, with all columns: they don't move."""
    if near := g.nearby():
        return finish_placed(near.pairs(*placed_sides(g, near), PLACED_LEFT, PLACED_RIGHT))
    return _finish(_station_stop_pairs(g).join(_stop_routes(g), "stop_id"))


def restrict_line(g: Graph, line_id) -> Graph:
    """The graph seen from one line (the filter lands on the ``serves`` scan)."""
    return replace(g, lines=g.lines.filter(F.col("line_id") == F.lit(line_id)),
                   serves=g.serves.filter(F.col("line_id") == F.lit(line_id)))


# Steps of the distance in which path rows are counted: a doubling takes STEPS of them.
STEPS = 16
_MOST, _NAN, _NULL = 1_000_000, 2_000_000, 3_000_000


def distance_step(distance: str = "distance_metres") -> Column:
    """A whole number that never falls as the distance rises: equal or later steps for what sorts later (NaN after all
    numbers, null last)."""
    d = F.col(distance).cast("double")
    step = F.floor(F.signum(d) * F.least(F.log2(F.abs(d) + F.lit(1.0)) * F.lit(STEPS), F.lit(float(_MOST))))
    return F.when(d.isNull(), F.lit(_NULL)).when(F.isnan(d), F.lit(_NAN)).otherwise(step).cast("int")


def counted_pairs(g: Graph) -> DataFrame:
    """(line_id, station_id, stop_id, distance_metres, _step, _n): the pairs that have path rows, and how many."""
    routes = _stop_routes(g).groupBy("stop_id").agg(F.count(F.lit(1)).alias("_n"))
    serves = (g.serves.join(g.lines.select("line_id"), "line_id", "left_semi")
                      .join(g.stations.select("station_id"), "station_id", "left_semi"))
    near = g.has_nearby_stop.select("station_id", "stop_id", "distance_metres").join(routes, "stop_id")
    return (serves.join(near, "station_id").join(g.bus_stops.select("stop_id"), "stop_id", "left_semi")
                  .withColumn("_step", distance_step()))


def last_steps(pairs: DataFrame, limit: int) -> DataFrame:
    """(line_id, _last): the distance step in which the ``limit``-th path row of each line lies; lines with fewer rows are left
    out. One partial sum for each line and step leaves a task, whatever the number of pairs."""
    per = pairs.groupBy("line_id", "_step").agg(F.sum("_n").alias("_n"))
    w = Window.partitionBy("line_id").orderBy("_step").rowsBetween(Window.unboundedPreceding, 0)
    return (per.withColumn("_upto", F.sum("_n").over(w)).filter(F.col("_upto") >= F.lit(limit))
               .groupBy("line_id").agg(F.min("_step").alias("_last")))


def nearest_pairs(g: Graph, limit: int) -> DataFrame:
    """(line_id, station_id, stop_id, distance_metres) of the pairs that can hold one of a line's first ``limit``
    path rows: an exact cut before pairs are expanded into routes and named, without a sort."""
    pairs = counted_pairs(g)
    last = broadcast_while_few(last_steps(pairs, limit), g.lines)  # a row for each line at most
    return (pairs.join(last, "line_id", "left")
                 .filter(F.col("_last").isNull() | (F.col("_step") <= F.col("_last")))
                 .select("line_id", "station_id", "stop_id", "distance_metres"))


def nearest_paths(g: Graph, limit: int | None = 100) -> DataFrame:
    """T1 + T2: the ``limit`` nearest path rows per line with their rank ``rn``.

    The pairs of line, station and stop are cut at the distance where a line's ``limit``-th row lies
    (:func:`nearest_pairs`); only those are expanded and ranked. What is left is cut by a ``row_number``
    filter that Spark evaluates partially on the map side (``WindowGroupLimit``), so equal distances in any
    number don't bring a line into one task. ``limit=None`` returns all path rows without ``rn``: ranking them would
    put a line whole into one task; consumers rank the few they keep.
    """
    if limit is None:
        return path_rows(g)
    stations = g.stations.select("station_id", F.col("name").alias("station_name"))
    stops = g.bus_stops.select("stop_id", F.col("name").alias("bus_stop_name"), "lat", "lon")
    rows = _finish(nearest_pairs(g, limit).join(stations, "station_id").join(stops, "stop_id").join(_stop_routes(g), "stop_id"))
    w = Window.partitionBy("line_id").orderBy(*_row_order())
    return rows.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= limit)
