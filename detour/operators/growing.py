"""The nearby stops that decide a result, without those that don't: the radius grows line by line.

The pairs of stations and stops within a radius grow with the product of both. A result that needs a line's nearest
path rows only, or any few of them, is found from the pairs within a smaller radius: first all lines are tried with a radius that
should do, judged by the number of candidates; a line that hasn't enough there is tried again with a larger one, up
to the whole radius, with its own stations only. What is enough is counted from the pairs found, so the cut is exact; the
estimate only decides where to begin. Each step's pairs are written below the shared folder.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from detour.operators.geo_join import candidate_count
from detour.operators.graph import Graph
from detour.operators.paths import counted_pairs
from detour.operators.uncapped import first_names, line_routes
from detour.params import DEFAULT, Params
from detour.session import fresh_path

GROWTH = 3.0
SPARE = 8           # first radius: for so many times the pairs that a line needs on average
SLACK_M = 0.01      # distances are rounded: rows this near to the radius don't count as found

Within = Callable[[DataFrame, float], DataFrame]    # (stations, radius) -> (station_id, stop_id, distance_metres) within it
Enough = Callable[[Graph], DataFrame]               # graph -> (line_id) of the lines that need no farther stops


def growing_edges(g: Graph, within: Within, enough: Enough, needed: int, p: Params = DEFAULT) -> DataFrame:
    """``within`` for each station, up to the radius that is enough for all of its lines. ``needed``: pairs a line, as a rule.

    The nearby stops of ``g`` aren't looked at."""
    spark, path = g.lines.sparkSession, fresh_path(g.lines.sparkSession, "growing")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    serves = written(g.serves.join(g.lines.select("line_id"), "line_id", "left_semi"), "serves-0")
    lines = serves.agg(F.count_distinct("line_id")).first()[0]
    pairs = candidate_count(g.stations, g.bus_stops, p.radius_m, p.earth_radius_m) * math.pi / 9
    radius, step, done = p.radius_m * math.sqrt(SPARE * needed * max(lines, 1) / max(pairs, 1.0)), 0, []
    while True:
        whole = radius * GROWTH >= p.radius_m
        at = p.radius_m if whole else radius
        edges = within(g.stations.join(serves.select("station_id"), "station_id", "left_semi"), at)
        if whole and not done:
            return edges
        edges = written(edges, f"edges-{step}")
        if whole:
            break
        sure = edges.filter(F.col("distance_metres") < F.lit(at - SLACK_M))
        more = written(serves.join(enough(replace(g, serves=serves, has_nearby_stop=sure)), "line_id", "left_anti"), f"serves-{step + 1}")
        # A station that goes on has its pairs in the next step, with those of this one.
        done.append(edges.join(more.select("station_id"), "station_id", "left_anti"))
        if more.isEmpty():
            return reduce(DataFrame.unionByName, done)
        serves, radius, step = more, radius * GROWTH, step + 1
    return reduce(DataFrame.unionByName, [*done, edges])


def nearest_edges(g: Graph, within: Within, limit: int, p: Params = DEFAULT) -> DataFrame:
    """Enough for the first ``limit`` path rows of each line (``paths.nearest_paths``)."""
    def enough(found: Graph) -> DataFrame:
        return counted_pairs(found).groupBy("line_id").agg(F.sum("_n").alias("_n")).filter(F.col("_n") >= limit).select("line_id")
    return growing_edges(g, within, enough, limit, p)


def gridlock_edges(g: Graph, within: Within, p: Params = DEFAULT) -> DataFrame:
    """Enough for the flag of each line over all of its paths (``uncapped.gridlock_lines``): a line with ``min_routes`` names can only gain some."""
    def enough(found: Graph) -> DataFrame:
        return first_names(line_routes(found), "line_id", "route_name", p.min_routes).filter(F.col("n_first") >= p.min_routes).select("line_id")
    return growing_edges(g, within, enough, p.min_routes, p)
