"""The growing radius gives the options and flags of the whole radius, from fewer pairs."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from detour.operators.geo_join import radius_join
from detour.operators.graph import Graph
from detour.operators.growing import gridlock_edges, nearest_edges
from detour.operators.paths import nearest_paths
from detour.operators.uncapped import gridlock_lines
from detour.params import DEFAULT


def network(spark, n_stations=60, n_stops=900, spread=0.01):
    """Lines of many and of few stations, stations shared and written twice, a stop without route, ties in distance."""
    rnd = random.Random(6)
    place = lambda: (51.5 + rnd.random() * spread, -0.1 + rnd.random() * spread)
    stations = [(i, f"S{i}", *place()) for i in range(n_stations)] + [(500, "far", 51.9, 0.4), (501, "edge", 51.9027, 0.4)]
    stops = [(i, f"B{i}", *place()) for i in range(n_stops)]
    stops += [(2000 + i, "same", *stops[0][2:]) for i in range(5)] + [(3000, "by far", 51.9026, 0.4)]
    serves = [(i % 3, i) for i in range(n_stations)] + [(7, 500), (7, 501), (8, 1), (None, 2), (1, None), (99, 3), (0, 3)]
    t = spark.createDataFrame
    return Graph(lines=t([(x, f"L{x}") for x in (0, 1, 2, 7, 8, 9)], "line_id long, name string"),
                 stations=t(stations + stations[:2], "station_id long, name string, lat double, lon double"),
                 bus_stops=t(stops, "stop_id long, name string, lat double, lon double"),
                 bus_routes=t([(f"R{i}", f"R{i}") for i in range(12)], "route_id string, name string"),
                 serves=t(serves, "line_id long, station_id long"), has_nearby_stop=None,
                 served_by=t([(s[0], f"R{s[0] % 12}") for s in stops if s[0] % 7], "stop_id long, route_id string"))


@pytest.fixture
def looked(spark):
    g, seen = network(spark), []

    def within(around, radius_m):
        seen.append(radius_m)
        return radius_join(around, g.bus_stops, radius_m).withColumn("distance_metres", F.round("distance_metres", 3))
    return g, within, seen


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("limit", [1, 5, 40])
def test_nearest_paths_of_the_whole_radius(looked, limit):
    g, within, seen = looked
    whole = replace(g, has_nearby_stop=within(g.stations, DEFAULT.radius_m))
    seen.clear()
    near = nearest_edges(g, within, limit)
    if limit < 40:   # where the whole radius is no more than what is needed, it is taken at once
        assert seen[0] < DEFAULT.radius_m and near.count() < whole.has_nearby_stop.count()
    if limit > 1:
        assert seen[-1] == DEFAULT.radius_m   # a line of two stations goes the whole way
    assert rows(nearest_paths(replace(g, has_nearby_stop=near), limit)) == rows(nearest_paths(whole, limit))


def test_flags_of_the_whole_radius(looked):
    g, within, seen = looked
    whole = replace(g, has_nearby_stop=within(g.stations, DEFAULT.radius_m))
    for n in (2, 12, 13):
        p = replace(DEFAULT, min_routes=n)
        near = gridlock_edges(g, within, p)
        assert n > 2 or near.count() < whole.has_nearby_stop.count()
        assert rows(gridlock_lines(replace(g, has_nearby_stop=near), p)) == rows(gridlock_lines(whole, p))
