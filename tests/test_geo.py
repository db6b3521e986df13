"""J3 radius join: grid-cell equi-join equals the brute-force cross product."""

import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from detour.functions.geo import EARTH_RADIUS_M, haversine_m
from detour.operators.geo_join import radius_join


def brute(left_pts, right_pts, r):
    out = set()
    for k1, la1, lo1 in left_pts:
        for k2, la2, lo2 in right_pts:
            p1, p2 = math.radians(la1), math.radians(la2)
            a = math.sin(math.radians(la2 - la1) / 2) ** 2 + \
                math.cos(p1) * math.cos(p2) * math.sin(math.radians(lo2 - lo1) / 2) ** 2
            d = 2 * EARTH_RADIUS_M * math.asin(math.sqrt(min(a, 1.0)))
            if d <= r:
                out.add((k1, k2))
    return out


def _run(spark, left_pts, right_pts, r):
    L = spark.createDataFrame(left_pts, "station_id long, lat double, lon double")
    R = spark.createDataFrame(right_pts, "stop_id long, lat double, lon double")
    return {(x.station_id, x.stop_id) for x in radius_join(L, R, r).collect()}


def test_haversine_one_degree_latitude(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0, 0.0)], "a double, b double, c double, d double")
    d = df.select(haversine_m("a", "b", "c", "d").alias("m")).first().m
    assert abs(d - EARTH_RADIUS_M * math.pi / 180) < 1e-6


def test_london_points_match_brute_force(spark):
    rnd = random.Random(3)
    L = [(i, 51.45 + rnd.random() * 0.1, -0.2 + rnd.random() * 0.16) for i in range(60)]
    R = [(i, 51.45 + rnd.random() * 0.1, -0.2 + rnd.random() * 0.16) for i in range(400)]
    want = brute(L, R, 300.0)
    assert want and _run(spark, L, R, 300.0) == want


def test_points_on_cell_edges_and_antimeridian(spark):
    dlat = math.degrees(300.0 / EARTH_RADIUS_M)
    L = [(1, 10 * dlat - 1e-9, 0.0), (2, 60.0, 179.9995), (3, -45.0, -179.9999)]
    R = [(10, 10 * dlat + 1e-9, 0.0), (11, 60.0, -179.9998), (12, -45.0, 179.9999), (13, 60.0, 179.99)]
    assert _run(spark, L, R, 300.0) == brute(L, R, 300.0) == {(1, 10), (2, 11), (3, 12)}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.floats(-70, 70), st.floats(-180, 180)), min_size=1, max_size=25),
       st.lists(st.tuples(st.floats(-0.01, 0.01), st.floats(-0.01, 0.01)), min_size=1, max_size=8),
       st.sampled_from([50.0, 300.0, 1000.0]))
def test_property_random_clusters(spark, centres, jitter, r):
    L = [(i, la, lo) for i, (la, lo) in enumerate(centres)]
    R = [(100 * i + j, max(min(la + dj[0], 89.0), -89.0), ((lo + dj[1] + 180) % 360) - 180)
         for i, (la, lo) in enumerate(centres) for j, dj in enumerate(jitter)]
    assert _run(spark, L, R, r) == brute(L, R, r)


def test_shuffled_cell_join_matches(spark):
    rnd = random.Random(5)
    L = [(i, 51.45 + rnd.random() * 0.05, -0.2 + rnd.random() * 0.08) for i in range(50)]
    R = [(i, 51.45 + rnd.random() * 0.05, -0.2 + rnd.random() * 0.08) for i in range(300)]
    Ld = spark.createDataFrame(L, "station_id long, lat double, lon double")
    Rd = spark.createDataFrame(R, "stop_id long, lat double, lon double")
    j = radius_join(Ld, Rd, 300.0, max_broadcast_points=0)
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
    assert {(x.station_id, x.stop_id) for x in j.collect()} == brute(L, R, 300.0)


def test_polar_points_match_brute_force(spark):
    rnd = random.Random(11)
    L = [(i, 89.99 - rnd.random() * 0.01, rnd.uniform(-180, 180)) for i in range(40)]
    R = [(i, 89.99 - rnd.random() * 0.01, rnd.uniform(-180, 180)) for i in range(120)]
    want = brute(L, R, 300.0)
    assert want and _run(spark, L, R, 300.0) == want


def test_cells_cover_the_haversine_bound(spark):
    """The widest longitude gap of a 300 m pair with an end in the band fits in one cell of it."""
    from pyspark.sql import functions as F

    from detour.functions.geo import lat_step, lon_cells
    dlat = lat_step(300.0)
    assert dlat >= math.degrees(300.0 / EARTH_RADIUS_M)
    lats = [0.0, 45.0, -70.0, 85.0, 89.9, -89.9999, 89.9999]
    rows = spark.createDataFrame([(la, int((la + 90) // dlat)) for la in lats], "lat double, band long")
    for r in rows.withColumn("n", lon_cells(F.col("band"), dlat, 300.0)).collect():
        s = math.sin(300.0 / (2 * EARTH_RADIUS_M)) / math.cos(math.radians(r.lat))
        assert r.n == 1 or 360.0 / r.n >= math.degrees(2 * math.asin(s))
        assert abs(r.lat) > 85 or r.n > 5000   # a point elsewhere doesn't widen these cells


def test_one_bad_latitude_changes_nothing_else(spark):
    """A polar, a NaN, a null and an impossible place among London points."""
    rnd = random.Random(8)
    L = [(i, 51.45 + rnd.random() * 0.05, -0.2 + rnd.random() * 0.08) for i in range(30)]
    R = [(i, 51.45 + rnd.random() * 0.05, -0.2 + rnd.random() * 0.08) for i in range(200)]
    want = brute(L, R, 300.0)
    bad = [(900, float("nan"), 0.0), (901, 89.99999, 10.0), (902, 95.0, 0.0), (903, None, 0.0), (904, 51.5, float("nan")), (905, 90.0, -120.0)]
    assert _run(spark, L + bad, R + bad, 300.0) == want | {(901, 901), (901, 905), (905, 901), (905, 905)}


def test_crowded_candidates_are_dealt_into_slices(spark):
    """Tasks are made for candidates, not bytes: one cell's pairs don't stay in one task, and duplicates pair as before."""
    rnd = random.Random(9)
    L = [(i % 35, 51.5 + rnd.random() * 0.002, -0.1 + rnd.random() * 0.002) for i in range(40)] + [(90, 60.0, 179.9995), (91, None, 0.0)]
    R = [(i, 51.5 + rnd.random() * 0.002, -0.1 + rnd.random() * 0.002) for i in range(400)] + [(900, 60.0, -179.9998), (901, 95.0, 0.0)]
    Ld = spark.createDataFrame(L, "station_id long, lat double, lon double")
    Rd = spark.createDataFrame(R + R[:50], "stop_id long, lat double, lon double")
    plain, dealt = radius_join(Ld, Rd, 100.0), radius_join(Ld, Rd, 100.0, task_candidates=500)
    key = lambda df: sorted((r.station_id, r.stop_id, r.distance_metres) for r in df.collect())
    assert key(dealt) == key(plain) and {k[:2] for k in key(dealt)} == brute([x for x in L if x[1]], R, 100.0)
    per_task = [len(t) for t in dealt.rdd.glom().collect()]
    assert max(per_task) < sum(per_task) / 3


def test_quick_bound_keeps_every_pair(spark):
    """The products that go before the exact distance lose no pair, however near the radius."""
    from pyspark.sql import functions as F

    from detour.functions.geo import maybe_within
    rnd, rows = random.Random(4), []
    for _ in range(2000):
        lat, lon, step = rnd.uniform(-89.9, 89.9), rnd.uniform(-180, 180), 10 ** rnd.uniform(-6, 2)
        rows.append((lat, lon, max(min(lat + rnd.uniform(-step, step), 90.0), -90.0), lon + rnd.uniform(-step, step)))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").withColumn("m", haversine_m("a", "b", "c", "d"))
    cos = lambda c: F.cos(F.radians(c))
    for r in (0.5, 300.0, 1e6):
        q = maybe_within(F.col("a"), cos("a"), F.col("b"), F.col("c"), cos("c"), F.col("d"), r)
        assert df.filter(F.col("m") <= r).count() > 0 and df.filter((F.col("m") <= r) & ~q).isEmpty()
