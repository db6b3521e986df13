"""J1, J2, T1-T3, A2-A6 and the D1-D5 edge rows."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from detour.operators.alerts import build_alerts
from detour.operators.graph import Graph
from detour.operators.options import line_options
from detour.operators.paths import nearest_paths, path_rows
from detour.params import Params


def make_graph(spark, near, routes, lines=("L",), stations=None):
    """near: (station, stop, distance); routes: (stop, route_id, route_name)."""
    stations = stations or sorted({s for s, _, _ in near})
    stops = sorted({b for _, b, _ in near} | {b for b, _, _ in routes})
    rids = sorted({(r, n) for _, r, n in routes}, key=lambda x: x[0])
    return Graph(
        lines=spark.createDataFrame([(x, x.title()) for x in lines], "line_id string, name string"),
        stations=spark.createDataFrame([(s, f"name-{s}", 0.0, 0.0) for s in stations],
                                       "station_id string, name string, lat double, lon double"),
        bus_stops=spark.createDataFrame([(b, f"stop-{b}", 1.0, 2.0) for b in stops],
                                        "stop_id string, name string, lat double, lon double"),
        bus_routes=spark.createDataFrame(rids, "route_id string, name string"),
        serves=spark.createDataFrame([(ln, s) for ln in lines for s in stations], "line_id string, station_id string"),
        has_nearby_stop=spark.createDataFrame(near, "station_id string, stop_id string, distance_metres double"),
        served_by=spark.createDataFrame([(b, r) for b, r, _ in routes], "stop_id string, route_id string"),
    )


def _events(spark, line_ids):
    return spark.createDataFrame(
        [("tube_line_status", x, x, 5, "Severe", True, None, "t") for x in line_ids],
        "event_type string, line_id string, line_name string, severity_code int, severity_desc string, "
        "is_disrupted boolean, disruption_detail string, ingested_at_utc string"
    ).withColumn("processed_at_utc", F.lit("2024-01-01 00:00:00").cast("timestamp"))


def _alert(spark, g, line_ids, p=Params()):
    opts = line_options(nearest_paths(g, p.path_limit), g.lines, p)
    return {r.line_id: r for r in build_alerts(_events(spark, line_ids), opts, p).collect()}


def test_two_routes_gridlock_three_not(spark):
    g2 = make_graph(spark, [("S", "B1", 10.0), ("S", "B2", 20.0)], [("B1", "r1", "1"), ("B2", "r2", "2")])
    assert _alert(spark, g2, ["L"])["L"].gridlock_alert is True
    g3 = make_graph(spark, [("S", "B1", 10.0), ("S", "B2", 20.0)],
                    [("B1", "r1", "1"), ("B2", "r2", "2"), ("B2", "r3", "3")])
    a = _alert(spark, g3, ["L"])["L"]
    assert a.gridlock_alert is False and a.available_routes == ["1", "2", "3"]
    assert a.affected_stations == ["name-S"]
    assert [x.route_name for x in a.nearby_bus_stops] == ["1", "2", "3"]


def test_cap_applies_before_distinct(spark):
    """101 path rows, the third route only on row 101 -> still gridlock."""
    near = [("S", f"B{i:03d}", float(i)) for i in range(101)]
    routes = [(f"B{i:03d}", "r1" if i % 2 else "r2", "1" if i % 2 else "2") for i in range(100)] + [("B100", "r3", "3")]
    g = make_graph(spark, near, routes)
    a = _alert(spark, g, ["L"])["L"]
    assert a.gridlock_alert is True and a.available_routes == ["1", "2"]
    assert len(a.nearby_bus_stops) == 20
    uncapped = _alert(spark, g, ["L"], Params(path_limit=None))["L"]
    assert uncapped.gridlock_alert is False


def test_null_distance_sorts_last(spark):
    g = make_graph(spark, [("S", "B1", None), ("S", "B2", 30.0)], [("B1", "r1", "1"), ("B2", "r2", "2")])
    rows = nearest_paths(g, 100).orderBy("rn").collect()
    assert [r.bus_stop_id for r in rows] == ["B2", "B1"]


def test_null_route_name_counts_once(spark):
    g = make_graph(spark, [("S", "B1", 1.0), ("S", "B2", 2.0), ("S", "B3", 3.0)],
                   [("B1", "r1", None), ("B2", "r2", None), ("B3", "r3", "3")])
    a = _alert(spark, g, ["L"])["L"]
    assert a.available_routes == [None, "3"] and a.gridlock_alert is True


def test_unknown_line_still_alerts(spark):
    g = make_graph(spark, [("S", "B1", 1.0)], [("B1", "r1", "1")])
    a = _alert(spark, g, ["L", "nowhere"])
    assert set(a) == {"L", "nowhere"}
    u = a["nowhere"]
    assert u.gridlock_alert is True and u.affected_stations == [] and u.nearby_bus_stops == []
    assert u.is_known_line is False and a["L"].is_known_line is True


def test_ties_break_by_ids(spark):
    g = make_graph(spark, [("S2", "B1", 5.0), ("S1", "B2", 5.0), ("S1", "B1", 5.0)],
                   [("B1", "rb", "b"), ("B1", "ra", "a"), ("B2", "rc", "c")], stations=["S1", "S2"])
    rows = nearest_paths(g, 100).orderBy("rn").collect()
    assert [(r.station_id, r.stop_id, r.route_id) for r in rows] == [
        ("S1", "B1", "ra"), ("S1", "B1", "rb"), ("S1", "B2", "rc"), ("S2", "B1", "ra"), ("S2", "B1", "rb")]


def test_cut_equals_full_ranking(spark):
    """The partial cut never changes the top-k rows."""
    rnd = random.Random(7)
    near, routes = [], []
    for s in range(6):
        for b in rnd.sample(range(40), 15):
            near.append((f"S{s}", f"B{b:02d}", float(rnd.choice(range(20))) if rnd.random() > .1 else None))
    for b in range(40):
        for r in rnd.sample(range(8), rnd.choice([0, 1, 2, 3])):
            routes.append((f"B{b:02d}", f"r{r}", f"{r}"))
    g = make_graph(spark, near, routes, lines=("L1", "L2"))
    for k in (1, 7, 25, 60):
        fast = nearest_paths(g, k).select("line_id", "station_id", "stop_id", "route_id", "rn")
        w = Window.partitionBy("line_id").orderBy(
            F.col("distance_metres").asc_nulls_last(), "station_id", "stop_id", "route_id")
        slow = path_rows(g).withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= k) \
            .select("line_id", "station_id", "stop_id", "route_id", "rn")
        assert sorted(fast.collect()) == sorted(slow.collect())


def test_point_lookup_by_line(spark):
    """The lookup of one line equals that line's slice of the all-lines ranking."""
    from detour.operators.paths import restrict_line
    near = [("S1", "B1", 3.0), ("S2", "B2", 1.0), ("S3", "B3", 2.0)]
    routes = [("B1", "r1", "1"), ("B2", "r2", "2"), ("B3", "r3", "3")]
    g = make_graph(spark, near, routes, lines=("L1", "L2"))
    g = g.__class__(**{**g.tables(), "serves": spark.createDataFrame(
        [("L1", "S1"), ("L1", "S2"), ("L2", "S3")], "line_id string, station_id string")})
    one = nearest_paths(restrict_line(g, "L1"), 100).select("stop_id", "rn").collect()
    assert sorted(tuple(r) for r in one) == [("B1", 2), ("B2", 1)]
    full = nearest_paths(g, 100).filter(F.col("line_id") == "L1").select("stop_id", "rn").collect()
    assert sorted(tuple(r) for r in full) == sorted(tuple(r) for r in one)


def test_report_columns_and_order(spark):
    """P13 + T4 + T5 over a small history."""
    from detour.operators.reports import alert_summary, first_alerts, latest_alerts
    h = spark.createDataFrame(
        [(f"L{i % 3}", "Severe", i % 2 == 0, f"2024-01-01 00:00:{i:02d}", i) for i in range(15)],
        "line_name string, severity string, gridlock_alert boolean, processed_at_utc string, k int")
    top = latest_alerts(h, 10, tie_breakers=["k"])
    assert top.columns == ["line_name", "severity", "gridlock_alert", "processed_at_utc", "k"]
    assert [r.k for r in top.collect()] == list(range(14, 4, -1))
    assert [r.k for r in first_alerts(h, 4, order=["k"]).collect()] == [0, 1, 2, 3]
    s = alert_summary(h).first()
    assert (s.total_alerts, s.unique_lines, s.first_processed_at, s.last_processed_at) == \
        (15, 3, "2024-01-01 00:00:00", "2024-01-01 00:00:14")


def test_hot_line_and_hot_stop_stay_exact(spark):
    """One line owns almost all pairs and one stop lists more routes than the cap:
    the pair and per-stop route cuts still give the exact top rows."""
    near = [("S0", f"B{i:03d}", float(i % 7)) for i in range(300)] + [("S9", "B999", 1.0)]
    routes = [("B000", f"r{j:03d}", f"{j}") for j in range(150)]
    routes += [(f"B{i:03d}", f"q{i % 5}", f"q{i % 5}") for i in range(1, 300)] + [("B999", "z", "z")]
    g = make_graph(spark, near, routes, lines=("HOT",), stations=["S0", "S9"])
    g = g.__class__(**{**g.tables(), "lines": spark.createDataFrame(
        [("HOT", "Hot"), ("COLD", "Cold")], "line_id string, name string"),
        "serves": spark.createDataFrame([("HOT", "S0"), ("COLD", "S9")], "line_id string, station_id string")})
    for k in (5, 100):
        fast = nearest_paths(g, k).select("line_id", "station_id", "stop_id", "route_id", "rn")
        w = Window.partitionBy("line_id").orderBy(
            F.col("distance_metres").asc_nulls_last(), "station_id", "stop_id", "route_id")
        slow = path_rows(g).withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= k) \
            .select("line_id", "station_id", "stop_id", "route_id", "rn")
        got = sorted(fast.collect())
        assert got == sorted(slow.collect())
        assert sum(1 for r in got if r.line_id == "HOT") == k


def test_alerts_same_with_and_without_broadcast(spark):
    """bounded_options: beyond the bound the join is left to the planner (shuffle);
    the alerts are the same either way."""
    import re
    from detour.operators.options import bounded_options
    g = make_graph(spark, [("S", "B1", 1.0), ("S", "B2", 2.0)], [("B1", "r1", "1"), ("B2", "r2", "2")],
                   lines=("L", "M"))
    opts = line_options(nearest_paths(g, 100), g.lines)
    ev = _events(spark, ["L", "M", "X"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        small = build_alerts(ev, bounded_options(opts, g.lines), Params())
        large = build_alerts(ev, bounded_options(opts, g.lines, max_rows=1), Params())
        def plan(d):
            d.write.format("noop").mode("overwrite").save()
            return d._jdf.queryExecution().executedPlan().toString()
        join = r"{} \[line_id#\d+\], \[line_id#\d+\], LeftOuter"
        assert re.search(join.format("BroadcastHashJoin"), plan(small))
        assert re.search(join.format("SortMergeJoin"), plan(large))
        key = lambda d: sorted((r.line_id, r.gridlock_alert, tuple(r.available_routes)) for r in d.collect())
        assert key(small) == key(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_distance_steps_never_fall(spark):
    from detour.operators.paths import distance_step
    rnd = random.Random(2)
    values = [0.0, -0.0, 1e-300, -1e-300, 1e308, -1e308, float("inf"), float("-inf"), float("nan"), None, 299.99999999999994, 300.0, 300.00000000000006]
    values += [rnd.choice([-1, 1]) * 2 ** rnd.uniform(-20, 60) for _ in range(500)] + [float(i) for i in range(-40, 400)]
    df = spark.createDataFrame([(v,) for v in values], "distance_metres double").select("distance_metres", distance_step().alias("s"))
    got = [r.s for r in df.orderBy(F.col("distance_metres").asc_nulls_last()).collect()]
    assert got == sorted(got) and None not in got


def test_cut_with_odd_distances_and_dangling_edges(spark):
    """Null, NaN, negative and equal distances, pairs without routes, edges to nothing: the rows of full ranking."""
    rnd = random.Random(11)
    kinds = [None, float("nan"), float("inf"), -5.0, 0.0, 7.0, 7.0, 7.25, 300.0, 1e9]
    near = [(f"S{s}", f"B{b:02d}", rnd.choice(kinds)) for s in range(5) for b in rnd.sample(range(30), 14)]
    routes = [(f"B{b:02d}", f"r{r}", f"{r}") for b in range(30) for r in rnd.sample(range(9), rnd.choice([0, 0, 1, 4]))]
    g = make_graph(spark, near, routes, lines=("L1", "L2"))
    g = g.__class__(**{**g.tables(), "stations": g.stations.filter("station_id <> 'S3'"), "bus_stops": g.bus_stops.filter("stop_id <> 'B07'"),
                       "bus_routes": g.bus_routes.filter("route_id <> 'r2'"), "serves": g.serves.filter("NOT (line_id = 'L2' AND station_id < 'S2')")})
    cols = ["line_id", "station_id", "stop_id", "route_id", "rn"]
    w = Window.partitionBy("line_id").orderBy(F.col("distance_metres").asc_nulls_last(), "station_id", "stop_id", "route_id")
    slow = path_rows(g).withColumn("rn", F.row_number().over(w)).select(*cols).collect()
    for k in (0, 1, 2, 5, 13, 40, 10_000):
        assert sorted(nearest_paths(g, k).select(*cols).collect()) == sorted(r for r in slow if r.rn <= k)
