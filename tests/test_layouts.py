"""The crowded radius join, lookups by key, bucketed paths, options without a cap, and faults by field."""

import random

import pytest
from pyspark.sql import functions as F

from detour.functions.geo import EARTH_RADIUS_M, lat_step
from detour.operators import geo_cells as C
from detour.operators import lookup as L
from detour.operators.options import line_options
from detour.operators.parse import field_faults
from detour.operators.path_tables import bucketed_path_rows, write_path_tables
from detour.operators.paths import nearest_paths, path_rows, restrict_line
from detour.operators.uncapped import gridlock_lines, uncapped_options
from detour.params import Params
from detour.plans import proxy
from detour.session import fresh_path
from tests.conftest import SF
from tests.test_geo import brute

POINT = "long, lat double, lon double"


def _sides(spark, left, right):
    return spark.createDataFrame(left, "station_id " + POINT), spark.createDataFrame(right, "stop_id " + POINT)


def _pairs(spark, left, right, r, most):
    a, b = _sides(spark, left, right)
    rows = C.adaptive_radius_join(a, b, r, most=most).collect()
    assert len(rows) == len({(x.station_id, x.stop_id) for x in rows}) and all(x.distance_metres <= r for x in rows)
    return {(x.station_id, x.stop_id) for x in rows}


def _cloud(rnd, n, lat, lon, width):
    return [(i, lat + rnd.random() * width, lon + rnd.random() * width) for i in range(n)]


@pytest.mark.parametrize("most", [4, 100, 1_000_000])
def test_crowded_join_matches_brute_force(spark, most):
    rnd = random.Random(most)
    left = _cloud(rnd, 40, 51.5, -0.1, 0.006) + [(100 + i, 51.5, -0.1) for i in range(10)]
    right = _cloud(rnd, 150, 51.5, -0.1, 0.006) + [(1000 + i, 51.5, -0.1) for i in range(20)]
    assert _pairs(spark, left, right, 300.0, most) == brute(left, right, 300.0)


def test_crowded_join_at_the_poles_and_the_antimeridian(spark):
    rnd = random.Random(4)
    left = [(i, 89.99 - rnd.random() * 0.01, rnd.uniform(-180, 180)) for i in range(25)]
    left += [(100 + i, 60 + rnd.random() * 0.002, 179.998 + rnd.random() * 0.004) for i in range(25)]
    right = [(i, 89.99 - rnd.random() * 0.01, rnd.uniform(-180, 180)) for i in range(60)]
    right += [(100 + i, 60 + rnd.random() * 0.002, -180.002 + rnd.random() * 0.004) for i in range(60)]
    bad = [(900, float("nan"), 0.0), (901, None, 0.0), (902, 95.0, 0.0)]
    want = brute(left, right, 300.0)
    assert want and _pairs(spark, left + bad, right + bad, 300.0, 20) == want


def test_split_cells_leave_few_candidates(spark):
    """Two crowds in one cell, farther apart than the radius: none of their pairs is a candidate. One crowd within the radius: no
    pair is tested."""
    rnd, r = random.Random(6), 300.0
    left = _cloud(rnd, 200, 51.5, -0.1, 0.0002)
    right = [(i, la, lo) for i, la, lo in _cloud(rnd, 200, 51.5036, -0.1, 0.0002)] + [(500 + i, la, lo) for i, la, lo in _cloud(rnd, 200, 51.5, -0.1, 0.0002)]
    a, b = _sides(spark, left, right)
    dlat = lat_step(r)
    args = (dlat, r, EARTH_RADIUS_M, [])
    levels, _, _ = C.cell_pairs(C._placed(a, "station_id", "l", *args), C._placed(b, "stop_id", "r", *args), fresh_path(spark, "t"), r, dlat,
                                EARTH_RADIUS_M, 100)
    rows = [x for p in levels for x in p.collect()]
    want = len(brute(left, right, r))
    assert want == 200 * 200 and sum(x.l_n * x.r_n for x in rows) == want and all(x.inside for x in rows)


def _scanned(df) -> dict[str, int]:
    """Rows that the scans of an executed plan gave, by column read first."""
    df.collect()
    out, todo = {}, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "FileSourceScanExec":
            out[node.output().mkString(",")] = node.metrics().apply("numOutputRows").value()
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return out


def test_lookup_skips_row_groups(spark):
    path = fresh_path(spark, "clustered-test")
    edges = spark.range(200_000).select((F.col("id") * 7919 % 2000).alias("station_id"), F.col("id").alias("stop_id"), F.rand(1).alias("distance_metres"))
    L.write_clustered_table(edges, "station_id", path, row_group_bytes=32 << 10)
    wanted = spark.createDataFrame([(3,), (1777,), (None,)], "station_id long")
    found = L.restrict_to(spark.read.parquet(path), "station_id", wanted)
    assert found.count() == 200
    rows = _scanned(L.restrict_to(spark.read.parquet(path), "station_id", wanted))
    assert len(rows) == 1 and 200 <= next(iter(rows.values())) < 40_000
    assert L.restrict_to(spark.read.parquet(path), "station_id", wanted, max_keys=1).count() == 200   # by a join


@pytest.mark.parametrize("max_keys", [0, 256])
def test_lookup_gives_the_nearest_paths_of_the_line(spark, max_keys):
    g, path = proxy.listed_graph(spark, SF), fresh_path(spark, "clustered-test")
    L.write_clustered(g, path)
    known = g.serves.agg(F.min("line_id")).first()[0]
    for line in (known, 999):
        want = sorted(map(tuple, nearest_paths(restrict_line(g, line), 100).collect()))
        assert sorted(map(tuple, L.lookup_paths(spark, path, line, max_keys=max_keys).collect())) == want
        assert bool(want) == (line == known)


def test_bucketed_paths_move_no_table(spark):
    g, path = proxy.graph(spark, SF), fresh_path(spark, "path-tables-test")
    write_path_tables(g, path, buckets=4, parts=3)
    want = sorted(map(tuple, path_rows(g).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        rows = bucketed_path_rows(spark, path)
        assert sorted(map(tuple, rows.collect())) == want and want
        p = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in p and "Exchange" not in p
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucketed_paths_open_in_another_session(spark):
    g, path = proxy.graph(spark, SF), fresh_path(spark, "path-tables-test")
    write_path_tables(g, path, buckets=2, parts=2)
    n = bucketed_path_rows(spark, path).count()
    from detour.operators.path_tables import _table
    for t in ("calls", "hops"):
        spark.sql(f"DROP TABLE {_table(path, t)}")   # the files stay: the tables aren't managed
    assert bucketed_path_rows(spark, path).count() == n == path_rows(g).count()


@pytest.mark.parametrize("min_routes", [1, 3, 12, 26])
def test_uncapped_options_equal_those_of_all_paths(spark, min_routes):
    p = Params(path_limit=None, min_routes=min_routes)
    g = proxy.graph_with_gaps(spark, SF)
    want = line_options(nearest_paths(g, None), g.lines, p)
    cols = ["line_id", "graph_line_name", "n_stations", "n_routes", "display_routes", "gridlock_alert"]
    assert sorted(uncapped_options(g, p).select(cols).collect()) == sorted(want.select(cols).collect())
    assert sorted(gridlock_lines(g, p).collect()) == sorted(want.select("line_id", "gridlock_alert").collect())


def test_first_names_are_cut_before_the_shuffle(spark):
    plan = gridlock_lines(proxy.listed_graph(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "collect_set" not in plan


def test_faults_by_field(spark):
    texts = ['{"line_id":"a","severity_code":3,"is_disrupted":true}', '{"line_id":"a","severity_code":"x","is_disrupted":1}',
             '{"severity_code":null,"line_id":null,"extra":[1,2]}', '{"line_id":', "[1, 2]", None, '""', "{}"]
    rec = spark.createDataFrame([(None if t is None else bytearray(t.encode()), None) for t in texts], "value binary, timestamp timestamp")
    got = sorted((r.raw_value or "", r.field, r.fault, r.given) for r in field_faults(rec, required=["line_id"]).collect())
    assert got == sorted([
        (texts[1], "severity_code", "wrong type", "x"), (texts[1], "is_disrupted", "wrong type", "1"),
        (texts[2], "line_id", "missing", None), (texts[2], "extra", "unknown field", "[1,2]"),
        (texts[3], "", "not an object", None), (texts[4], "", "not an object", None), ("", "", "not an object", None),
        (texts[6], "", "not an object", None), (texts[7], "line_id", "missing", None)])
    assert field_faults(rec.limit(0)).count() == 0
