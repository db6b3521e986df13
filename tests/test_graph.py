"""Graph build from documents: P7-P9, P14, F3, F9, K3/K4, T6, U1, U2, J4, J6, A10 and D8/D9/D11-D13."""

import json

import pytest
from pyspark.sql import functions as F

from detour import schemas as S
from detour.operators import graph as G
from detour.operators.upsert import upsert


def _docs(spark, tmp_path, name, rows, schema):
    p = tmp_path / f"{name}.json"
    p.write_text("\n".join(json.dumps(r) for r in rows))
    return spark.read.schema(schema).json(str(p))


@pytest.fixture()
def docs(spark, tmp_path):
    stations = _docs(spark, tmp_path, "stations", [{"stopPoints": [
        {"id": "S1", "commonName": "Oxford Circus", "lat": 51.515, "lon": -0.141, "stopType": "NaptanMetroStation"},
        {"id": "S2", "commonName": "Bond Street", "lat": 51.514, "lon": -0.149, "stopType": "NaptanMetroStation"},
        {"id": "X9", "commonName": "Some Bus Stop", "lat": 51.5, "lon": -0.1, "stopType": "NaptanPublicBusCoachTram"},
    ]}], S.STATION_DOC)
    nearby = _docs(spark, tmp_path, "nearby", [
        {"station_id": "S1", "stopPoints": [
            {"id": "B1", "commonName": "Stop One", "lat": 51.516, "lon": -0.140, "distance": 50,
             "lines": [{"id": "r73", "name": "73"}, {"id": "r390", "name": "390"}]},
            {"id": "B2", "commonName": "Stop Two", "lat": 51.514, "lon": -0.142, "distance": 120.5,
             "lines": [{"id": "r8", "name": "8"}]}]},
        {"station_id": "S2", "stopPoints": [
            {"id": "B2", "commonName": "Stop Two (renamed)", "lat": 51.514, "lon": -0.142, "distance": 200.0,
             "lines": [{"id": "r8", "name": None}]},
            {"id": "B3", "commonName": "Stop Three", "lat": 51.513, "lon": -0.150}]},
        {"station_id": "S_MISSING", "stopPoints": [
            {"id": "B9", "commonName": "Orphan", "lat": 51.0, "lon": 0.0, "distance": 10, "lines": []},
            {"id": "B1", "commonName": "Stop One elsewhere", "lat": 51.0, "lon": 0.0, "distance": 5,
             "lines": [{"id": "r999", "name": "999"}]}]},
    ], S.NEARBY_DOC)
    members = _docs(spark, tmp_path, "members", [
        {"line_id": "central", "stops": [{"id": "S1", "stopType": "NaptanMetroStation"},
                                         {"id": "S2", "stopType": "NaptanMetroStation"},
                                         {"id": "S404", "stopType": "NaptanMetroStation"},
                                         {"id": "B1", "stopType": "NaptanPublicBusCoachTram"}]},
        {"line_id": "waterloo-city", "stops": []},
        {"line_id": "hammersmith-city", "stops": [{"id": "S2", "stopType": "NaptanMetroStation"}]},
    ], S.MEMBERSHIP_DOC)
    return stations, nearby, members


def _rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((x is None, x if x is not None else 0) for x in t))


def test_build_graph(spark, docs):
    g = G.build_graph(*docs)
    assert _rows(g.stations, "station_id", "name") == [("S1", "Oxford Circus"), ("S2", "Bond Street")]
    # A line without stations is not a node; F3 names
    assert _rows(g.lines, "line_id", "name") == [("central", "Central"), ("hammersmith-city", "Hammersmith City")]
    # U1 + D12: B2 reached from two stations is one node; the later write wins
    assert _rows(g.bus_stops, "stop_id", "name") == [("B1", "Stop One"), ("B2", "Stop Two (renamed)"),
                                                     ("B3", "Stop Three")]
    # A missing distance is stored as 0.0 (double); two edges for B2
    assert _rows(g.has_nearby_stop, "station_id", "stop_id", "distance_metres") == [
        ("S1", "B1", 50.0), ("S1", "B2", 120.5), ("S2", "B2", 200.0), ("S2", "B3", 0.0)]
    # Later null name overwrites
    assert _rows(g.bus_routes, "route_id", "name") == [("r390", "390"), ("r73", "73"), ("r8", None)]
    # Serves only to existing stations (S404 dropped), stop types filtered (B1 is not a station)
    assert _rows(g.serves, "line_id", "station_id") == [("central", "S1"), ("central", "S2"),
                                                        ("hammersmith-city", "S2")]
    assert _rows(g.served_by, "stop_id", "route_id") == [("B1", "r390"), ("B1", "r73"), ("B2", "r8")]


def test_summary_always_one_row(spark, docs):
    g = G.build_graph(*docs)
    r = G.graph_summary(g).collect()
    assert [tuple(x) for x in r] == [(2, 2, 3, 3)]
    empty = G.Graph(*[t.limit(0) for t in g.tables().values()])
    assert [tuple(x) for x in G.graph_summary(empty).collect()] == [(0, 0, 0, 0)]


def test_link_counts_report_missing(spark, docs):
    members = G.members_from_documents(docs[2])
    stations = G.stations_from_documents(docs[0])
    got = {r.line_id: (r.n_members, r.linked, r.missing)
           for r in G.link_counts(members, stations, "line_id", "station_id", "station_id").collect()}
    assert got == {"central": (3, 2, 1), "hammersmith-city": (1, 1, 0)}


def test_key_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    assert _rows(G.key_violations(df, ["k"]), "k", "n_rows") == [(1, 2), (None, 1)]


def test_upsert_modes(spark):
    cur = spark.createDataFrame([(1, "old1"), (2, "old2")], "k int, v string")
    inc = spark.createDataFrame([(2, "new2a", 1), (2, None, 2), (3, "new3", 1)], "k int, v string, seq int")
    up = upsert(cur, inc, ["k"], ["seq"])
    assert _rows(up, "k", "v", "is_updated") == [(1, "old1", False), (2, None, True), (3, "new3", True)]
    rep = upsert(cur, inc, ["k"], ["seq"], mode="replace")
    assert _rows(rep, "k", "v") == [(2, None), (3, "new3")]


def test_upsert_on_existing_graph_keeps_vanished(spark, docs):
    g = G.build_graph(*docs)
    stations, nearby, members = docs
    g2 = G.build_graph(stations, nearby.filter(F.col("station_id") == "S1"), members, current=g)
    # B3 (only listed near S2 before) is still there
    assert "B3" in [r.stop_id for r in g2.bus_stops.collect()]
    g3 = G.build_graph(stations, nearby.filter(F.col("station_id") == "S1"), members, current=g, mode="replace")
    assert "B3" not in [r.stop_id for r in g3.bus_stops.collect()]


def test_flatten_and_sizes(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "k int, xs array<string>")
    assert _rows(G.flatten_list(df, "k", "xs", "x"), "k", "pos", "x", "list_size") == [(1, 0, "a", 2), (1, 1, "b", 2)]


def test_integer_distance_is_stored_as_double(spark, tmp_path):
    """An integer distance (0) becomes 0.0 in a double column."""
    nearby = _docs(spark, tmp_path, "nb_int", [{"station_id": "S1", "stopPoints": [
        {"id": "B1", "commonName": "x", "lat": 1.0, "lon": 2.0, "distance": 0, "lines": []}]}], S.NEARBY_DOC)
    _, near, _, _ = G.nearby_from_documents(nearby)
    r = near.first()
    assert near.schema["distance_metres"].dataType.typeName() == "double" and r.distance_metres == 0.0
