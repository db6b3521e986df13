"""What the readers reject, the order of writes over documents, and state that must not go stale."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from detour import jobs, schemas as S
from detour.operators import graph as G
from detour.operators.upsert import upsert
from detour.session import fresh_path
from detour.sources import documents as D
from detour.sources.tables import load_table
from detour.streaming.processor import current_snapshot, publish_snapshot, write_options_snapshot

METRO = "NaptanMetroStation"


def station(i, name, **more):
    return {"id": i, "commonName": name, "lat": 51.5, "lon": -0.1, "stopType": METRO, **more}


def test_a_status_array_in_any_layout(spark, tmp_path):
    lines = [{"id": f"l{i}", "name": "n", "lineStatuses": [{"statusSeverity": i}, {"statusSeverity": 9}]} for i in range(2)]
    for k, text in enumerate((json.dumps(lines), json.dumps(lines, indent=2))):
        p = tmp_path / f"{k}.json"
        p.write_text(text)
        got = jobs.status_events(spark, str(p), multiline=True).collect()
        assert sorted((r.line_id, r.severity_code) for r in got) == [("l0", 0), ("l1", 1)]
    (tmp_path / "broken.json").write_text(json.dumps(lines[0]) + "\n{\"id\": \"x")
    raw = D.landed(D.read_line_status(spark, str(tmp_path / "broken.json")), fresh_path(spark, "test", "raw"))
    assert [r.raw for r in D.unparsed(raw, "k").collect()] == ['{"id": "x'] and D.parsed(raw).count() == 1


def test_the_last_document_wins(spark, tmp_path):
    for name, label in (("a", "old"), ("b", "new")):
        (tmp_path / f"{name}.json").write_text(json.dumps({"stopPoints": [station("X", "other"), station("S1", label)]}))
    docs = D.read_json(spark, str(tmp_path), S.STATION_DOC)
    got = upsert(None, G.stations_from_documents(docs), ["station_id"], ["seq"]).collect()
    assert {r.station_id: r.name for r in got} == {"S1": "new", "X": "other"}


def seed_files(tmp_path):
    files = {
        "st": [{"stopPoints": [station("S1", "One"), station("S2", None), {"commonName": "no id", "lat": 1.0, "lon": 1.0, "stopType": METRO}]}],
        "nb": [{"station_id": "S1", "stopPoints": [
            {"id": "B1", "commonName": "b", "lat": 51.5, "lon": -0.1, "distance": 3.0, "lines": [{"id": "r1", "name": "1"}, {"name": "no id"}]},
            {"commonName": "keyless", "lat": 51.5, "lon": -0.1, "lines": [{"id": "r9", "name": "9"}]}]}],
        "mb": [{"line_id": "central", "stops": [{"id": "S1", "stopType": METRO}, {"id": "S404", "stopType": METRO}, {"stopType": METRO}]},
               {"line_id": "empty", "stops": []}]}
    for k, rows in files.items():
        (tmp_path / f"{k}.json").write_text("\n".join(map(json.dumps, rows)) + ("\n{broken" if k == "st" else ""))
    return [str(tmp_path / f"{k}.json") for k in files]


def test_seed_rejects_and_reports(spark, tmp_path):
    out = fresh_path(spark, "test", "seed")
    assert tuple(jobs.seed(spark, *seed_files(tmp_path), out).first()) == (1, 1, 1, 1)
    g = jobs.read_graph(spark, out)
    assert [r.route_id for r in g.bus_routes.collect()] == ["r1"] and [r.line_id for r in g.lines.collect()] == ["central"]
    rejected = spark.read.parquet(f"{out}/rejected").groupBy("kind").count().collect()
    assert {r.kind: r["count"] for r in rejected} == {"station document": 1, "station": 2, "stop": 1, "route": 1, "member": 1}
    assert spark.read.parquet(f"{out}/key_violations").count() == 0
    assert [tuple(r) for r in spark.read.parquet(f"{out}/link_counts").collect()] == [("central", 2, 1, 1)]


def test_seed_without_nearby_documents(spark, tmp_path):
    st, _, mb = seed_files(tmp_path)
    points = spark.createDataFrame(
        [("B1", "near", 51.5005, -0.1, "NaptanPublicBusCoachTram", [("r1", "1")]), ("B2", "far", 51.6, -0.1, "NaptanPublicBusCoachTram", [("r2", "2")]),
         ("B3", "other kind", 51.5, -0.1, "x", [("r3", "3")])],
        "id string, commonName string, lat double, lon double, stopType string, lines array<struct<id:string,name:string>>")
    out = fresh_path(spark, "test", "seed")
    jobs.seed(spark, st, None, mb, out, stop_points=points)
    g = jobs.read_graph(spark, out)
    assert [(r.station_id, r.stop_id) for r in g.has_nearby_stop.collect()] == [("S1", "B1")]
    assert [(r.stop_id, r.name) for r in g.bus_stops.collect()] == [("B1", "near")] and g.served_by.count() == 1


def test_a_moved_station_has_the_stops_of_its_last_place(spark, tmp_path):
    _, _, mb = seed_files(tmp_path)
    st, ids = tmp_path / "moved.json", [f"S{i}" for i in range(20)]
    st.write_text("\n".join(json.dumps({"stopPoints": [{**station(i, "n"), "lat": lat} for i in ids]}) for lat in (51.5, 51.6)))
    points = spark.createDataFrame(
        [("B1", "old", 51.5005, -0.1, "NaptanPublicBusCoachTram", [("r1", "1")]), ("B2", "new", 51.6005, -0.1, "NaptanPublicBusCoachTram", [("r2", "2")])],
        "id string, commonName string, lat double, lon double, stopType string, lines array<struct<id:string,name:string>>")
    out = fresh_path(spark, "test", "seed")
    jobs.seed(spark, str(st), None, mb, out, stop_points=points)
    g = jobs.read_graph(spark, out)
    assert sorted((r.station_id, r.stop_id) for r in g.has_nearby_stop.collect()) == sorted((i, "B2") for i in ids)
    assert {r.lat for r in g.stations.collect()} == {51.6}


def test_appended_rows_are_read(spark):
    base = fresh_path(spark, "test", "tables")
    spark.range(5).write.parquet(f"{base}/t.parquet")
    assert load_table(spark, base, "t").count() == 5
    spark.range(7).write.mode("append").parquet(f"{base}/t.parquet")
    assert load_table(spark, base, "t").count() == 12


def test_a_snapshot_is_never_overwritten(spark):
    path = fresh_path(spark, "test", "options")
    write_options_snapshot(spark.range(2), path)
    with pytest.raises(AnalysisException):
        write_options_snapshot(spark.range(50), path)
    assert spark.read.parquet(path).count() == 2


def test_an_unreadable_pointer_is_an_error(spark, tmp_path):
    root = fresh_path(spark, "test", "root")
    assert current_snapshot(spark, root) == root
    publish_snapshot(spark, root, "x")
    assert current_snapshot(spark, root) == "x"
    (tmp_path / "_versions").mkdir()
    with pytest.raises(AnalysisException):   # a pointer folder without a readable table
        current_snapshot(spark, str(tmp_path))


def test_null_keys_are_replaced_like_others(spark):
    cur = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    inc = spark.createDataFrame([(None, "c", 1)], "k int, v string, seq int")
    for rows in (0, 10):
        got = upsert(cur, inc, ["k"], ["seq"], max_broadcast_rows=rows)
        assert sorted(map(repr, (tuple(r) for r in got.select("k", "v").collect()))) == sorted(map(repr, [(None, "c"), (1, "b")]))
        assert got.filter(F.col("is_updated")).count() == 1
