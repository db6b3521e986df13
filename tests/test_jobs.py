"""End-to-end: documents -> events -> broker files -> graph -> alert stream -> history -> reports."""

import json

from pyspark.sql import functions as F

from detour import jobs
from detour.operators.graph import nearby_by_radius
from detour.operators.geo_join import radius_join
from detour.schemas import BROKER_RECORD
from detour.session import fresh_path
from tests.test_graph import docs  # noqa: F401  (fixture)


def _write(tmp_path, name, rows):
    p = tmp_path / f"{name}.json"
    p.write_text("\n".join(json.dumps(r) for r in rows))
    return str(p)


def test_end_to_end(spark, tmp_path, docs):  # noqa: F811
    status = _write(tmp_path, "status", [
        {"id": "central", "name": "Central", "lineStatuses": [
            {"statusSeverity": 9, "statusSeverityDescription": "Minor Delays"},
            {"statusSeverity": 6, "statusSeverityDescription": "Severe Delays",
             "disruption": {"description": "Signal failure"}}]},
        {"id": "hammersmith-city", "name": "Hammersmith & City", "lineStatuses": [
            {"statusSeverity": 10, "statusSeverityDescription": "Good Service"}]},
        {"id": "victoria", "name": "Victoria", "lineStatuses": [
            {"statusSeverity": 3, "statusSeverityDescription": "Part Suspended", "disruption": None}]},
        {"id": "bakerloo", "name": "Bakerloo", "lineStatuses": []},
    ])
    broker = fresh_path(spark, "e2e", "broker")
    counts = jobs.ingest(spark, status, broker).collect()
    assert [(r.n_lines, r.n_ok, r.n_disrupted) for r in counts] == [(3, 1, 2)]
    # a malformed message on the same topic
    spark.createDataFrame([(b"{not json", None)], BROKER_RECORD).write.mode("append").parquet(broker)

    stations, nearby, members = docs
    sdir, ndir, mdir = (str(tmp_path / x) for x in ("st", "nb", "mb"))
    stations.write.json(sdir)
    nearby.write.json(ndir)
    members.write.json(mdir)
    gdir = fresh_path(spark, "e2e", "graph")
    summary = jobs.seed(spark, sdir, ndir, mdir, gdir).first()
    assert tuple(summary) == (2, 2, 3, 3)

    history, quarantine = fresh_path(spark, "e2e", "history"), fresh_path(spark, "e2e", "quarantine")
    records = spark.readStream.schema(BROKER_RECORD).parquet(broker)
    for q in jobs.stream(records, f"{gdir}/options", history, fresh_path(spark, "e2e", "ckpt"),
                         trigger={"availableNow": True}, quarantine_path=quarantine):
        q.awaitTermination()
    h = {r.line_id: r for r in spark.read.parquet(history).collect()}
    assert set(h) == {"central", "victoria"}
    c = h["central"]
    assert c.severity == "Severe Delays" and c.available_routes == [None, "390", "73"]
    assert c.affected_stations == ["Bond Street", "Oxford Circus"] and c.gridlock_alert is False
    assert [x.bus_stop_id for x in c.nearby_bus_stops] == ["B1", "B1", "B2", "B2"]
    v = h["victoria"]
    assert v.gridlock_alert is True and v.available_routes == []
    assert spark.read.parquet(quarantine).count() == 1

    rep = jobs.report(spark, history)
    s = rep["summary"].first()
    assert (s.total_alerts, s.unique_lines) == (2, 2)
    assert rep["latest"].count() == 2 and rep["first"].count() == 2


def test_nearby_by_radius_matches_cross_product(spark):
    stations = spark.createDataFrame([("S1", 51.5, -0.1), ("S2", 51.51, -0.12)],
                                     "station_id string, lat double, lon double")
    pts = spark.createDataFrame(
        [("B1", "one", 51.501, -0.1, "NaptanPublicBusCoachTram", [("r1", "1")]),
         ("B2", "two", 51.5, -0.1035, "NaptanPublicBusCoachTram", [("r1", "1"), ("r2", "2")]),
         ("B3", "far", 51.6, -0.1, "NaptanPublicBusCoachTram", [("r3", "3")]),
         ("M1", "metro", 51.5001, -0.1, "NaptanMetroStation", [("r4", "4")])],
        "id string, commonName string, lat double, lon double, stopType string, "
        "lines array<struct<id:string,name:string>>")
    stops, near, routes, served = nearby_by_radius(stations, pts, 300.0)
    assert sorted(r.stop_id for r in stops.collect()) == ["B1", "B2"]
    assert sorted((r.station_id, r.stop_id) for r in near.collect()) == [("S1", "B1"), ("S1", "B2")]
    assert sorted(r.route_id for r in routes.collect()) == ["r1", "r2"]
    assert served.count() == 3
    # same pairs as the join used directly
    direct = radius_join(stations, pts.filter(F.col("stopType") == "NaptanPublicBusCoachTram")
                         .withColumnRenamed("id", "stop_id"), 300.0)
    assert sorted(tuple(r) for r in near.collect()) == sorted(tuple(r) for r in direct.collect())


def test_streaming_ingest_and_cli_report(spark, tmp_path, capsys):
    from detour.__main__ import main
    from detour.sources.broker import to_broker_records
    from detour.operators.parse import parse_records

    land = tmp_path / "landing"
    land.mkdir()
    (land / "poll1.json").write_text("\n".join(json.dumps(r) for r in [
        {"id": "central", "name": "Central", "lineStatuses": [{"statusSeverity": 6}]},
        {"id": "victoria", "name": "Victoria", "lineStatuses": [{"statusSeverity": 10}]}]))
    events = jobs.status_events(spark, str(land), streaming=True)
    assert events.isStreaming
    out, ck = fresh_path(spark, "e2e", "events"), fresh_path(spark, "e2e", "ck")
    q = (to_broker_records(events, jobs.EVENT_FIELDS).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    back = parse_records(spark.read.parquet(out)).collect()
    assert sorted((r.line_id, r.is_disrupted, r.severity_desc) for r in back) == [
        ("central", True, "Unknown"), ("victoria", False, "Unknown")]
    assert all(r.ingested_at_utc.endswith("+00:00") for r in back)

    # the CLI report over a history written by the stream query
    from detour.streaming import jobs as J
    from tests.conftest import SF
    hist = fresh_path(spark, "cli", "history")
    J._run_alerts(spark, SF, hist, J._snapshot(spark, SF), "cli-run")
    main(["report", hist])
    text = capsys.readouterr().out
    assert "summary" in text and "latest" in text and "total_alerts" in text


def test_stream_picks_up_a_new_seed(spark, tmp_path, docs):  # noqa: F811
    """Batch 0 runs on graph v1; a re-seed published in between changes batch 1."""
    stations, nearby, members = docs
    sdir, mdir = str(tmp_path / "st"), str(tmp_path / "mb")
    stations.write.json(sdir)
    members.write.json(mdir)
    n1, n2 = str(tmp_path / "nb1"), str(tmp_path / "nb2")
    nearby.write.json(n1)
    nearby.filter(F.col("station_id") == "S2").write.json(n2)   # v2: S1 lists no stops
    root = fresh_path(spark, "e2e", "options_root")
    jobs.seed(spark, sdir, n1, mdir, fresh_path(spark, "e2e", "g1"), publish_root=root)

    status = lambda i: _write(tmp_path, f"status{i}", [
        {"id": "central", "name": "Central", "lineStatuses": [{"statusSeverity": 6}]}])
    broker = fresh_path(spark, "e2e", "broker2")
    jobs.ingest(spark, status(0), broker)
    history, ckpt = fresh_path(spark, "e2e", "history2"), fresh_path(spark, "e2e", "ckpt2")

    def run():
        records = spark.readStream.schema(BROKER_RECORD).option("maxFilesPerTrigger", "1").parquet(broker)
        for q in jobs.stream(records, root, history, ckpt, run_id="r", trigger={"availableNow": True}):
            q.awaitTermination()

    run()
    jobs.seed(spark, sdir, n2, mdir, fresh_path(spark, "e2e", "g2"), mode="replace", publish_root=root)
    jobs.ingest(spark, status(1), broker)
    run()
    got = {r.batch_id: r.available_routes for r in spark.read.parquet(history).collect()}
    assert got == {0: [None, "390", "73"], 1: [None]}


def test_seeded_tables_have_the_graph_contract(spark, tmp_path, docs):  # noqa: F811
    """FIXTURES A7/A8: node and edge tables with exactly these columns and types."""
    stations, nearby, members = docs
    paths = []
    for name, df in (("st", stations), ("nb", nearby), ("mb", members)):
        df.write.json(str(tmp_path / name))
        paths.append(str(tmp_path / name))
    out = fresh_path(spark, "e2e", "contract")
    jobs.seed(spark, *paths, out)
    want = {
        "lines": "struct<line_id:string,name:string>",
        "stations": "struct<station_id:string,name:string,lat:double,lon:double>",
        "bus_stops": "struct<stop_id:string,name:string,lat:double,lon:double>",
        "bus_routes": "struct<route_id:string,name:string>",
        "serves": "struct<line_id:string,station_id:string>",
        "has_nearby_stop": "struct<station_id:string,stop_id:string,distance_metres:double>",
        "served_by": "struct<stop_id:string,route_id:string>",
    }
    g = jobs.read_graph(spark, out)
    assert {t: getattr(g, t).schema.simpleString() for t in jobs.GRAPH_TABLES} == want


def test_seed_upserts_onto_a_written_graph(spark, tmp_path, docs):  # noqa: F811
    """D11 through the job: a second seed onto the first keeps what it no longer lists."""
    stations, nearby, members = docs
    for name, df in (("st", stations), ("nb", nearby), ("mb", members)):
        df.write.json(str(tmp_path / name))
    nearby.filter(F.col("station_id") == "S1").write.json(str(tmp_path / "nb_s1"))
    v1, v2, v3 = (fresh_path(spark, "e2e", v) for v in ("v1", "v2", "v3"))
    jobs.seed(spark, str(tmp_path / "st"), str(tmp_path / "nb"), str(tmp_path / "mb"), v1)
    jobs.seed(spark, str(tmp_path / "st"), str(tmp_path / "nb_s1"), str(tmp_path / "mb"), v2, current_dir=v1)
    jobs.seed(spark, str(tmp_path / "st"), str(tmp_path / "nb_s1"), str(tmp_path / "mb"), v3, current_dir=v1,
              mode="replace")
    stops = lambda v: sorted(r.stop_id for r in jobs.read_graph(spark, v).bus_stops.collect())
    assert stops(v1) == ["B1", "B2", "B3"]
    assert stops(v2) == ["B1", "B2", "B3"]          # upsert keeps B3 (only listed near S2 before)
    assert stops(v3) == ["B1", "B2"]                # replace keeps only what this seed lists
    assert spark.read.parquet(f"{v2}/options").count() == 2
