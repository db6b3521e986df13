"""The registered queries: each is ``fn(spark, sf_dir) -> DataFrame`` over the
warehouse tables through the proxy mapping in :mod:`detour.plans.proxy`.

Outputs are scalar columns (nested lists are exploded or joined to text) so that
they compare value by value with the SQL in :mod:`detour.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from detour.functions.columns import gridlock_label, iso_utc, py_timestamp_str, title_from_id
from detour.operators import graph as G
from detour.operators.alerts import build_alerts
from detour.operators.buckets import read_buckets, upsert_buckets
from detour.operators.constraints import ConstraintViolation, audit, audit_written, require_clean
from detour.operators.geo_cells import adaptive_radius_join
from detour.operators.geo_join import radius_join as _radius_join
from detour.operators.lookup import lookup_paths, write_clustered
from detour.operators.options import bounded_options, line_options as _line_options
from detour.operators.parse import disrupted, field_faults, parse_records, rejected
from detour.operators.path_tables import bucketed_path_rows, write_path_tables
from detour.operators.paths import (
    PATH_COLUMNS, nearest_paths as _nearest, path_rows, restrict_line,
)
from detour.operators.reports import payload_preview
from detour.operators.status import events_from_documents, events_from_worst, poll_counts, split_by_disruption, worst_status_rows
from detour.operators.uncapped import gridlock_lines, uncapped_options
from detour.operators.upsert import upsert
from detour.params import DEFAULT, Params
from detour.plans import proxy
from detour.schemas import MEMBERSHIP_DOC, METRO_STATION_TYPE, NEARBY_DOC, STATION_DOC
from detour.sources.broker import to_broker_records
from detour.sources.documents import (
    REQUIRED_POINT, incomplete, landed, read_json, read_line_status, rejected_documents, station_points, unparsed,
)
from detour.sources.tables import load_table
from detour.session import fresh_path
from detour.sources.vocabulary import line_vocabulary
from detour.streaming.processor import current_snapshot, publish_snapshot

LOOKUP_LINE = 7
P = DEFAULT
STRICT = replace(DEFAULT, min_routes=10)   # a stricter rule, under which some known lines are in gridlock


def _t(spark, base, name):
    return load_table(spark, base, name)


# ---- alerts ---------------------------------------------------------------------------

def options_of(g: G.Graph, p: Params = P) -> DataFrame:
    return _line_options(_nearest(g, p.path_limit), g.lines, p)


def options_for(spark: SparkSession, base: str, p: Params = P, broadcastable: bool = False) -> DataFrame:
    """The options of the network of stops within the radius."""
    g = proxy.nearest_graph(spark, base, p)
    return bounded_options(options_of(g, p), g.lines, p) if broadcastable else options_of(g, p)


def alerts_for(spark: SparkSession, base: str, p: Params = P) -> DataFrame:
    """Alerts for every disrupted event, ``processed_at`` = the event time."""
    ev = proxy.status_events(_t(spark, base, "events"), p, disrupted_only=True)
    d = disrupted(ev, processed_at=F.col("ts"))
    return build_alerts(d, options_for(spark, base, p, broadcastable=True), p, batch_id=0,
                        keep=["event_id"])


def alert_scalars(alerts: DataFrame) -> DataFrame:
    return alerts.select("event_id", "line_id", "line_name", "severity", "is_known_line",
                         F.size("affected_stations").alias("n_stations"),
                         F.size("available_routes").alias("n_routes"), "gridlock_alert")


def gridlock_alerts(spark, base):
    """One alert per disrupted event."""
    return alert_scalars(alerts_for(spark, base))


def gridlock_alerts_strict(spark, base):
    """A4 with another ``min_routes``: known lines with either flag."""
    return alert_scalars(alerts_for(spark, base, STRICT))


def exploded_options(alerts: DataFrame, *clocks: str) -> DataFrame:
    """One row per nested row (position and stop -1 for an alert without any)."""
    kept = ["event_id", "batch_id", "ingested_at_utc", "processed_at_utc", *clocks]
    return alerts.select(*kept, F.posexplode_outer("nearby_bus_stops").alias("pos", "s")).select(
        *kept, F.coalesce("pos", F.lit(-1)).alias("pos"),
        *[(F.coalesce(F.col("s")[c], F.lit(-1)) if c == "bus_stop_id" else F.col("s")[c]).alias(c) for c in PATH_COLUMNS])


def alert_options_exploded(spark, base):
    """The nested rows and the clocks of each alert."""
    return exploded_options(alerts_for(spark, base))


def gridlock_label_q(spark, base):
    """A4, F8: the display label of each alert."""
    a = alerts_for(spark, base)
    return a.select("event_id", "line_id", "gridlock_alert", gridlock_label(F.col("gridlock_alert")).alias("status_label"))


def disrupted_events(spark, base):
    """Disrupted status events (processing time dropped)."""
    ev = proxy.status_events(_t(spark, base, "events"), P)
    return disrupted(ev).drop("processed_at_utc", "ts")


# ---- status ---------------------------------------------------------------------------

def _worst(spark, base):
    rows = proxy.status_rows(_t(spark, base, "events"), view_has_no_severity=True)
    w = worst_status_rows(rows, ["line_id", "poll_ts"], "event_id", "severity", "severity_desc",
                          "disruption_detail", P)
    return events_from_worst(w, F.col("line_id"), proxy.line_name_of(F.col("line_id")),
                             iso_utc(F.col("poll_ts")), P,
                             keep=[F.col("worst_pos").alias("worst_event_id"), "n_statuses"])


def document_status_events(spark, base):
    """S3 + P6 + A12 (array form) + F1 + F2 + P10 + P11 on documents rebuilt from events."""
    docs = proxy.status_documents(_t(spark, base, "events"))
    return events_from_documents(docs, iso_utc(F.col("poll_ts")), P, keep=["event_id"])


def status_texts(spark: SparkSession, base: str) -> DataFrame:
    """The status documents as JSON texts: some without id, name or statuses, some broken off."""
    e = F.col("event_id")
    json = F.to_json(F.struct(F.when(e % 11 != 0, F.col("id")).alias("id"), F.when(e % 13 != 0, F.col("name")).alias("name"),
                              F.when(e % 7 != 0, F.col("lineStatuses")).otherwise(F.slice("lineStatuses", 1, 0)).alias("lineStatuses")))
    return proxy.status_documents(_t(spark, base, "events")).select(
        F.when(e % 17 == 0, F.substring(json, 1, 10)).otherwise(json).alias("value"))


def intake_counts(events: DataFrame, bad: DataFrame) -> DataFrame:
    """Events by line and severity, and how many documents were rejected."""
    events = events.groupBy(F.lit("accepted").alias("state"), "line_id", "line_name", "severity_code", "severity_desc").agg(F.count(F.lit(1)).alias("n"))
    bad = bad.groupBy(F.lit("rejected").alias("state"), F.col("kind").alias("line_id"), F.col("reason").alias("line_name")).agg(F.count(F.lit(1)).alias("n"))
    return events.unionByName(bad.withColumns({"severity_code": F.lit(-1), "severity_desc": F.lit("")}))


def intake_status_events(spark, base):
    """S3, P6, F1 over JSON files: documents without id, name or statuses and broken ones, written and
    read back; events by line and severity, and how many documents were rejected."""
    path = fresh_path(spark, "intake", "status")
    status_texts(spark, base).write.text(path)
    raw = landed(read_line_status(spark, path), f"{path}-parsed")
    events = events_from_documents(raw, F.lit("2024-01-01T00:00:00+00:00"), P)
    return intake_counts(events, unparsed(raw, "line status"))


def intake_stations(spark, base):
    """S4, T6, U1 over JSON files: stations in two documents, without id or name, and broken documents;
    the stations as written last, and the rejected rows counted."""
    path, k = fresh_path(spark, "intake", "stations"), F.col("s_suppkey")
    sup = _t(spark, base, "supplier").select("s_suppkey", "s_name", *proxy.lat_lon("s_suppkey", proxy.STATION_MULT))

    def document(name: Column) -> Column:
        return F.to_json(F.struct(F.array(F.struct(
            F.when(k % 10 != 9, k.cast("string")).alias("id"), F.when(k % 10 != 7, name).alias("commonName"), "lat", "lon",
            F.lit(METRO_STATION_TYPE).alias("stopType"))).alias("stopPoints")))

    first = document(F.concat("s_name", F.lit(" old")))
    sup.select(F.when(k % 25 == 3, F.substring(first, 1, 30)).otherwise(first).alias("value")).write.text(f"{path}/1")
    sup.filter(k % 2 == 0).select(document(F.col("s_name")).alias("value")).write.text(f"{path}/2")
    docs = landed(read_json(spark, f"{path}/*", STATION_DOC), f"{path}-parsed")
    kept = upsert(None, G.stations_from_documents(docs), ["station_id"], ["seq"]).select(
        F.lit("accepted").alias("state"), "station_id", "name", F.lit(1).cast("long").alias("n"))
    bad = unparsed(docs, "station document").unionByName(incomplete(station_points(docs), REQUIRED_POINT, "station"))
    return kept.unionByName(bad.groupBy(F.lit("rejected").alias("state"), F.col("kind").alias("station_id"), F.col("reason").alias("name"))
                            .agg(F.count(F.lit(1)).alias("n")))


def intake_network(spark, base):
    """S5, S6, P7, P14 over JSON files: nearby and membership documents, some broken off, some with stops, routes or members that lack
    their id, and lines without any member; stops by station, routes by station, members by line, and the rejected rows counted."""
    path, stop, route, member = fresh_path(spark, "intake", "network"), F.col("stop_id"), F.col("p_brand"), F.col("s_suppkey")
    part = _t(spark, base, "part").select(F.col("p_partkey").alias("stop_id"), "p_name", "p_brand", *proxy.lat_lon("p_partkey", proxy.STOP_MULT))
    nearby = F.to_json(F.struct(F.col("station_id").cast("string").alias("station_id"), F.array(F.struct(
        F.when(stop % 13 != 0, stop.cast("string")).alias("id"), F.col("p_name").alias("commonName"), "lat", "lon",
        F.col("distance_metres").alias("distance"),
        F.array(F.struct(F.when(stop % 11 != 0, route).alias("id"), route.alias("name"))).alias("lines"))).alias("stopPoints")))
    proxy.listed_edges(spark, base).join(part, "stop_id").select(
        F.when(stop % 17 == 0, F.substring(nearby, 1, 20)).otherwise(nearby).alias("value")).write.text(f"{path}/nearby")
    members = _t(spark, base, "supplier").select(F.to_json(F.struct(F.col("s_nationkey").cast("string").alias("line_id"), F.array(F.struct(
        F.when(member % 9 != 0, member.cast("string")).alias("id"),
        F.when(member % 10 != 3, F.lit(METRO_STATION_TYPE)).otherwise(F.lit("other")).alias("stopType"))).alias("stops"))).alias("value"))
    empty = _t(spark, base, "nation").select(F.to_json(F.struct(F.concat(F.lit("empty-"), F.col("n_nationkey").cast("string")).alias("line_id"),
                                                                F.array().cast("array<struct<id:string,stopType:string>>").alias("stops"))).alias("value"))
    members.unionByName(empty).write.text(f"{path}/members")
    nb = landed(read_json(spark, f"{path}/nearby", NEARBY_DOC), f"{path}/nearby-parsed")
    mb = landed(read_json(spark, f"{path}/members", MEMBERSHIP_DOC), f"{path}/members-parsed")
    _, near, routes, _ = G.nearby_from_documents(nb)
    lines = G.lines_from_members(G.members_from_documents(mb), count_as="n")
    count = lambda df, kind: df.groupBy(F.lit(kind).alias("kind"), F.col("station_id").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    bad = rejected_documents(spark.createDataFrame([], STATION_DOC), nb, mb)
    return (count(near, "stops").unionByName(count(routes, "routes")).unionByName(lines.select(F.lit("members").alias("kind"), F.col("line_id").alias("name"), "n"))
            .unionByName(bad.groupBy(F.concat(F.lit("rejected "), "kind").alias("kind"), F.col("reason").alias("name")).agg(F.count(F.lit(1)).alias("n"))))


def worst_status(spark, base):
    """A12 (row form), D6, F1, F4, P10, P11: worst status per line and poll."""
    return _worst(spark, base)


def disruption_split(spark, base):
    """The events in order and the disrupted ones, each by line."""
    ok, bad = split_by_disruption(_worst(spark, base))
    one = lambda df, part: df.groupBy("line_id").agg(F.count(F.lit(1)).alias("n_events")).withColumn("part", F.lit(part))
    return one(ok, "ok").unionByName(one(bad, "disrupted"))


def status_counts(spark, base):
    """Lines OK / disrupted per poll."""
    return poll_counts(_worst(spark, base))


def parse_props(spark, base):
    """Bytes -> text -> struct by schema, broker time kept."""
    ev = _t(spark, base, "events")
    rec = ev.select("event_id", F.col("props").cast("binary").alias("value"),
                    F.col("ts").cast("timestamp").alias("timestamp"))
    parsed = parse_records(rec, schema="k int", keep=["event_id"])
    return parsed.select("event_id", "k", py_timestamp_str(F.col("event_hub_timestamp")).alias("event_hub_time"))


def quarantine_counts(spark, base):
    """Broker records of the props JSON, and how many parse to nothing."""
    schema = StructType([StructField("k", IntegerType())])
    rec = _t(spark, base, "events").select(F.col("props").cast("binary").alias("value"),
                                           F.col("ts").cast("timestamp").alias("timestamp"))
    parsed = parse_records(rec, schema)
    return parsed.agg(F.count(F.lit(1)).alias("n_records"),
                      F.count_if(rejected(parsed, schema)).alias("n_rejected"))


def field_faults_q(spark, base):
    """P2, D18 by field: broker records with wrong types, a missing line, an unknown field, or no object at all; counts by field and fault."""
    e = F.col("event_id")
    severity = F.when(e % 7 == 0, F.lit('"n/a"')).when(e % 11 == 0, F.lit("3.5")).otherwise(F.floor("value").cast("string"))
    text = F.concat(F.lit('{"event_type":"status","severity_code":'), severity,
                    F.lit(',"is_disrupted":'), F.when(e % 13 == 0, F.lit('"yes"')).otherwise(F.lit("true")),
                    F.when(e % 17 != 0, F.concat(F.lit(',"line_id":"'), F.col("user_id").cast("string"), F.lit('"'))).otherwise(F.lit("")),
                    F.when(e % 19 == 0, F.lit(',"depot":{"id":1}')).otherwise(F.lit("")), F.lit("}"))
    rec = _t(spark, base, "events").select(F.when(e % 23 == 0, F.substring(text, 1, 12)).otherwise(text).cast("binary").alias("value"),
                                           F.col("ts").cast("timestamp").alias("timestamp"))
    return field_faults(rec, required=("line_id",)).groupBy("field", "fault").agg(F.count(F.lit(1)).alias("n"), F.count("given").alias("n_given"))


PAYLOAD_FIELDS = ["event_id", "event_type", "line_id", "line_name", "severity_code", "severity_desc",
                  "is_disrupted", "disruption_detail", "ingested_at_utc"]
PAYLOAD_SCHEMA = ("event_id long, event_type string, line_id long, line_name string, severity_code int, "
                  "severity_desc string, is_disrupted boolean, disruption_detail string, ingested_at_utc string")


def broker_events(events: DataFrame, p: Params = P) -> DataFrame:
    """Events -> K1 broker records -> P1-P3 parsed events (the stream's input shape)."""
    ev = proxy.status_events(events, p)
    rec = to_broker_records(ev, PAYLOAD_FIELDS, timestamp_col="ts")
    return parse_records(rec, schema=PAYLOAD_SCHEMA)


def event_payload(spark, base):
    """K1 + P1-P3: events published as JSON bytes and parsed back."""
    return broker_events(_t(spark, base, "events")).drop("event_hub_timestamp")


def iso_timestamp(spark, base):
    """ISO-8601 UTC and Python-style timestamp texts."""
    ev = _t(spark, base, "events")
    return ev.select("event_id", iso_utc(F.col("ts")).alias("ingested_at_utc"),
                     py_timestamp_str(F.col("ts")).alias("processed_at_utc"),
                     iso_utc(F.date_trunc("hour", F.col("ts"))).alias("poll_at_utc"))


# ---- graph ----------------------------------------------------------------------------

def type_filter(spark, base):
    """Stop-type filter and node renames."""
    part = _t(spark, base, "part")
    return G.select_type(part, "p_type", "ECONOMY").select(
        F.col("p_partkey").alias("stop_id"), F.col("p_name").alias("name"), F.col("p_type").alias("stop_type"))


def line_names(spark, base):
    """F3 (+ A11 count): line ids to display names."""
    o = _t(spark, base, "orders")
    return (o.groupBy(F.col("o_orderpriority").alias("line_id")).agg(F.count(F.lit(1)).alias("n_orders"))
             .select("line_id", title_from_id(F.col("line_id")).alias("line_name"), "n_orders"))


def flatten_members(spark, base):
    """a nested list per row flattened with positions and sizes."""
    part = _t(spark, base, "part")
    stops = part.select(F.col("p_partkey").alias("stop_id"), F.split("p_name", " ").alias("lines"))
    return G.flatten_list(stops, "stop_id", "lines", "route_name")


def node_upsert(spark, base):
    """Node upsert, latest write wins."""
    cust = _t(spark, base, "customer").select(F.col("c_custkey").alias("node_id"), F.col("c_acctbal").alias("value"))
    inc = _t(spark, base, "orders").select(F.col("o_custkey").alias("node_id"), F.col("o_totalprice").alias("value"),
                                           "o_orderdate", "o_orderkey")
    return upsert(cust, inc, ["node_id"], ["o_orderdate", "o_orderkey"])


def document_upsert(spark, base):
    """An upsert that reaches some of the current keys only: labels onto documents."""
    docs = _t(spark, base, "documents").select(F.col("doc_id").alias("node_id"), F.col("n_chars").alias("value"))
    inc = _t(spark, base, "labels").select(F.col("doc_id").alias("node_id"),
                                           F.col("quality").cast("long").alias("value"), "toxic")
    return upsert(docs, inc, ["node_id"], ["toxic"])


def edge_upsert(spark, base):
    """Edge upsert on the endpoint pair."""
    li = _t(spark, base, "lineitem")
    inc = li.select(F.col("l_suppkey").alias("station_id"), F.col("l_partkey").alias("stop_id"),
                    F.col("l_extendedprice").alias("distance_metres"),
                    "l_shipdate", "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price_seq"))
    return upsert(None, inc, ["station_id", "stop_id"],
                  ["l_shipdate", "l_orderkey", "l_linenumber", "price_seq"]).drop("is_updated")


def edge_upsert_buckets(spark, base):
    """The writes of ``edge_upsert`` as three upserts onto a bucketed table: the earlier half, the later half, and
    one station's last writes again, which reach a few buckets only."""
    root, keys, seq = fresh_path(spark, "edge_upsert_buckets"), ["station_id", "stop_id"], ["l_shipdate", "l_orderkey", "l_linenumber", "price_seq"]
    li = _t(spark, base, "lineitem")
    inc = li.select(F.col("l_suppkey").alias("station_id"), F.col("l_partkey").alias("stop_id"), F.col("l_extendedprice").alias("distance_metres"),
                    "l_shipdate", "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price_seq"))
    middle = li.agg(F.expr("percentile_approx(l_shipdate, 0.5)")).first()[0]
    later = F.col("l_shipdate") > F.lit(middle)
    for part in (inc.filter(~later | F.col("l_shipdate").isNull()), inc.filter(later),
                 inc.filter(F.col("station_id") == inc.select("station_id").first()[0])):
        upsert_buckets(spark, root, part, keys, seq, buckets=16)
    return read_buckets(spark, root)


def audited_publish(spark, base):
    """The order lines as a table keyed by order and line, loaded onto an older snapshot: the rows that keep the key, those
    in quarantine, and which snapshot is current after it."""
    root, new = fresh_path(spark, "audited"), fresh_path(spark, "audited")
    publish_snapshot(spark, root, "old")
    _t(spark, base, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").write.parquet(f"{new}/order_lines")
    table, keys = spark.read.parquet(f"{new}/order_lines"), ["l_orderkey", "l_linenumber"]
    try:
        require_clean(audit_written(spark, {"order_lines": (table, keys)}, f"{new}/quarantine"), f"{new}/quarantine")
        publish_snapshot(spark, root, "new")
    except ConstraintViolation:
        pass
    fields = ["l_orderkey", "l_linenumber", "l_partkey"]
    kept = audit(table, keys)[0].select(F.lit("kept").alias("state"), F.lit("").alias("reason"), *fields)
    row = F.from_json("row", table.schema)
    bad = spark.read.parquet(f"{new}/quarantine").select(F.lit("quarantined").alias("state"), "reason", *[row[c].alias(c) for c in fields])
    now = spark.createDataFrame([("current", current_snapshot(spark, root), -1, -1, -1)], kept.schema)
    return kept.unionByName(bad).unionByName(now)


def edge_upsert_existing(spark, base):
    """The stops within the radius written onto the listed edges: kept, updated and new ones."""
    return upsert(proxy.listed_edges(spark, base), proxy.nearby(spark, base), ["station_id", "stop_id"], [])


def guarded_edges(spark, base):
    """Edges kept only when both endpoint nodes exist: (conversation, document of that number)
    edges, where a conversation or the document's label may be missing."""
    edges = _t(spark, base, "documents").select("source", "doc_id", (F.col("doc_id") % 250).alias("conv_id"))
    return G.guard_edges(edges, _t(spark, base, "conversations").select("conv_id").distinct(), "conv_id",
                         _t(spark, base, "labels"), "doc_id", "conv_id", "doc_id")


def line_vocabulary_q(spark, base):
    """The fixed line-id list joined to its members."""
    members = _t(spark, base, "supplier").select(F.col("s_nationkey").alias("position"),
                                                 F.col("s_suppkey").alias("station_id"))
    vocab = line_vocabulary(spark)
    m = members.join(vocab, "position").select("line_id", "station_id")
    return G.lines_from_members(m, count_as="n_stations").select(
        "line_id", F.col("name").alias("line_name"), "n_stations")


def link_counts(spark, base):
    """Linked and missing members per line."""
    members = _t(spark, base, "documents").select(F.col("source").alias("line_id"), F.col("doc_id").alias("station_id"))
    return G.link_counts(members, _t(spark, base, "labels"), "line_id", "station_id", "doc_id")


def key_violations(spark, base):
    """Keys occurring more than once or null."""
    return G.key_violations(_t(spark, base, "lineitem"), ["l_orderkey", "l_linenumber"])


def graph_summary(spark, base):
    """Node counts per label, one row."""
    from detour.jobs import read_graph, write_graph
    path = fresh_path(spark, "graph_summary")
    write_graph(proxy.graph(spark, base), path)   # the counts read the written tables, as after a seed
    return G.graph_summary(G.prune_unreferenced(read_graph(spark, path)))


# ---- paths ----------------------------------------------------------------------------

def line_paths(spark, base):
    """Every path row line -> station -> stop -> route."""
    return path_rows(proxy.graph(spark, base))


def line_lookup(spark, base):
    """The parameterised lookup of one line's nearest path rows."""
    g = restrict_line(proxy.listed_graph(spark, base), LOOKUP_LINE)
    return _nearest(g, P.path_limit)


def line_lookup_clustered(spark, base):
    """P12 by key: the lookup of ``line_lookup`` on the graph written in the clustered layout."""
    path = fresh_path(spark, "clustered")
    write_clustered(proxy.listed_graph(spark, base), path)
    return lookup_paths(spark, path, LOOKUP_LINE)


def line_paths_bucketed(spark, base):
    """J1 from bucketed tables: the path rows of ``line_paths`` without an exchange."""
    path = fresh_path(spark, "path_tables")
    write_path_tables(proxy.graph(spark, base), path, buckets=8)
    return bucketed_path_rows(spark, path)


def uncapped_options_q(spark, base):
    """A2-A4 without a cap, D4: counts, first names and flag of each line over all its path rows."""
    o = uncapped_options(proxy.graph_with_gaps(spark, base))
    return o.withColumn("display_routes", F.array_join("display_routes", "|"))


def uncapped_gridlock(spark, base):
    """A4 without a cap: the flag alone, under the stricter rule."""
    return gridlock_lines(proxy.gridlock_graph(spark, base, STRICT), STRICT)


def nearest_paths_q(spark, base):
    """The 100 nearest path rows per line."""
    return _nearest(proxy.listed_graph(spark, base), P.path_limit)


def nearby_stops_top20(spark, base):
    """The nested 20 nearest rows per line, exploded."""
    o = options_of(proxy.listed_graph(spark, base))
    return o.select("line_id", F.posexplode("nearby_bus_stops").alias("pos", "s")).select(
        "line_id", "pos", *[F.col("s")[c].alias(c) for c in PATH_COLUMNS])


def line_options_q(spark, base):
    """Per-line distinct stations and routes, gridlock flag."""
    return _options_scalars(options_of(proxy.listed_graph(spark, base)))


def _options_scalars(o: DataFrame) -> DataFrame:
    return o.select("line_id", "graph_line_name", "n_path_rows", "n_stations", "n_routes", "gridlock_alert",
                    F.array_join("affected_stations", "|").alias("affected_stations"),
                    F.array_join("available_routes", "|").alias("available_routes"),
                    F.array_join("display_routes", "|").alias("display_routes"))


def nearest_paths_gaps(spark, base):
    """Nearest rows when some distances are missing."""
    return _nearest(proxy.graph_with_gaps(spark, base), P.path_limit)


def line_options_gaps(spark, base):
    """Options when a route has no name."""
    g = proxy.graph_with_gaps(spark, base)
    return _options_scalars(_line_options(_nearest(g, P.path_limit), g.lines, P))


def document_graph_options(spark, base):
    """Documents -> graph (S4-S6, P7, P9, K3/K4, U1, J4, P14, F3) -> options.

    As in the seed job, the built graph is written to the shared folder first and
    the options are computed from the written tables: the graph tables are deep
    plans that the path joins reference several times, and a written table cuts
    that lineage (and survives lost executors)."""
    from detour.jobs import read_graph, write_graph
    path = fresh_path(spark, "document_graph")
    docs = []
    for name, d in zip(("stations", "nearby", "members"), proxy.documents(spark, base)):
        d.write.parquet(f"{path}/documents/{name}")
        docs.append(spark.read.schema(d.schema).parquet(f"{path}/documents/{name}"))
    write_graph(G.build_graph(*docs, guard=False), path)
    g = read_graph(spark, path)
    return _options_scalars(_line_options(_nearest(g, P.path_limit), g.lines, P))


def radius_join(spark, base):
    """station/stop pairs within 300 m with their distance."""
    st = proxy.stations(spark, base)
    stops = _t(spark, base, "customer").select(F.col("c_custkey").alias("stop_id"),
                                               *proxy.lat_lon("c_custkey", proxy.STOP_MULT))
    pairs = _radius_join(st, stops, P.radius_m, earth_radius_m=P.earth_radius_m)
    return pairs.withColumn("distance_metres", F.round("distance_metres", 3))


CROWD = 3   # every third station and stop stands in one place of some 400 m


def _crowded(key: str, mults: tuple[int, int]) -> list[Column]:
    dense = F.col(key) % CROWD == 0
    lat, lon = proxy.lat_lon(key, mults)
    return [F.when(dense, proxy.coord(key, mults[0], 10007, 51.5, 0.004)).otherwise(lat).alias("lat"),
            F.when(dense, proxy.coord(key, mults[1], 10009, -0.1, 0.004)).otherwise(lon).alias("lon")]


def radius_join_crowded(spark, base):
    """J3 with a dense place: stations and stops of which a third stand in one cell, which is split."""
    st = _t(spark, base, "supplier").select(F.col("s_suppkey").alias("station_id"), *_crowded("s_suppkey", proxy.STATION_MULT))
    stops = _t(spark, base, "customer").select(F.col("c_custkey").alias("stop_id"), *_crowded("c_custkey", proxy.STOP_MULT))
    pairs = adaptive_radius_join(st, stops, P.radius_m, earth_radius_m=P.earth_radius_m, most=1000)
    return pairs.withColumn("distance_metres", F.round("distance_metres", 3))


def nearby_seed(spark, base):
    """P8 + J3 graph build: bus stops (customers of one segment) within the radius of
    each station, with the routes each stop lists."""
    st = proxy.stations(spark, base)
    route = F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))
    pts = _t(spark, base, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("commonName"),
        *proxy.lat_lon("c_custkey", proxy.STOP_MULT), F.col("c_mktsegment").alias("stopType"),
        F.array(F.struct(route.alias("id"), route.alias("name"))).alias("lines"))
    pairs = G.nearby_pairs(st, pts, P.radius_m, stop_type="BUILDING")
    return pairs.select("station_id", "stop_id", F.round("distance_metres", 3).alias("distance_metres"),
                        F.explode("lines").alias("l")).select("station_id", "stop_id", "distance_metres", F.col("l.id").alias("route_id"))


def stations_per_line(spark, base):
    """Stations per line."""
    g = proxy.listed_graph(spark, base)
    return g.serves.groupBy("line_id").agg(F.count(F.lit(1)).alias("n_stations"))


def stops_per_station(spark, base):
    """Nearby stops per station and the nearest distance."""
    g = proxy.graph(spark, base)
    return g.has_nearby_stop.groupBy("station_id").agg(F.count(F.lit(1)).alias("n_stops"),
                                                      F.min("distance_metres").alias("nearest_metres"))


# ---- history reports ------------------------------------------------------------------

PREVIEW_FIELDS = ["line_id", "line_name", "severity", "gridlock_alert", "affected_stations", "available_routes"]


def alert_preview(spark, base):
    """the first 200 characters of each alert's JSON."""
    a = payload_preview(alerts_for(spark, base), PREVIEW_FIELDS, P.preview_chars)
    return a.select("event_id", "preview")


def batch_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "gridlock_alerts": gridlock_alerts,
        "gridlock_alerts_strict": gridlock_alerts_strict,
        "alert_options_exploded": alert_options_exploded,
        "disrupted_events": disrupted_events,
        "worst_status": worst_status,
        "document_status_events": document_status_events,
        "intake_status_events": intake_status_events,
        "intake_stations": intake_stations,
        "intake_network": intake_network,
        "status_counts": status_counts,
        "disruption_split": disruption_split,
        "parse_props": parse_props,
        "quarantine_counts": quarantine_counts,
        "field_faults": field_faults_q,
        "event_payload": event_payload,
        "iso_timestamp": iso_timestamp,
        "type_filter": type_filter,
        "line_names": line_names,
        "flatten_members": flatten_members,
        "node_upsert": node_upsert,
        "document_upsert": document_upsert,
        "edge_upsert": edge_upsert,
        "edge_upsert_buckets": edge_upsert_buckets,
        "edge_upsert_existing": edge_upsert_existing,
        "audited_publish": audited_publish,
        "guarded_edges": guarded_edges,
        "line_vocabulary": line_vocabulary_q,
        "link_counts": link_counts,
        "key_violations": key_violations,
        "graph_summary": graph_summary,
        "line_paths": line_paths,
        "line_paths_bucketed": line_paths_bucketed,
        "line_lookup": line_lookup,
        "line_lookup_clustered": line_lookup_clustered,
        "uncapped_options": uncapped_options_q,
        "uncapped_gridlock": uncapped_gridlock,
        "nearest_paths": nearest_paths_q,
        "nearby_stops_top20": nearby_stops_top20,
        "line_options": line_options_q,
        "nearest_paths_gaps": nearest_paths_gaps,
        "line_options_gaps": line_options_gaps,
        "document_graph_options": document_graph_options,
        "gridlock_label": gridlock_label_q,
        "radius_join": radius_join,
        "radius_join_crowded": radius_join_crowded,
        "nearby_seed": nearby_seed,
        "stations_per_line": stations_per_line,
        "stops_per_station": stops_per_station,
        "alert_preview": alert_preview,
    }
