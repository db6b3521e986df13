"""End-to-end jobs, the four things the original system does:

  ingest   line-status documents -> status events -> broker (or files)        (E1)
  seed     station / nearby-stop / membership documents -> graph tables       (E3)
           + the per-line options snapshot the alert stream joins
  stream   broker records -> disrupted events -> alerts -> history            (E2)
  report   history -> summary, newest alerts, first alerts                     (E4)

Each is a thin composition of the operators; the CLI in ``__main__`` calls them.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from detour.functions.columns import iso_utc
from detour.operators.constraints import audit_written, require_clean
from detour.operators.graph import (
    Graph, build_graph, graph_summary, guard_graph, key_violations, link_counts, members_from_documents,
    nearby_documents, nearby_pairs, stations_from_documents,
)
from detour.operators.options import line_options
from detour.operators.paths import nearest_paths
from detour.operators.reports import alert_summary, first_alerts, latest_alerts
from detour.operators.status import events_from_documents, poll_counts
from detour.operators.upsert import latest_per_key
from detour import schemas as S
from detour.params import DEFAULT, Params
from detour.schemas import STATUS_EVENT
from detour.session import fresh_path
from detour.sources import documents as D
from detour.sources.broker import to_broker_records
from detour.sources.history import read_history
from detour.streaming.processor import (
    DEFAULT_TRIGGER, AlertAndQuarantineWriter, AlertBatchWriter, disrupted_stream, publish_snapshot, start_alert_stream,
    write_options_snapshot,
)
from detour.streaming.outputs import BatchOutputs
from detour.streaming import compaction, partials

GRAPH_TABLES = ["lines", "stations", "bus_stops", "bus_routes", "serves", "has_nearby_stop", "served_by"]
EVENT_FIELDS = [f.name for f in STATUS_EVENT.fields]


# ---- E1 ---------------------------------------------------------------------------------

def status_events(spark: SparkSession, docs_path: str, streaming: bool = False, p: Params = DEFAULT,
                  multiline: bool = False) -> DataFrame:
    """Line-status documents -> one event per line, stamped with the poll time."""
    raw = D.read_line_status(spark, docs_path, streaming, multiline)
    return events_from_documents(raw, iso_utc(F.current_timestamp()), p)


def ingest(spark: SparkSession, docs_path: str, out: str, fmt: str = "parquet",
           kafka_options: dict | None = None, multiline: bool = False, quarantine_path: str | None = None) -> DataFrame:
    """Batch ingest of one poll: publish the events (K1) and return the per-poll counts.

    The events feed two outputs, so they are computed once and kept (with the poll
    time fixed) for the counts, which are materialised before the events are released.
    """
    raw = D.landed(D.read_line_status(spark, docs_path, multiline=multiline), fresh_path(spark, "ingest"))
    if quarantine_path:
        D.unparsed(raw, "line status document").write.mode("append").parquet(quarantine_path)
    events = events_from_documents(raw, iso_utc(F.current_timestamp())).persist()
    try:
        if fmt == "kafka":
            to_broker_records(events, EVENT_FIELDS).write.format("kafka").options(**(kafka_options or {})).save()
        else:
            to_broker_records(events, EVENT_FIELDS).write.mode("append").format(fmt).save(out)
        rows = poll_counts(events).collect()     # one row per poll: bounded
    finally:
        events.unpersist()
    return spark.createDataFrame(rows, "ingested_at_utc string, n_lines long, n_ok long, n_disrupted long")


def ingest_stream(spark: SparkSession, docs_path: str, out: str, checkpoint: str, quarantine_path: str, run_id: str,
                  trigger: dict | None = None, max_files: int | None = None, ingested_at: Column | None = None,
                  p: Params = DEFAULT) -> StreamingQuery:
    """E1 as a running job (S3 -> A12 -> K1): line-status documents that arrive as files under ``docs_path`` become
    status events as broker records under ``out``; documents that don't parse go to ``quarantine_path``.

    Every file is read once; both outputs hold each batch once, whatever is replayed. A restart from ``checkpoint``
    with the same ``run_id`` goes on where the last run stopped. All events of a batch carry one poll time."""
    docs = D.read_line_status(spark, docs_path, streaming=True, max_files=max_files)

    def events(batch: DataFrame, _: int) -> DataFrame:
        stamp = iso_utc(F.current_timestamp()) if ingested_at is None else ingested_at
        return to_broker_records(events_from_documents(batch, stamp, p), EVENT_FIELDS)

    both = BatchOutputs([(out, events), (quarantine_path, lambda batch, _: D.unparsed(batch, "line status"))], run_id)
    return (docs.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or DEFAULT_TRIGGER)).start())


# ---- E3 ---------------------------------------------------------------------------------

def read_graph(spark: SparkSession, graph_dir: str) -> Graph:
    return Graph(**{t: spark.read.parquet(f"{graph_dir}/{t}") for t in GRAPH_TABLES})


NODE_TABLES = ["lines", "stations", "bus_stops", "bus_routes"]
NODE_KEYS = {"lines": "line_id", "stations": "station_id", "bus_stops": "stop_id", "bus_routes": "route_id"}
EDGE_TABLES = ["serves", "has_nearby_stop", "served_by"]


def write_graph(g: Graph, graph_dir: str) -> None:
    """Write the node tables, then the edges guarded (J4) against the *written*
    nodes: each edge write reads small finished tables instead of re-running the
    node upserts, and every table is a lineage cut that survives lost executors."""
    for t in NODE_TABLES:
        getattr(g, t).write.mode("overwrite").parquet(f"{graph_dir}/{t}")
    spark = g.lines.sparkSession
    nodes = {t: spark.read.parquet(f"{graph_dir}/{t}") for t in NODE_TABLES}
    guarded = guard_graph(Graph(**nodes, **{t: getattr(g, t) for t in EDGE_TABLES}))
    for t in EDGE_TABLES:
        getattr(guarded, t).write.mode("overwrite").parquet(f"{graph_dir}/{t}")


def integrity(g: Graph, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(U2: node keys that are null or occur more than once; J6: linked and missing members per line)."""
    bad = [key_violations(getattr(g, t), [k]).select(F.lit(t).alias("table"), F.col(k).cast("string").alias("key"), "n_rows")
           for t, k in NODE_KEYS.items()]
    return reduce(DataFrame.unionByName, bad), link_counts(members, g.stations, "line_id", "station_id", "station_id")


def seed(spark: SparkSession, stations_path: str, nearby_path: str | None, members_path: str, out_dir: str,
         current_dir: str | None = None, mode: str = "upsert", p: Params = DEFAULT,
         publish_root: str | None = None, stop_points: DataFrame | None = None, multiline: bool = False) -> DataFrame:
    """Build (or upsert onto ``current_dir``) the graph, write it as a new version at
    ``out_dir`` together with ``out_dir/options``, and return the node counts (A10).
    Without ``nearby_path`` the nearby stops of each station are those of ``stop_points`` within
    the radius (P8 + J3).

    Also written: ``rejected`` (documents and rows that can't be used), ``key_violations`` (U2),
    ``link_counts`` (J6) and ``quarantine``: node rows that break their key. If there are any, the seed fails before it makes
    options, and what is published stays as it was. With ``publish_root`` the new options become current for streams
    reading that root (see :func:`detour.streaming.processor.publish_snapshot`)."""
    # Seven tables are written from the same documents: they are parsed once, into tables that every
    # executor can read again.
    def land(path: str, schema, name: str) -> DataFrame:
        return D.landed(D.read_json(spark, path, schema, multiline=multiline), f"{out_dir}/documents/{name}")

    st, mb = land(stations_path, S.STATION_DOC, "stations"), land(members_path, S.MEMBERSHIP_DOC, "members")
    if nearby_path is not None:
        nb = land(nearby_path, S.NEARBY_DOC, "nearby")
    else:
        stations = latest_per_key(stations_from_documents(st), ["station_id"], ["seq"])  # as in the node table
        pairs = nearby_pairs(stations, stop_points, p.radius_m)
        nb = D.landed(nearby_documents(pairs), f"{out_dir}/documents/nearby")
    D.rejected_documents(st, nb, mb).write.parquet(f"{out_dir}/rejected")
    current = read_graph(spark, current_dir) if current_dir else None
    write_graph(build_graph(st, nb, mb, current, mode, guard=False), out_dir)
    g = read_graph(spark, out_dir)
    bad, linked = integrity(g, members_from_documents(mb).select("line_id", "station_id").distinct())
    bad.write.parquet(f"{out_dir}/key_violations")
    linked.write.parquet(f"{out_dir}/link_counts")
    require_clean(audit_written(spark, {t: (getattr(g, t), [k]) for t, k in NODE_KEYS.items()}, f"{out_dir}/quarantine"), f"{out_dir}/quarantine")
    write_options_snapshot(line_options(nearest_paths(g, p.path_limit), g.lines, p), f"{out_dir}/options")
    if publish_root:
        publish_snapshot(spark, publish_root, f"{out_dir}/options")
    return graph_summary(g)


# ---- E2 ---------------------------------------------------------------------------------

def stream(records: DataFrame, options_path: str, history_path: str, checkpoint: str,
           run_id: str | None = None, trigger: dict | None = None, quarantine_path: str | None = None,
           p: Params = DEFAULT, partials_path: str | None = None) -> list[StreamingQuery]:
    """Start the alert query on broker records (``value``, ``timestamp``).

    ``options_path`` is a snapshot folder, or a root that seeds publish to (then
    every batch uses the newest published snapshot).

    ``run_id`` must be new whenever ``checkpoint`` is new (batch ids restart).
    With ``quarantine_path`` the same query also keeps the records that did not parse (one read of the topic, one
    checkpoint, both outputs replay-safe); with ``partials_path``, and no quarantine, it also keeps what the reports need of each batch.
    """
    run_id = run_id or uuid.uuid4().hex
    writer = AlertBatchWriter(options_path, history_path, run_id, p, keep=["event_hub_timestamp"], partials_path=partials_path)
    if quarantine_path:
        both = AlertAndQuarantineWriter(writer, quarantine_path).outputs()
        return [start_alert_stream(records.select("value", "timestamp"), both, f"{checkpoint}/alerts", trigger)]
    return [start_alert_stream(disrupted_stream(records), writer, f"{checkpoint}/alerts", trigger)]


def compact_history(spark: SparkSession, history_path: str, keep_open: int = 1, grace_seconds: int = 86_400) -> tuple[bool, int]:
    """K2: closed batches into large files, and what those have replaced deleted after the grace time: (whether
    there were closed batches, folders deleted). May run beside the stream."""
    done = compaction.compact(spark, history_path, keep_open)
    return done, compaction.vacuum(spark, history_path, grace_seconds)


# ---- E4 ---------------------------------------------------------------------------------

def report(spark: SparkSession, history_path: str, run_id: str | None = None, partials_path: str | None = None) -> dict[str, DataFrame]:
    """Summary, newest 10 and first 20 alerts; ``run_id`` restricts to one run, which
    prunes the history to that run's partition folders. With ``partials_path`` the first two come from
    the batches' partial results and read no alert."""
    def one_run(df: DataFrame) -> DataFrame:
        return df if run_id is None else df.filter(F.col("run_id") == F.lit(run_id))

    h = one_run(read_history(spark, history_path))
    first = first_alerts(h, 20, order=["run_id", "batch_id", "line_id"])
    if partials_path is not None:
        held = one_run(read_history(spark, partials_path))
        return {"summary": partials.summary(held), "latest": partials.latest(held, 10, ["batch_id"]), "first": first}
    return {"summary": alert_summary(h), "latest": latest_alerts(h, 10, tie_breakers=["line_id", "batch_id"]), "first": first}
