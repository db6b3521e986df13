"""Streaming entries of the query catalogue: the stream replays the events table
as a file stream (``availableNow``) and the result is read back from storage."""

from __future__ import annotations

import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from detour.jobs import ingest_stream
from detour.plans import catalog as C
from detour.plans import proxy
from detour.session import fresh_path
from detour.sources.history import read_history
from detour.sources.tables import load_table, stream_table
from detour.sources.broker import to_broker_records
from detour.streaming import compaction, partials
from detour.streaming.outputs import BatchOutputs
from detour.streaming.processor import (
    AlertAndQuarantineWriter, AlertBatchWriter, start_alert_stream, start_event_sink, write_options_snapshot,
)
from detour.functions.columns import py_timestamp_str
from detour.operators import reports as R
from detour.operators.parse import disrupted, parse_records

AVAILABLE_NOW = {"availableNow": True}
EVENT_COLUMNS = ["event_id", "event_type", "line_id", "line_name", "severity_code", "severity_desc",
                 "is_disrupted", "disruption_detail", "ingested_at_utc"]


def _disrupted_events_stream(spark: SparkSession, base: str) -> DataFrame:
    """events file stream -> K1 broker records -> P1-P3 parse -> P4/P5."""
    parsed = C.broker_events(stream_table(spark, base, "events"))
    return disrupted(parsed, processed_at=F.col("event_hub_timestamp"))


def stream_disrupted(spark: SparkSession, base: str) -> DataFrame:
    out = fresh_path(spark, "stream_disrupted", "data")
    q = start_event_sink(_disrupted_events_stream(spark, base), out,
                         fresh_path(spark, "stream_disrupted", "checkpoint"), AVAILABLE_NOW)
    q.awaitTermination()
    return spark.read.parquet(out).select(*EVENT_COLUMNS)


def _run_alerts(spark: SparkSession, base: str, history: str, options: str, run_id: str,
                events: DataFrame | None = None, written_twice: bool = False) -> list[dict]:
    writer = AlertBatchWriter(options, history, run_id, C.P, keep=["event_id", "event_hub_timestamp"])

    def twice(batch: DataFrame, batch_id: int) -> None:   # a batch that is replayed right after its write
        writer(batch, batch_id)
        writer(batch, batch_id)

    q = start_alert_stream(_disrupted_events_stream(spark, base) if events is None else events, twice if written_twice else writer,
                           fresh_path(spark, "stream_alerts", "checkpoint"), AVAILABLE_NOW)
    q.awaitTermination()
    return q.recentProgress


def alert_stream_progress(spark: SparkSession, base: str) -> dict:
    """Run the alert stream once over the events table; report what its progress
    events say (input rows, trigger time, rows per second of processing)."""
    history = fresh_path(spark, "stream_progress", "history")
    prog = [p for p in _run_alerts(spark, base, history, _snapshot(spark, base), uuid.uuid4().hex)
            if p.get("numInputRows")]
    rows = sum(p["numInputRows"] for p in prog)
    trigger_ms = sum(p.get("durationMs", {}).get("triggerExecution", 0) for p in prog)
    return {"batches": len(prog), "input_rows": rows, "trigger_execution_ms": trigger_ms,
            "rows_per_sec": round(rows / (trigger_ms / 1000.0), 1) if trigger_ms else None}


def _snapshot(spark: SparkSession, base: str) -> str:
    return write_options_snapshot(C.options_for(spark, base),
                                  fresh_path(spark, "stream_alerts", "options"))


def stream_alerts(spark: SparkSession, base: str) -> DataFrame:
    history = fresh_path(spark, "stream_alerts", "history")
    _run_alerts(spark, base, history, _snapshot(spark, base), uuid.uuid4().hex)
    return C.alert_scalars(read_history(spark, history))


FILE_ROWS = 50_000   # of a file of a batch: the tasks that read a batch grow with it


def write_batches(rows: DataFrame, path: str, batches: int) -> int:
    """Write ``rows`` for ``batches`` batches of about the same size, each of as many files as its rows make; that number."""
    files = max(-(-rows.count() // (batches * FILE_ROWS)), 1)
    rows.repartition(batches * files).write.parquet(path)
    return files


def stream_replay(spark: SparkSession, base: str) -> DataFrame:
    """The events in four batches; the same run twice under fresh checkpoints
    (every batch is replayed), each batch of the first written twice: the history must still
    hold each alert once."""
    history, files = fresh_path(spark, "stream_replay", "history"), fresh_path(spark, "stream_replay", "events")
    events = load_table(spark, base, "events")
    per_batch = write_batches(events, files, 4)
    options = _snapshot(spark, base)
    run_id = uuid.uuid4().hex
    for written_twice in (True, False):
        parts = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", str(per_batch)).parquet(files)
        parsed = disrupted(C.broker_events(parts), processed_at=F.col("event_hub_timestamp"))
        _run_alerts(spark, base, history, options, run_id, parsed, written_twice)
    return C.alert_scalars(read_history(spark, history))


def written_history(spark: SparkSession, base: str) -> DataFrame:
    """The alert history that the stream wrote."""
    history = fresh_path(spark, "reports", "history")
    _run_alerts(spark, base, history, _snapshot(spark, base), uuid.uuid4().hex)
    return read_history(spark, history)


def alert_summary(spark: SparkSession, base: str) -> DataFrame:
    """Alert count, distinct lines, processing-time range of a written history."""
    return R.alert_summary(written_history(spark, base))


def alert_lines(spark: SparkSession, base: str) -> DataFrame:
    """Distinct line names in the alert history."""
    return R.unique_lines(written_history(spark, base))


def latest_alerts(spark: SparkSession, base: str) -> DataFrame:
    """The newest 10 alerts."""
    return R.latest_alerts(written_history(spark, base), 10, tie_breakers=["event_id"])


def first_alerts(spark: SparkSession, base: str) -> DataFrame:
    """The first 20 alerts (ordered for repeatability)."""
    return R.first_alerts(written_history(spark, base), 20, order=["processed_at_utc", "event_id"])


def history_options_exploded(spark: SparkSession, base: str) -> DataFrame:
    """Nested rows, batch id and the three clocks as the history holds them."""
    return C.exploded_options(written_history(spark, base)
                              .withColumn("event_hub_time", py_timestamp_str(F.col("event_hub_timestamp"))), "event_hub_time")


def _four_batches(spark: SparkSession, base: str, name: str) -> tuple[DataFrame, str]:
    """The events in four batches: (the disrupted ones as a stream, folder)."""
    files, events = fresh_path(spark, name, "events"), load_table(spark, base, "events")
    per_batch = write_batches(events, files, 4)
    parts = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", str(per_batch)).parquet(files)
    return disrupted(C.broker_events(parts), processed_at=F.col("event_hub_timestamp")), files


def history_compacted(spark: SparkSession, base: str) -> DataFrame:
    """A history that is compacted while the stream writes (twice, and its segments merged), whose first batch
    is then replayed, and from which the replaced folders are deleted."""
    history = fresh_path(spark, "history_compacted", "history")
    writer = AlertBatchWriter(_snapshot(spark, base), history, uuid.uuid4().hex, C.P, keep=["event_id", "event_hub_timestamp"])
    first = fresh_path(spark, "history_compacted", "first")

    def step(batch: DataFrame, batch_id: int) -> None:
        if batch_id == 0:
            batch.write.parquet(first)
        writer(batch, batch_id)
        if batch_id in (1, 3):
            compaction.compact(spark, history, keep_open=1, fan_in=2)

    events, _ = _four_batches(spark, base, "history_compacted")
    start_alert_stream(events, step, fresh_path(spark, "history_compacted", "checkpoint"), AVAILABLE_NOW).awaitTermination()
    writer(spark.read.parquet(first), 0)
    compaction.vacuum(spark, history, grace_seconds=0)
    return C.alert_scalars(read_history(spark, history))


def _partials(spark: SparkSession, base: str) -> DataFrame:
    """The partial results of a stream in four batches, the first of which is written twice."""
    out = fresh_path(spark, "partials", "partials")
    writer = AlertBatchWriter(_snapshot(spark, base), fresh_path(spark, "partials", "history"), uuid.uuid4().hex, C.P,
                              keep=["event_id"], partials_path=out, ties=["event_id"])

    def step(batch: DataFrame, batch_id: int) -> None:
        for _ in range(2 if batch_id == 0 else 1):
            writer(batch, batch_id)

    events, _ = _four_batches(spark, base, "partials")
    start_alert_stream(events, step, fresh_path(spark, "partials", "checkpoint"), AVAILABLE_NOW).awaitTermination()
    return read_history(spark, out)


def partial_summary(spark: SparkSession, base: str) -> DataFrame:
    """A1, A8, A9 from the batches' partial results: no alert file is read."""
    return partials.summary(_partials(spark, base))


def partial_latest(spark: SparkSession, base: str) -> DataFrame:
    """T4, P13 from the batches' partial results."""
    return partials.latest(_partials(spark, base), 10, tie_breakers=["event_id"])


def stream_quarantine(spark: SparkSession, base: str) -> DataFrame:
    """Alerts and unparsed records from one read. The job dies between the two writes of its first
    batch and is started again; alerts by line, and the rejected records, counted."""
    history, bad = (fresh_path(spark, "stream_quarantine", x) for x in ("history", "rejected"))
    checkpoint, files = (fresh_path(spark, "stream_quarantine", x) for x in ("checkpoint", "records"))
    events = proxy.status_events(load_table(spark, base, "events"), C.P)
    records = to_broker_records(events, C.PAYLOAD_FIELDS, timestamp_col="ts").withColumn("event_id", F.get_json_object(F.col("value").cast("string"), "$.event_id").cast("long"))
    broken = F.col("event_id") % 17 == 0
    records = records.select(F.when(broken, F.substring(F.col("value").cast("string"), 1, 12).cast("binary")).otherwise(F.col("value")).alias("value"), "timestamp")
    per_batch = write_batches(records, files, 2)
    writer = AlertBatchWriter(_snapshot(spark, base), history, uuid.uuid4().hex, C.P, keep=["event_id"])
    both = AlertAndQuarantineWriter(writer, bad, C.PAYLOAD_SCHEMA, F.col("event_hub_timestamp")).outputs()

    class Lost(Exception):
        pass

    def dies(batch: DataFrame, batch_id: int) -> None:
        BatchOutputs(both.outputs[:1], both.run_id, both.prepare)(batch, batch_id)
        raise Lost("between the outputs")

    stream = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", str(per_batch)).parquet(files)
    try:
        start_alert_stream(stream, dies, checkpoint, AVAILABLE_NOW).awaitTermination()
    except StreamingQueryException:
        pass
    start_alert_stream(stream, both, checkpoint, AVAILABLE_NOW).awaitTermination()
    alerts = read_history(spark, history).groupBy(F.lit("alert").alias("state"), "line_id", "gridlock_alert").agg(F.count(F.lit(1)).alias("n"))
    rejected = read_history(spark, bad).agg(F.count(F.lit(1)).alias("n")).select(F.lit("rejected").alias("state"), F.lit(-1).cast("long").alias("line_id"), F.lit(False).alias("gridlock_alert"), "n")
    return alerts.unionByName(rejected.filter("n > 0"))


def intake_stream(spark: SparkSession, base: str) -> DataFrame:
    """S3, P6, A12, K1 as a running job: the documents of ``intake_status_events`` arrive in four files; the job is
    stopped after two batches and started again, and its last batch is written twice."""
    docs, checkpoint, out, bad = (fresh_path(spark, "intake_stream", x) for x in ("docs", "checkpoint", "events", "rejected"))
    C.status_texts(spark, base).repartition(4).write.text(docs)
    run_id, poll = uuid.uuid4().hex, F.lit("2024-01-01T00:00:00+00:00")
    q = ingest_stream(spark, docs, out, checkpoint, bad, run_id, {"processingTime": "0 seconds"}, 1, poll)
    try:
        while not q.lastProgress or q.lastProgress["batchId"] < 1:
            if q.exception():
                raise q.exception()
            q.awaitTermination(0.05)
    finally:
        q.stop()
    ingest_stream(spark, docs, out, checkpoint, bad, run_id, AVAILABLE_NOW, 1, poll).awaitTermination()
    events = parse_records(read_history(spark, out))
    return C.intake_counts(events, read_history(spark, bad))


def stream_queries():
    return {"stream_disrupted": stream_disrupted, "stream_alerts": stream_alerts, "stream_replay": stream_replay,
            "alert_lines": alert_lines, "alert_summary": alert_summary, "latest_alerts": latest_alerts,
            "first_alerts": first_alerts, "history_options_exploded": history_options_exploded,
            "history_compacted": history_compacted, "partial_summary": partial_summary, "partial_latest": partial_latest,
            "stream_quarantine": stream_quarantine, "intake_stream": intake_stream}
