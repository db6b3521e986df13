"""Stream equals batch; replays leave the history unchanged; a new run keeps the old one."""

import uuid

from pyspark.sql import functions as F

from detour.plans import catalog as C
from detour.session import fresh_path
from detour.sources.history import read_history
from detour.sources.tables import stream_table
from detour.streaming import jobs as J
from detour.streaming.processor import AlertBatchWriter, start_alert_stream, write_options_snapshot
from tests.conftest import SF


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_equals_batch_disrupted(spark):
    assert _sorted(J.stream_disrupted(spark, SF)) == _sorted(C.disrupted_events(spark, SF).select(*J.EVENT_COLUMNS))


def test_stream_equals_batch_alerts(spark):
    assert _sorted(J.stream_alerts(spark, SF)) == _sorted(C.gridlock_alerts(spark, SF))


def test_replay_and_new_run(spark):
    history = fresh_path(spark, "test", "history")
    options = write_options_snapshot(C.options_for(spark, SF), fresh_path(spark, "test", "options"))

    def run(run_id, writes=1):
        w = AlertBatchWriter(options, history, run_id, C.P, keep=["event_id"])
        q = start_alert_stream(J._disrupted_events_stream(spark, SF), lambda b, i: [w(b, i) for _ in range(writes)],
                               fresh_path(spark, "test", "ckpt"), J.AVAILABLE_NOW)
        q.awaitTermination()

    r1 = uuid.uuid4().hex
    run(r1)
    first = _sorted(read_history(spark, history).drop("processed_at_utc"))
    assert first
    run(r1, writes=2)                      # replay of batch 0 under a new checkpoint
    assert _sorted(read_history(spark, history).drop("processed_at_utc")) == first
    run(uuid.uuid4().hex)                  # a new run: batch ids restart, history is kept
    h = read_history(spark, history)
    assert h.select("run_id").distinct().count() == 2
    assert h.filter(F.col("run_id") == r1).count() == len(first)


def test_stream_source_is_streaming(spark):
    s = stream_table(spark, SF, "events")
    assert s.isStreaming
    assert J._disrupted_events_stream(spark, SF).isStreaming


def test_several_micro_batches(spark):
    """Three input files, one per trigger: three history partitions whose union is the batch answer."""
    from detour.schemas import BROKER_RECORD
    from detour.sources.broker import to_broker_records
    from detour.plans.proxy import status_events

    ev = status_events(spark.read.parquet(f"{SF}/events.parquet"), C.P)
    rec = to_broker_records(ev, C.PAYLOAD_FIELDS, timestamp_col="ts")
    src = fresh_path(spark, "test", "broker")
    for i in range(3):
        rec.filter(F.col("timestamp").isNotNull() & (F.pmod(F.hash("value"), F.lit(3)) == i)).coalesce(1) \
           .write.mode("append").parquet(src)
    options = write_options_snapshot(C.options_for(spark, SF), fresh_path(spark, "test", "options"))
    history = fresh_path(spark, "test", "history")
    parsed = spark.readStream.schema(BROKER_RECORD).option("maxFilesPerTrigger", "1").parquet(src)
    from detour.operators.parse import disrupted, parse_records
    events = disrupted(parse_records(parsed, C.PAYLOAD_SCHEMA), processed_at=F.col("event_hub_timestamp"))
    w = AlertBatchWriter(options, history, "r", C.P, keep=["event_id"])
    start_alert_stream(events, w, fresh_path(spark, "test", "ckpt"), J.AVAILABLE_NOW).awaitTermination()
    h = read_history(spark, history)
    assert h.select("batch_id").distinct().count() == 3
    assert _sorted(C.alert_scalars(h)) == _sorted(C.gridlock_alerts(spark, SF))


def test_write_errors_fail_the_stream(spark, tmp_path):
    """A history write that fails is not swallowed; the query stops with the error."""
    import pytest
    from pyspark.errors import StreamingQueryException
    blocker = tmp_path / "not_a_dir"
    blocker.write_text("x")                         # history path is a file: every write fails
    options = write_options_snapshot(C.options_for(spark, SF), fresh_path(spark, "test", "o"))
    w = AlertBatchWriter(options, str(blocker), "r", C.P, keep=["event_id"])
    q = start_alert_stream(J._disrupted_events_stream(spark, SF), w, fresh_path(spark, "test", "c"), J.AVAILABLE_NOW)
    with pytest.raises(StreamingQueryException):
        q.awaitTermination()


def test_processing_time_trigger(spark):
    """The query runs on a processing-time trigger until stopped."""
    options = write_options_snapshot(C.options_for(spark, SF), fresh_path(spark, "test", "o"))
    history = fresh_path(spark, "test", "h")
    w = AlertBatchWriter(options, history, "r", C.P, keep=["event_id"])
    q = start_alert_stream(J._disrupted_events_stream(spark, SF), w, fresh_path(spark, "test", "c"),
                           {"processingTime": "1 second"})
    try:
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    assert _sorted(C.alert_scalars(read_history(spark, history))) == _sorted(C.gridlock_alerts(spark, SF))


def test_report_for_one_run_prunes_partitions(spark):
    from detour import jobs
    history = fresh_path(spark, "test", "hist_runs")
    options = J._snapshot(spark, SF)
    J._run_alerts(spark, SF, history, options, "run-a")
    J._run_alerts(spark, SF, history, options, "run-b")
    rep = jobs.report(spark, history, run_id="run-a")
    plan = rep["summary"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan and "run-a" in plan
    assert rep["summary"].first().total_alerts == read_history(spark, history).filter("run_id = 'run-a'").count()


def test_history_carries_the_alert_contract(spark):
    """Every field of the alert schema, with its type (nested path rows included)."""
    from detour.schemas import ALERT
    history = fresh_path(spark, "test", "contract")
    J._run_alerts(spark, SF, history, J._snapshot(spark, SF), "r")
    got = read_history(spark, history).schema

    def norm(t: str) -> str:           # the proxy's line and stop ids are numbers
        return t.replace("bus_stop_id:bigint", "bus_stop_id:string")

    for f in ALERT.fields:
        assert f.name in got.fieldNames(), f.name
        if f.name == "line_id":
            continue
        assert norm(got[f.name].dataType.simpleString()) == f.dataType.simpleString(), f.name


def test_a_large_batch_is_read_by_many_tasks(spark, tmp_path, monkeypatch):
    """Four batches whatever the size; a larger one comes in more files."""
    from detour.streaming import jobs
    monkeypatch.setattr(jobs, "FILE_ROWS", 10)
    assert jobs.write_batches(spark.range(400), str(tmp_path / "many"), 4) == 10
    assert len(list((tmp_path / "many").glob("part-*"))) == 40 and spark.read.parquet(str(tmp_path / "many")).distinct().count() == 400
    assert jobs.write_batches(spark.range(40), str(tmp_path / "few"), 4) == 1
