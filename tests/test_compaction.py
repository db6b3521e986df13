"""K2 / R6 over time: compaction beside the stream, replays, deletion; partial results."""

import pytest
from pyspark.sql import functions as F

from detour import jobs
from detour.operators.reports import alert_summary, latest_alerts
from detour.session import fresh_path
from detour.sources import manifest
from detour.sources.history import read_history
from detour.streaming import compaction, partials
from detour.streaming.sink import write_batch

ALERT = "line_name string, severity string, gridlock_alert boolean, processed_at_utc string, k long"


def batch(spark, n, size=3):
    rows = [(f"L{(n + i) % 4}", "Severe", i % 2 == 0, f"2024-01-0{1 + n % 3} 00:00:{10 * n + i:02d}", 100 * n + i) for i in range(size)]
    return spark.createDataFrame(rows, ALERT).withColumn("batch_id", F.lit(n).cast("long"))


def keys(df):
    return sorted(r.k for r in df.collect())


def live(spark, path):
    return sorted((r.run_id, r.batch_id) for r in spark.read.parquet(path).select("run_id", "batch_id").distinct().collect())


def test_every_alert_is_read_once_at_any_time(spark):
    path, want = fresh_path(spark, "test", "history"), []
    for n in range(7):
        write_batch(batch(spark, n), path, "a1")
        want += [100 * n + i for i in range(3)]
        assert keys(read_history(spark, path)) == want
        if n % 2:
            assert compaction.compact(spark, path, keep_open=1, fan_in=2)
            assert keys(read_history(spark, path)) == want
    assert not compaction.compact(spark, path, keep_open=2)       # nothing but open batches is left
    version = compaction.newest(spark, path)
    assert {c["run_id"]: c["through"] for c in version["compacted"]} == {"a1": 4} and max(s["level"] for s in version["segments"]) == 1
    write_batch(batch(spark, 1), path, "a1")                      # a replay of a batch that is compacted
    write_batch(batch(spark, 0), path, "b2")                      # another run counts from 0
    assert keys(read_history(spark, path)) == sorted(want + [0, 1, 2])
    assert compaction.vacuum(spark, path, grace_seconds=3600) == 0
    assert compaction.vacuum(spark, path, grace_seconds=0) > 0
    assert live(spark, path) == [("a1", 5), ("a1", 6), ("b2", 0)]
    assert keys(read_history(spark, path)) == sorted(want + [0, 1, 2])
    got = read_history(spark, path)
    assert dict(got.dtypes)["run_id"] == "string" and dict(got.dtypes)["batch_id"] == "bigint" and compaction.DATE not in got.columns


def test_compacted_folders_are_pruned(spark):
    path = fresh_path(spark, "test", "history")
    for n in range(4):
        write_batch(batch(spark, n), path, "r")
    compaction.compact(spark, path)
    p = read_history(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in p and "batch_id" in p.split("PartitionFilters: [")[1].split("]")[0]


def test_reads_before_a_version_and_empty(spark):
    path = fresh_path(spark, "test", "history")
    assert not compaction.compact(spark, path) and compaction.vacuum(spark, path) == 0
    with pytest.raises(ValueError):
        read_history(spark, path)
    with pytest.raises(ValueError):
        compaction.compact(spark, path, keep_open=0)


def test_two_writers_are_noticed(spark):
    path = fresh_path(spark, "test", "manifest")
    for _ in range(2):
        manifest.append(spark, path, "x int", (1,), None)
    with pytest.raises(RuntimeError):
        manifest.newest(spark, path, "x int")


def test_the_newest_batch_is_left_while_another_run_goes_on(spark):
    path = fresh_path(spark, "test", "history")
    for run, n in (("a", 0), ("a", 1), ("b", 0)):
        write_batch(batch(spark, n), path, run)
    assert jobs.compact_history(spark, path, grace_seconds=0) == (True, 1)
    assert live(spark, path) == [("a", 1), ("b", 0)]
    assert keys(read_history(spark, path)) == [0, 0, 1, 1, 2, 2, 100, 101, 102]


def test_partial_results_give_the_reports(spark):
    history, parts = fresh_path(spark, "test", "h"), fresh_path(spark, "test", "p")
    for n in (0, 1, 2, 1):                                         # batch 1 is replayed
        rows = batch(spark, n, 14 if n == 2 else 3)
        write_batch(rows, history, "r")
        write_batch(partials.batch_partials(rows, ["k"]).withColumn("batch_id", F.lit(n).cast("long")), parts, "r")
    compaction.compact(spark, parts, clock="last_processed_at")
    h, p = read_history(spark, history), read_history(spark, parts)
    assert partials.summary(p).collect() == alert_summary(h).collect()
    assert partials.latest(p, 10, ["k"]).collect() == latest_alerts(h, 10, ["k"]).collect()
    assert sorted(r.line_name for r in partials.lines(p).collect()) == ["L0", "L1", "L2", "L3"]
    assert partials.summary(p.limit(0)).first().total_alerts == 0
    with pytest.raises(ValueError):
        partials.latest(p, 11)
