"""The scale properties of the plans, asserted on Spark's physical plans."""

import pytest
from pyspark.sql import functions as F

from detour.operators.status import worst_status_rows
from detour.operators.upsert import latest_per_key
from detour.plans import catalog as C
from detour.plans import proxy
from detour.operators.paths import nearest_paths
from tests.conftest import SF


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_is_cut_before_the_shuffle(spark):
    p = plan(nearest_paths(proxy.listed_graph(spark, SF), 100))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_latest_per_key_is_cut_before_the_shuffle(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    p = plan(latest_per_key(li, ["l_suppkey", "l_partkey"], ["l_shipdate", "l_orderkey"]))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_worst_status_aggregates_partially(spark):
    rows = proxy.status_rows(spark.read.parquet(f"{SF}/events.parquet"), True)
    p = plan(worst_status_rows(rows, ["line_id", "poll_ts"], "event_id", "severity", "severity_desc",
                               "disruption_detail"))
    assert "partial_min" in p and "partial_count" in p


def test_events_are_not_shuffled_for_the_alert_join(spark):
    p = plan(C.gridlock_alerts(spark, SF))
    assert "BroadcastHashJoin" in p and "LeftOuter, BuildRight" in p
    # the events scan feeds the join directly: its filter reaches parquet
    assert "LessThan(value,10.0)" in p


def test_no_distance_but_the_documented_radius(spark):
    """The nearest-100 queries take every listed edge; the others those within 300 m."""
    assert "l_extendedprice" not in plan(C.line_paths(spark, SF))
    scan = [x for x in plan(C.nearest_paths_q(spark, SF)).split("\n") if "lineitem.parquet" in x]
    assert scan and all("l_extendedprice," not in x.split("PushedFilters")[1].split("ReadSchema")[0] for x in scan)
    assert C.P.radius_m == 300.0


@pytest.mark.parametrize("query", [C.nearest_paths_q, C.line_lookup])
def test_pairs_are_cut_before_they_are_expanded(spark, query):
    """The rows that are named, joined with their routes and ranked are those within the line's last distance step."""
    p = plan(query(spark, SF)).split("\n")
    cut = next(i for i, x in enumerate(p) if "_step" in x and "_last" in x and "Filter" in x)
    above = "\n".join(p[:cut])
    assert "WindowGroupLimit" in above and above.count("Join") >= 3 and "hashpartitioning(stop_id" not in above
    assert "WindowGroupLimit" not in "\n".join(p[cut:])


def test_upsert_leaves_the_current_table_in_place(spark):
    from detour.operators.upsert import upsert
    li = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_quantity")
    inc = spark.createDataFrame([(1, 2.0, 1)], "l_orderkey long, l_quantity double, seq int")
    p = plan(upsert(li, inc, ["l_orderkey"], ["seq"]))
    kept = p[:p.index("LocalTableScan")] if "LocalTableScan" in p else p
    assert "BroadcastHashJoin" in kept and "LeftAnti" in kept


@pytest.mark.parametrize("name", sorted(C.batch_queries()))
def test_no_cross_products_or_python(spark, name):
    p = plan(C.batch_queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in p, f"{name}: {bad}"


def test_scans_read_only_needed_columns(spark):
    p = plan(C.gridlock_alerts(spark, SF).select("event_id", F.col("gridlock_alert")))
    events_scan = [x for x in p.split("\n") if "events.parquet" in x][0]
    assert "ts:" not in events_scan and "props" not in events_scan


def test_stream_batch_shuffles_only_for_the_output_files(spark):
    """Per micro-batch: parse, filter, broadcast join to the snapshot; the one exchange is
    the REBALANCE before the write."""
    from detour.operators.alerts import build_alerts
    from detour.operators.parse import disrupted
    from detour.operators.sizing import broadcast_if_bounded
    from detour.streaming import jobs as J
    opts = broadcast_if_bounded(spark.read.parquet(J._snapshot(spark, SF)))
    batch = disrupted(C.broker_events(spark.read.parquet(f"{SF}/events.parquet")),
                      processed_at=F.col("event_hub_timestamp"))
    out = build_alerts(batch, opts, C.P, batch_id=0).hint("rebalance")
    p = plan(out)
    assert p.count("Exchange RoundRobinPartitioning") == 1 and "Exchange hashpartitioning" not in p
    assert "BroadcastHashJoin" in p
