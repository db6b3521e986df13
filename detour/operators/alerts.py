"""Disrupted events -> alert rows.

The per-event graph lookup of the original is decorrelated into one left join of
the events with the per-line options table: an event whose line has no path still
yields an alert, with empty lists and the gridlock flag set (D5).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from detour.functions.columns import gridlock_label, py_timestamp_str
from detour.operators.options import is_gridlock
from detour.params import DEFAULT, Params

ALERT_COLUMNS = ["line_id", "line_name", "severity", "gridlock_alert", "affected_stations",
                 "available_routes", "nearby_bus_stops", "batch_id", "ingested_at_utc", "processed_at_utc"]


def attach_options(events: DataFrame, options: DataFrame) -> DataFrame:
    """Left join on ``line_id``. ``options`` has one row per line, so the join
    never multiplies events. Callers mark it for broadcast after a bounded count
    (:func:`detour.operators.options.bounded_options`,
    :func:`detour.operators.sizing.broadcast_if_bounded`); unmarked, the planner
    broadcasts it only under its size threshold and shuffles both sides otherwise."""
    o = options.select("line_id", "affected_stations", "available_routes", "nearby_bus_stops",
                       F.lit(True).alias("is_known_line"))
    return events.join(o, "line_id", "left")


def build_alerts(disrupted: DataFrame, options: DataFrame, p: Params = DEFAULT,
                 batch_id: Column | int | None = None, processed_at: Column | None = None,
                 keep: list[str] | None = None) -> DataFrame:
    """One alert per disrupted event.

    ``disrupted`` carries the status-event columns and ``processed_at_utc``
    (timestamp). ``processed_at`` overrides it. ``keep`` lists extra input columns
    to carry through (e.g. ids, ``event_hub_timestamp``).
    """
    keep = keep or []
    j = attach_options(disrupted, options)
    empty_s = F.array().cast("array<string>")
    routes = F.coalesce(F.col("available_routes"), empty_s)
    proc = processed_at if processed_at is not None else F.col("processed_at_utc")
    bid = F.lit(batch_id) if isinstance(batch_id, int) or batch_id is None else batch_id
    return j.select(
        *keep,
        "line_id", "line_name",
        F.col("severity_desc").alias("severity"),
        is_gridlock(F.size(routes), p).alias("gridlock_alert"),
        F.coalesce(F.col("affected_stations"), empty_s).alias("affected_stations"),
        routes.alias("available_routes"),
        F.coalesce(F.col("nearby_bus_stops"), F.array()).alias("nearby_bus_stops"),
        bid.cast("long").alias("batch_id"),
        "ingested_at_utc",
        py_timestamp_str(proc).alias("processed_at_utc"),
        F.coalesce(F.col("is_known_line"), F.lit(False)).alias("is_known_line"),
    )


def alert_label(alerts: DataFrame) -> DataFrame:
    """F8 status text next to each alert."""
    return alerts.withColumn("status_label", gridlock_label(F.col("gridlock_alert")))
