"""Reports over the alert history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from detour.functions.columns import json_payload, preview

REPORT_COLUMNS = ["line_name", "severity", "gridlock_alert", "processed_at_utc"]


def alert_summary(history: DataFrame) -> DataFrame:
    """A1 + A8 + A9: total rows, distinct line names, processing-time range (text order).
    One global aggregate with partial aggregation."""
    return history.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.countDistinct("line_name").alias("unique_lines"),
        F.min("processed_at_utc").alias("first_processed_at"),
        F.max("processed_at_utc").alias("last_processed_at"),
    )


def unique_lines(history: DataFrame) -> DataFrame:
    """The distinct line names."""
    return history.select("line_name").distinct()


def latest_alerts(history: DataFrame, n: int = 10, tie_breakers: list[str] | None = None) -> DataFrame:
    """T4 + P13: the newest ``n`` alerts. ``orderBy + limit`` plans as a
    ``TakeOrderedAndProject``: each task keeps its own top ``n``, no full sort."""
    ties = [F.col(c).asc_nulls_last() for c in (tie_breakers or [])]
    return (history.orderBy(F.col("processed_at_utc").desc_nulls_last(), *ties)
                   .limit(n).select(*_report_columns(tie_breakers)))


def first_alerts(history: DataFrame, n: int = 20, order: list[str] | None = None) -> DataFrame:
    """T5: the first ``n`` rows. The original shows any 20; an order makes it repeatable."""
    df = history.orderBy(*[F.col(c).asc_nulls_last() for c in order]) if order else history
    return df.limit(n).select(*_report_columns(order))


def _report_columns(extra: list[str] | None) -> list[str]:
    return REPORT_COLUMNS + [c for c in (extra or []) if c not in REPORT_COLUMNS]


def payload_preview(alerts: DataFrame, fields: list[str], n: int = 200, out: str = "preview") -> DataFrame:
    """F6 + F7: the JSON text of an alert and its first ``n`` characters."""
    return alerts.withColumn(out, preview(json_payload(*fields), n))
