"""A1, A8, A9, T4 over a long history: mergeable partial results, one small set of rows a batch.

For each batch: the number of alerts and the range of their processing times (one row), its distinct line names (a row each),
and its newest alerts (at most ``NEWEST``). They lie in a table of their own, partitioned and overwritten like the history
itself, so a replayed batch replaces its partial result. Counts add up, ranges and names merge, and the newest of all are among the
newest of each batch: the reports read no alert. The table compacts like the history (``detour.streaming.compaction``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from detour.operators.reports import REPORT_COLUMNS, latest_alerts

NEWEST = 10
SUMMARY, LINE, ALERT = "summary", "line", "alert"


def batch_partials(alerts: DataFrame, ties: list[str] | None = None) -> DataFrame:
    """(kind, n_alerts, first_processed_at, last_processed_at, report columns, ties) of one batch."""
    ties = [c for c in (ties or []) if c not in REPORT_COLUMNS]
    named = lambda c: F.lit(None).cast(alerts.schema[c].dataType).alias(c)
    none = {c: named(c) for c in [*REPORT_COLUMNS, *ties]}
    text = lambda c: F.lit(None).cast("string").alias(c)
    counts = alerts.agg(F.count(F.lit(1)).alias("n_alerts"), F.min("processed_at_utc").alias("first_processed_at"), F.max("processed_at_utc").alias("last_processed_at"))
    clocks = ["first_processed_at", "last_processed_at"]
    parts = [
        counts.filter("n_alerts > 0").select(F.lit(SUMMARY).alias("kind"), "n_alerts", *clocks, *none.values()),
        alerts.select("line_name").distinct().select(F.lit(LINE).alias("kind"), F.lit(0).cast("long").alias("n_alerts"), *map(text, clocks),
                                                     *["line_name" if c == "line_name" else x for c, x in none.items()]),
        latest_alerts(alerts, NEWEST, ties).select(F.lit(ALERT).alias("kind"), F.lit(0).cast("long").alias("n_alerts"), *map(text, clocks), *none)]
    return reduce(DataFrame.unionByName, parts)


def summary(partials: DataFrame) -> DataFrame:
    """A1 + A8 + A9, as by :func:`detour.operators.reports.alert_summary` over the alerts themselves."""
    return partials.agg(F.coalesce(F.sum("n_alerts"), F.lit(0)).alias("total_alerts"),
                        F.count_distinct(F.when(F.col("kind") == LINE, F.col("line_name"))).alias("unique_lines"),
                        F.min("first_processed_at").alias("first_processed_at"), F.max("last_processed_at").alias("last_processed_at"))


def lines(partials: DataFrame) -> DataFrame:
    """The distinct line names."""
    return partials.filter(F.col("kind") == LINE).select("line_name").distinct()


def latest(partials: DataFrame, n: int = NEWEST, tie_breakers: list[str] | None = None) -> DataFrame:
    """T4 + P13: the newest ``n`` alerts, ``n`` at most NEWEST."""
    if n > NEWEST:
        raise ValueError(f"a batch keeps its newest {NEWEST}")
    return latest_alerts(partials.filter(F.col("kind") == ALERT), n, tie_breakers)
