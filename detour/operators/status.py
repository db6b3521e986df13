"""Line-status documents -> one status event per line and poll (S3 -> A12 -> events).

P6 drop lines without statuses, A12 worst status, F1/F2 defaults and nested access,
P10 constant event type, P11 disruption predicate, P15/A7 per-poll counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from detour.fixed import STATUS_EVENT_TYPE, UNKNOWN_LINE_ID, UNKNOWN_LINE_NAME, UNKNOWN_SEVERITY_DESC
from detour.params import DEFAULT, Params
from detour.sources.documents import parsed


def is_disrupted(severity: Column, p: Params = DEFAULT) -> Column:
    """Strictly below the threshold."""
    return severity < F.lit(p.severity_threshold)


def _event_columns(line_id: Column, line_name: Column, sev: Column, desc: Column,
                   detail: Column, ingested_at: Column, p: Params) -> list[Column]:
    sev = F.coalesce(sev, F.lit(p.missing_severity_report)).cast("int")
    return [
        F.lit(STATUS_EVENT_TYPE).alias("event_type"),
        line_id.alias("line_id"),
        line_name.alias("line_name"),
        sev.alias("severity_code"),
        F.coalesce(desc, F.lit(UNKNOWN_SEVERITY_DESC)).alias("severity_desc"),
        is_disrupted(sev, p).alias("is_disrupted"),
        detail.alias("disruption_detail"),
        ingested_at.alias("ingested_at_utc"),
    ]


def events_from_documents(raw_lines: DataFrame, ingested_at: Column, p: Params = DEFAULT,
                          keep: list[str] | None = None) -> DataFrame:
    """Raw line records (id, name, lineStatuses[]) -> status events.

    The worst status is an arg-min inside the row: ``array_min`` over
    (rank, position, status) where a missing severity ranks as 99 and ties go to
    the earlier list entry. No shuffle: each document already holds its list.
    """
    statuses = F.coalesce(F.col("lineStatuses"), F.array())
    worst = F.array_min(F.transform(F.col("lineStatuses"), lambda s, i: F.struct(
        F.coalesce(s["statusSeverity"], F.lit(p.missing_severity_rank)).alias("rank"),
        i.alias("pos"),
        s.alias("status"),
    )))["status"]
    return (parsed(raw_lines)
            .filter(F.size(statuses) > 0)                                   # P6
            .select(*(keep or []), *_event_columns(
                F.coalesce(F.col("id"), F.lit(UNKNOWN_LINE_ID)),
                F.coalesce(F.col("name"), F.lit(UNKNOWN_LINE_NAME)),
                worst["statusSeverity"],
                worst["statusSeverityDescription"],
                worst["disruption"]["description"],                       # F2, null-safe
                ingested_at, p)))


def worst_status_rows(statuses: DataFrame, keys: list[str], order_col: str,
                      severity: str, desc: str, detail: str, p: Params = DEFAULT) -> DataFrame:
    """Set form of A12 for statuses stored one per row.

    Returns keys, ``worst_pos`` (the ``order_col`` of the chosen status),
    ``severity`` (raw, may be null), ``severity_desc``, ``disruption_detail``,
    ``n_statuses``. ``min`` over a struct aggregates partially before the shuffle,
    so a poll with very many statuses never travels as one group.
    """
    w = F.min(F.struct(
        F.coalesce(F.col(severity), F.lit(p.missing_severity_rank)).alias("rank"),
        F.col(order_col).alias("pos"),
        F.col(severity).alias("sev"),
        F.col(desc).alias("desc"),
        F.col(detail).alias("detail"),
    )).alias("w")
    return (statuses.groupBy(*keys)
            .agg(w, F.count(F.lit(1)).alias("n_statuses"))
            .select(*keys,
                    F.col("w.pos").alias("worst_pos"),
                    F.col("w.sev").alias("severity"),
                    F.col("w.desc").alias("severity_desc"),
                    F.col("w.detail").alias("disruption_detail"),
                    "n_statuses"))


def events_from_worst(worst: DataFrame, line_id: Column, line_name: Column, ingested_at: Column,
                      p: Params = DEFAULT, keep: list[str] | None = None) -> DataFrame:
    """Status events from the output of :func:`worst_status_rows`."""
    keep = keep or []
    return worst.select(*keep, *_event_columns(
        line_id, line_name, F.col("severity"), F.col("severity_desc"),
        F.col("disruption_detail"), ingested_at, p))


def split_by_disruption(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ok, disrupted). A null flag belongs to neither."""
    return events.filter(~F.col("is_disrupted")), events.filter(F.col("is_disrupted"))


def poll_counts(events: DataFrame, poll_col: str = "ingested_at_utc") -> DataFrame:
    """Lines OK / disrupted per poll (partial aggregation, one row per poll)."""
    return events.groupBy(poll_col).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(~F.col("is_disrupted")).alias("n_ok"),
        F.count_if(F.col("is_disrupted")).alias("n_disrupted"),
    )
