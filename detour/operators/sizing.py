"""Broadcast only what is proven small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 100_000


def broadcast_if_bounded(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when ``df`` has at most ``max_rows`` rows, else leave the
    choice to the planner (shuffle join). Use on materialised inputs (a written
    snapshot), where the bounded count reads little; ``limit`` stops it early."""
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; reads at most ``max_rows + 1``."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_while_few(df: DataFrame, of: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast of ``df``, which has a short row for each row of ``of`` at most, while those are few. The count
    runs on ``of`` (a dimension table), not on the plan of ``df``."""
    return F.broadcast(df) if row_count_at_most(of, max_rows) else df
