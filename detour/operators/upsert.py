"""Keyed upserts for node and edge tables.

Graph writes are ``MERGE`` by key followed by ``SET``: the last write wins,
including nulls, and nothing is ever deleted. On tables that is: union the current
rows that no incoming key replaces with the latest incoming row per key.
"""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from detour.operators.sizing import MAX_BROADCAST_ROWS, row_count_at_most


def latest_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the greatest by ``order`` (descending, nulls last).

    ``row_number() = 1`` becomes a partial ``WindowGroupLimit`` before the shuffle,
    so a key with a third of all rows is cut to one row per map task first.
    ``order`` must make rows unique within a key for a deterministic winner.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


class MadeRows(ABC):
    """Incoming rows that follow from smaller tables. They may be many more than these, so an upsert asks here for what it would
    else find by moving the rows. All are of one write: of a key's rows, any is the last."""

    keys: list[str]

    @abstractmethod
    def one_per_key(self) -> DataFrame:
        """The rows, one for each key."""

    @abstractmethod
    def unmatched(self, existing: DataFrame) -> DataFrame:
        """The rows of ``existing`` whose key none of the rows has; null keys are keys."""


def upsert(existing: DataFrame | None, incoming: DataFrame | MadeRows, keys: list[str], seq: list[str],
           mode: str = "upsert", max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Apply ``incoming`` (ordered by ``seq``) on top of ``existing`` (one row per key).

    mode ``upsert``: keys absent from ``incoming`` keep their row (D11).
    mode ``replace``: the result holds only keys present in ``incoming``.
    Output columns: those of ``incoming`` minus ``seq``, plus ``is_updated``.

    The incoming rows are cut to the last write per key; the current rows stay where no
    incoming key replaces them (an anti join, null keys included). Up to ``max_broadcast_rows``
    incoming rows their keys are broadcast, so that the current table isn't shuffled. Of :class:`MadeRows` nothing is shuffled.
    """
    if isinstance(incoming, MadeRows):
        if list(incoming.keys) != keys:
            raise ValueError(f"the rows' keys are {incoming.keys}")
        new = incoming.one_per_key()
        payload, new = new.columns, new.withColumn("is_updated", F.lit(True))
        if existing is None or mode == "replace":
            return new
        return incoming.unmatched(existing.select(*payload)).withColumn("is_updated", F.lit(False)).unionByName(new)
    payload = [c for c in incoming.columns if c not in seq]
    new = latest_per_key(incoming, keys, seq).select(*payload, F.lit(True).alias("is_updated"))
    if existing is None or mode == "replace":
        return new
    written = incoming.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    if row_count_at_most(incoming, max_broadcast_rows):
        written = F.broadcast(written)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    kept = existing.select(*payload).join(written, same, "left_anti")
    return kept.withColumn("is_updated", F.lit(False)).unionByName(new)


def distinct_edges(edges: DataFrame, keys: list[str]) -> DataFrame:
    """K4 for property-less edges: MERGE makes each pair exist once."""
    return edges.select(*keys).dropDuplicates(keys)
