"""Connected components by alternating large and small stars, in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from detour.llm import common


TASK_EDGES = 50_000  # as many edges as a task may well hold: fewer aren't dealt among tasks


def _both(edges: DataFrame, first: tuple[str, str], second: tuple[str, str]) -> DataFrame:
    """(u, v): two edges for each row; unlike a union in as many partitions as ``edges``."""
    pair = lambda p: F.struct(F.col(p[0]).alias("u"), F.col(p[1]).alias("v"))
    return edges.select(F.explode(F.array(pair(first), pair(second))).alias("e")).select("e.u", "e.v")


def _with_least(edges: DataFrame, nodes: int) -> DataFrame:
    """(u, v, m): every directed edge with the least of u and its neighbours; ``nodes`` bounds the nodes."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
    if nodes * 32 <= common.MAX_BROADCAST_BYTES:
        least = F.broadcast(least)
    return edges.join(least, F.col("u") == F.col("n")).select("u", "v", "m")


def _large_star(edges: DataFrame, nodes: int) -> DataFrame:
    return _with_least(_both(edges, ("u", "v"), ("v", "u")), nodes).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame, nodes: int) -> DataFrame:
    """Edges point from the larger to the smaller end (u > v)."""
    down = _with_least(edges, nodes)
    return _both(down, ("v", "m"), ("u", "m")).where("u <> v").distinct()


def components(edges: DataFrame, path: str) -> DataFrame:
    """(node, component): the least node of its component, for every node of an edge (u, v).

    The minima are map-side sums and are broadcast while their counted bound allows; else the joins
    are split by AQE where a node has many edges. Each round is written below ``path``, and
    rounds follow the logarithm of a component's size. The end is seen by count and checksum of the edges. Edges are dealt among
    as many tasks as their count takes: up to TASK_EDGES of them need no shuffle.
    """
    now = common.written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{path}/0")
    seen, step = None, 0
    while True:
        mark = now.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        now = now.coalesce(1 + mark[0] // TASK_EDGES)
        if mark[0] == 0 or mark == seen:
            return _both(now, ("u", "v"), ("v", "v")).select(F.col("u").alias("node"), F.col("v").alias("component")).distinct()
        seen, step = mark, step + 1
        now = common.written(_small_star(_large_star(now, 2 * mark[0]), 2 * mark[0]), f"{path}/{step}")
