"""The fixed list of line ids the network is built from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from detour.fixed import TUBE_LINES


def line_vocabulary(spark: SparkSession, ids: list[str] | None = None) -> DataFrame:
    """(position, line_id) rows; eleven literals, so broadcasting it is always safe."""
    ids = TUBE_LINES if ids is None else ids
    return F.broadcast(spark.createDataFrame(list(enumerate(ids)), "position int, line_id string"))
