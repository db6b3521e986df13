"""Version tables: which files make up a table now.

A version is one row of an append-only Parquet folder; rows never change, and a new one is seen when its
write job commits. So a reader gets one version or the next, never a half of each. One writer at a time: two rows
with one number mean that two have raced, which is an error, not a guess.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")  # no folder, or nothing in it yet


def versions(spark: SparkSession, path: str, columns: str) -> DataFrame | None:
    """All versions (version, written_at, ``columns``); None if there are none."""
    try:
        return spark.read.schema(f"version long, written_at timestamp, {columns}").parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ABSENT:
            raise
        return None


def newest(spark: SparkSession, path: str, columns: str) -> Row | None:
    """The row of the newest version."""
    table = versions(spark, path, columns)
    rows = table.orderBy(F.col("version").desc()).limit(2).collect() if table is not None else []
    if len(rows) == 2 and rows[0]["version"] == rows[1]["version"]:
        raise RuntimeError(f"two writers made version {rows[0]['version']} of {path}")
    return rows[0] if rows else None


def append(spark: SparkSession, path: str, columns: str, values: tuple, after: Row | None) -> None:
    """Make ``values`` the version that follows ``after``."""
    number = after["version"] + 1 if after else 1
    (spark.createDataFrame([values], columns)
          .select(F.lit(number).cast("long").alias("version"), F.current_timestamp().alias("written_at"), "*")
          .coalesce(1).write.mode("append").parquet(path))
