"""The alert history table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from detour.streaming.compaction import read_compacted


def read_history(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Partitioned by (run_id, batch_id); filters on them prune partitions. Compacted batches
    (:mod:`detour.streaming.compaction`) are read from their segments, each batch once.

    Partition values come back with inferred types (a batch id as int, a numeric-looking
    run id as a number); they are cast back to the contract: run_id string, batch_id long.
    """
    if fmt == "parquet":
        return read_compacted(spark, path)
    df = spark.read.format(fmt).load(path)
    return df.withColumns({"run_id": F.col("run_id").cast("string"),
                           "batch_id": F.col("batch_id").cast("long")})
