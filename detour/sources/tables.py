"""Parquet tables of the analytics warehouse (the driver's test tables in tests)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """``<base>/<name>.parquet`` as a DataFrame; Catalyst prunes columns and pushes
    filters into the scan. The files are listed anew on every call, so rows appended
    since the last one are read."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def stream_table(spark: SparkSession, base: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same table as a file stream. The glob form is needed because a file
    stream source requires a directory-like path; it matches exactly one file."""
    schema = load_table(spark, base, name).schema
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(f"{base.rstrip('/')}/{name}.parque[t]")
