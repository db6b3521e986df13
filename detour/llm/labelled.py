"""The bounded, reproducible sample of labelled rows that the classifiers learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; a null key counts as empty text."""
    return (F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus).cast("int")


def sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int, key: str = "doc_id") -> DataFrame:
    """(text columns of ``docs``, label_, part_): at most ``rows`` labelled rows for which ``learn``
    holds, those of least hash; ``part_`` is 0 to 99 by another hash. Rows without a label or key are left out; of
    rows that share a key, the one with the greatest hash of its columns is taken."""
    chosen = (labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & learn)
              .groupBy(F.col(key).alias("key_")).agg(F.max(label).cast("int").alias("label_"))
              .withColumn("order_", F.xxhash64("key_")).orderBy("order_", "key_").limit(rows)
              .select("key_", "label_", F.pmod(F.xxhash64(F.lit("part"), "key_"), F.lit(100)).cast("int").alias("part_")))
    found = docs.join(F.broadcast(chosen), F.col(key) == F.col("key_"))  # at most ``rows`` rows are broadcast
    row = F.struct(*[F.col(c) for c in docs.columns])
    one = found.groupBy("key_", "label_", "part_").agg(F.max_by(row, F.xxhash64(*[F.col(c) for c in docs.columns])).alias("row_"))
    return one.select("row_.*", "label_", "part_")
