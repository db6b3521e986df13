"""Exact dedup as a stream: disk-backed keyed state without expiry, bytes checked on hits.

Documents arrive at a stateful streaming aggregation keyed by the digest of the text. Its state, in
RocksDB, keeps for each digest how many arrived and the row that stays: its identifier
and its content locator (file and row number). Nothing expires; a later run from the same
checkpoint goes on where the last ended. The state is read back as a table. Wherever a digest was hit more than
once, the full texts are compared with the text at the locator; texts that differ under one
digest are grouped anew by their bytes.

Copies of one text meet as one partial count a task, a large group's rows are dealt over
salted copies of its kept text for the comparison, and the joins are left to AQE's skew
handling, so no group is gathered anywhere.

Of equal texts the row with the largest identifier stays (null lowest; of rows that share it, the one with
the greatest locator). A null text counts as empty, which is a text like others; an empty
table gives no rows; other columns, whatever their names, are not touched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from detour.llm import common

BATCH_BYTES = 1 << 30  # of arrivals (about 80 bytes each) in a micro-batch
SALT_ROWS = 1000    # rows of a group that are compared with one copy of its kept text

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STORE = {PROVIDER: ROCKSDB, "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
         "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",  # of an executor, for all its stores
         # no preallocated log files: a store for each partition would hold megabytes of them
         "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def fold(spark: SparkSession, arrivals: str, checkpoint: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Stream the rows (digest, id_, at_) below ``arrivals`` that ``checkpoint`` has not
    seen into its state; return the state: (digest, group_size, kept: id_ and at_)."""
    schema = spark.read.parquet(arrivals).schema
    before = {k: spark.conf.get(k, None) for k in STORE}
    for k, v in STORE.items():
        spark.conf.set(k, v)
    try:
        (spark.readStream.schema(schema).option("maxBytesPerTrigger", str(batch_bytes)).parquet(arrivals)
         .groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("id_", "at_")).alias("kept"))
         .writeStream.format("noop").outputMode("update").trigger(availableNow=True)
         .option("checkpointLocation", checkpoint).start().awaitTermination())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    state = spark.read.format("statestore").load(checkpoint)
    size, kept = state.schema["value"].dataType.fieldNames()
    return state.select(F.col("key.digest").alias("digest"), F.col(f"value.`{size}`").alias("group_size"),
                        F.col(f"value.`{kept}`").alias("kept"))


def differing(texts: DataFrame, groups: DataFrame) -> DataFrame:
    """The digests of (digest, text_, at_) under which a text differs from the one kept in ``groups``."""
    salts = F.ceil(F.col("group_size") / F.lit(SALT_ROWS)).cast("int")
    hits = texts.join(groups.select("digest", salts.alias("salts"), F.col("kept.at_").alias("kept_at")), "digest")
    kept = (hits.where(F.col("at_") == F.col("kept_at"))
            .select("digest", F.col("text_").alias("kept_text"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")))
    dealt = hits.withColumn("salt", F.pmod(F.hash("at_"), F.col("salts")))
    return dealt.join(kept, ["digest", "salt"]).where(F.col("text_") != F.col("kept_text")).select("digest").distinct()


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256,
          batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(key, keep_id, group_size, kept, text_sha256, at_) of every row of ``docs``, which must
    come straight from files; ``at_`` is the row's locator."""
    spark, path = docs.sparkSession, common.scratch(docs.sparkSession, "dedup")
    found = common.located(docs, [key, text]).select(F.col(key).alias("id_"), common.text_or_empty(text).alias("text_"), "at_")
    keyed = found.withColumn("digest", digest(F.col("text_")))
    arrived = common.written(keyed.select("id_", "at_", "digest", sha256(F.col("text_")).alias("sha")), f"{path}/arrivals")
    groups = common.written(fold(spark, f"{path}/arrivals", f"{path}/state", batch_bytes), f"{path}/groups")

    hit = groups.where("group_size > 1")
    hit_texts = keyed.join(common.broadcast_if_small(hit.select("digest"), 100), "digest", "left_semi")
    hit_texts = common.written(hit_texts, f"{path}/hits")
    other = common.written(differing(hit_texts, hit), f"{path}/differing")
    named = F.struct("id_", "at_")
    joined = arrived.join(groups, "digest").withColumn("whole", F.lit(True))
    if not other.isEmpty():  # texts that share a digest: these groups are told apart by their bytes
        apart = hit_texts.join(other, "digest", "left_semi")
        exact = apart.groupBy("digest", "text_").agg(F.count(F.lit(1)).alias("group_size"), F.max(named).alias("kept"))
        joined = joined.join(other, "digest", "left_anti").unionByName(
            apart.join(exact, ["digest", "text_"])
            .select("digest", "id_", "at_", sha256(F.col("text_")).alias("sha"), "group_size", "kept").withColumn("whole", F.lit(False)))
    return joined.select(F.col("id_").alias(key), F.col("kept.id_").alias("keep_id"), "group_size",
                         (F.col("at_") == F.col("kept.at_")).alias("kept"), F.col("sha").alias("text_sha256"), "at_")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all their columns) that stay."""
    return common.without(docs, dedup(docs).where(~F.col("kept")))
