"""The corpus pipeline: documents to packed training sequences, one operator a stage.

Each stage takes (spark, docs, sf_dir) and reads all that its predecessor kept; its result is
written as Parquet and read again. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from detour.llm import common, dedup, labelled, packing, probminhash, toxicity, winnowing

TOXIC_FROM = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic go; the classifier learns as in its own query, not from the held-out labels."""
    learn = labelled.remainder(F.col("doc_id"), 4) != 2
    return toxicity.clean(docs, docs, common.load(spark, sf_dir, "labels"), learn, TOXIC_FROM)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return probminhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a passage of the benchmark go."""
    return winnowing.decontaminate(docs, common.load(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), literals=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

ORACLE_SQL = None  # a fitted classifier and tokenized sequences aren't SQL: tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.load(spark, sf_dir, "documents")
    path = common.scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
