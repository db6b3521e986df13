"""The registered queries of this subpackage: every operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from detour.llm import alignment, common, completion, dedup, huffman, labelled, merkle, packing, perspectives, probminhash, quality, sharding, toxicity, urlmodel, winnowing
from detour.llm.oracle import ORACLE_SQL

URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/"))


def op1_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), literals=True)


def op2_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = common.load(spark, sf_dir, "documents"), labelled.remainder(F.col("doc_id"), 5) == 0
    scores = quality.fit(docs, common.load(spark, sf_dir, "labels"), ~held)(docs)
    return scores.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(common.load(spark, sf_dir, "documents"), 8)


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.contamination(common.load(spark, sf_dir, "documents"), common.load(spark, sf_dir, "benchmark"))


def op5_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup(common.load(spark, sf_dir, "documents")).drop("at_")


def op6_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.rotate(common.load(spark, sf_dir, "conversations"))


def op7_huffman_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = huffman.write_tokens(common.load(spark, sf_dir, "documents"), common.scratch(spark, "tokens"),
                                public_tokenizers.path("word_bpe_49k.json"), drop_space=True, literals=True)
    return huffman.read_tokens(spark, path, digests=True)


def op8_url_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlmodel.judge(common.load(spark, sf_dir, "pages"), URL_RULES)


def op9_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = common.load(spark, sf_dir, "documents").select("doc_id", "text"), labelled.remainder(F.col("doc_id"), 4) == 2
    scores = toxicity.fit(docs, common.load(spark, sf_dir, "labels"), ~held)(docs)
    return scores.select("doc_id", held.alias("held_out"), F.col("score_").alias("score"),
                         (F.col("score_") >= 0.3).cast("int").alias("predicted"))


def op10_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.classes(common.load(spark, sf_dir, "documents")).select("doc_id", "class_id", "representative", "class_size", "kept")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(common.load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return completion.pack(common.load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def manifest_rows(docs: DataFrame, **options) -> DataFrame:
    """The manifest of documents, and what each row's proof says of its text without line feeds, for the ids chosen by crc32."""
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(struck, F.translate("text", "\n", "")).otherwise(F.col("text"))
    found = merkle.manifest(docs, other=[F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text], **options)
    return found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest().alias("proof_sha256"), F.col("other_root").alias("folded_root"),
                        (F.col("other_root") == F.col("root")).alias("verified"))


def op13_butterfly_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_rows(common.load(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it stands at the repository's top and imports this subpackage
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_bm25_packing, op2_factorisation_machine, op3_jump_sharding, op4_winnowing, op5_stream_dedup, op6_perspective_rotation,
    op7_huffman_tokens, op8_url_markov, op9_boosted_toxicity, op10_probminhash,
    op11_token_alignment, op12_bin_completion, op13_butterfly_manifest, pipeline)}
__all__ = ["ORACLE_SQL", "QUERIES"]
