"""The registered queries of the training-data operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiwatch.llm import chat, decontam, forest, licenses, lm, neardup, pieces, pii, resample, sharding, topk, toxicity, whitening
from kpiwatch.llm.common import read_table


def op1_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = chat.calls_of(read_table(spark, sf_dir, "conversations"))
    return chat.link(calls, results, chat.REPLY)


def op2_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op3_uniform_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.search(read_table(spark, sf_dir, "embeddings"))
    return found.withColumn("score", F.col("score").try_cast("long"))


def op4_log_bilinear_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(read_table(spark, sf_dir, "documents"))


def op5_vector_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(read_table(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op8_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.encode(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "sample", F.size("ids").cast("long").alias("n_pieces"), "log_prob", "inclusion", "ids_crc32", "round_trip")


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whitened(read_table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resampled(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.search(read_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_tool_call_linking, op2_contextual_pii, op3_uniform_threshold_topk, op4_log_bilinear_lm, op5_vector_bin_packing,
        op6_benchmark_decontamination, op7_license_scan, op8_sentencepiece_sampling, op9_minhash_near_dedup, op10_toxicity,
        op11_embedding_whitening, op12_importance_resampling, op13_projection_forest,
    )
    return {f.__name__: f for f in every}
