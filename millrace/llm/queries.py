"""The registered queries of the text operators: thin readers of the driver tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import (
    bpe, centroids, decontaminate, minhash, neighbours, oracles, pii, prefixes, quality, secret_scan, sharding, suffixes,
    toxicity, urls)
from millrace.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets_digest(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def tokenizer() -> bpe.Vocabulary:
    return bpe.read_vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"), tokenizer())


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_size(table(spark, sf_dir, "documents"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        op1_quality_rules, op2_url_filters, op3_secret_scans, op4_decontamination, op5_byte_bpe, op6_suffix_dedup,
        op7_pii, op8_toxicity, op9_sharding, op10_minhash, op11_prefix_trie, op12_neighbours,
        op13_centroids)
}
#: The others fit models, sample or digest spans, which SQL cannot; tests hold them against plain versions.
ORACLES: dict[str, str] = {
    "op4_decontamination": oracles.OP4, "op6_suffix_dedup": oracles.OP6, "op10_minhash": oracles.OP10,
    "op11_prefix_trie": oracles.OP11, "op13_centroids": oracles.OP13,
}
