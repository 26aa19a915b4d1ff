"""The registered query of each operator, with its production parameters, and the DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantline.llm import alignment, html, leaks, licenses, mixing, neardup, prefix_trie, quality, secrets, sharding, token_files, topk, toxicity
from plantline.llm.oracles import ORACLES  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents", "doc_id", "text")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed_documents(table(spark, folder, "documents", "doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    return token_files.tokenized(docs, public_tokenizers.path("word_bpe_49k.json"))


def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.find_secrets(table(spark, folder, "documents", "doc_id", "text"))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text", "lang")
    labels = table(spark, folder, "labels", "doc_id", "quality", "toxic")
    return quality.classify(docs, labels, units=quality.CODE_POINTS).drop("text")


def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents", "doc_id", "text"), shingle=2).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


def op7_leaks(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    return leaks.leaks(docs, table(spark, folder, "benchmark", "item_id", "text")).select("doc_id", "item_id", "containment")


def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents", "doc_id", "text")).select("doc_id", "license", "containment")


def op9_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 100 == 0)


def op10_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages", "page_id", "url", "html"))


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    return toxicity.score_toxicity(docs, table(spark, folder, "labels", "doc_id", "toxic"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    tree = prefix_trie.prefix_tree(table(spark, folder, "conversations", "conv_id", "turn", "role", "text"))
    return tree.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    return alignment.align_tokenizers(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_sharding, op2_mixing, op3_token_files, op4_secrets, op5_quality, op6_near_duplicates, op7_leaks, op8_licenses,
        op9_top_k, op10_main_text, op11_toxicity, op12_prefix_trie, op13_alignment,
    )
}
