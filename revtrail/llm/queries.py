"""One query per operator, over the whole table it is meant for."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revtrail.llm import (
    bottomk_dedup,
    compression_bands,
    edit_decontam,
    kneser_ney,
    merkle_manifest,
    paragraph_dedup,
    ppm_language,
    secret_cnn,
    shared_search,
    slack_packing,
    sql,
    suffix_dedup,
    warc_chunks,
    wordpiece,
)

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_compression_bands(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return compression_bands.quality_bands(docs, compression_bands.learned(docs, _table(spark, folder, "labels")))


def op2_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    return kneser_ney.quality(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op3_wordpiece(spark: SparkSession, folder: str) -> DataFrame:
    return wordpiece.count_tokens(_table(spark, folder, "documents"), PIECES)


def op4_slack_packing(spark: SparkSession, folder: str) -> DataFrame:
    return slack_packing.pack(_table(spark, folder, "documents"), TOKENIZER)


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.without_repeats(_table(spark, folder, "documents"))


def op6_secret_cnn(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    net = secret_cnn.train(docs)
    return docs.select("doc_id", secret_cnn.spans(F.col("text"), net).alias("_s")).select("doc_id", "_s.*")


def op7_bottomk_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return bottomk_dedup.near_duplicates(_table(spark, folder, "documents"))


def op8_edit_decontam(spark: SparkSession, folder: str) -> DataFrame:
    return edit_decontam.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op9_paragraph_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return paragraph_dedup.repeated_paragraphs(_table(spark, folder, "documents"))


def op10_ppm_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    trees = ppm_language.train(docs.where(~ppm_language.held_out()))
    found = docs.select(
        "doc_id",
        ppm_language.held_out().alias("held_out"),
        ppm_language.identify(F.col("text"), trees).alias("_p"),
    )
    return found.select("doc_id", "held_out", "_p.*")


def op11_warc_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return warc_chunks.archived(_table(spark, folder, "pages"))


def op12_shared_search(spark: SparkSession, folder: str) -> DataFrame:
    return shared_search.ranked(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle_manifest.verified(_table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_compression_bands": op1_compression_bands,
        "op2_kneser_ney": op2_kneser_ney,
        "op3_wordpiece": op3_wordpiece,
        "op4_slack_packing": op4_slack_packing,
        "op5_suffix_dedup": op5_suffix_dedup,
        "op6_secret_cnn": op6_secret_cnn,
        "op7_bottomk_dedup": op7_bottomk_dedup,
        "op8_edit_decontam": op8_edit_decontam,
        "op9_paragraph_dedup": op9_paragraph_dedup,
        "op10_ppm_language": op10_ppm_language,
        "op11_warc_chunks": op11_warc_chunks,
        "op12_shared_search": op12_shared_search,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op7_bottomk_dedup": sql.NEAR_DUPLICATES,
        "op11_warc_chunks": sql.ARCHIVED_PAGES,
        "op12_shared_search": sql.RANKED_ITEMS,
        "op13_merkle_manifest": sql.MERKLE_PROOFS,
    }
