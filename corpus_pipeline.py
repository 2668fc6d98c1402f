"""Raw documents to packed training sequences, stage by stage.

Every stage takes the documents that its predecessor kept, with all their columns, and
all but the last return documents again. Null texts fail the quality rules and go there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revtrail.llm import bottomk_dedup, compression_bands, edit_decontam, queries, secret_cnn, slack_packing


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands of the trusted documents."""
    bands = compression_bands.learned(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(compression_bands.quality(F.col("text"), bands)["kept"])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return bottomk_dedup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return edit_decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced and their length as it is then."""
    plain = docs.withColumn("text", secret_cnn.redacted(F.col("text"), secret_cnn.train(docs)))
    if "n_chars" in docs.columns:
        plain = plain.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return plain


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place."""
    return slack_packing.pack(docs, queries.TOKENIZER)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

# Compression, training and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
