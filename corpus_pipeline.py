"""The corpus pipeline: each stage takes all documents its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from icuqm.llm import exact_dedup, ngram_join, packing, pii, quality
from icuqm.llm.queries import KEY, vocabulary
from icuqm.session import write_stage


def good_prose(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.drop_rejected(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest ``doc_id`` stays."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles the smallest ``doc_id`` stays."""
    return ngram_join.drop_near_copies(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become surrogates; ``n_chars`` follows the new text. A deployment names its secret in ``spark.icuqm.pii.key``."""
    fresh = pii.pseudonymise(docs, spark.conf.get("spark.icuqm.pii.key", KEY)).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return fresh.select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 4096 ids."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality rules", good_prose),
    ("exact dedup", exact_copies),
    ("near copies", near_copies),
    ("personal data", personal_data),
    ("packing", packed),
]

#: Token ids, keyed surrogates and histogram distances have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_stage(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
