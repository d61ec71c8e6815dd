"""Corpus pipeline: quality, exact copies, near copies, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstats.llm import exact, near, packing, pii, quality
from reelstats.session import materialize


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def stage_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal up to white space, the smallest doc_id stays."""
    return exact.keep_first(docs)


def stage_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the smallest doc_id stays."""
    return near.keep_one(docs)


def stage_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to the kind in brackets; n_chars follows the text."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality", stage_quality),
    ("exact_dedup", stage_exact),
    ("near_dedup", stage_near),
    ("pii", stage_pii),
    ("packing", stage_packing),
]

# Tokenizers and model fits cannot be stated in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
