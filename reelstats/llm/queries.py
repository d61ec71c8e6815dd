"""Registered queries of the operators: QUERIES[name](spark, sf_dir), and SQL where it can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelstats.llm import (
    arrowfile, exact, imatch, licenses, near, packing, pieces, pii, quality, repair, simhash, substring, whitening,
)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(documents(spark, sf_dir))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_join(documents(spark, sf_dir))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_and_decode(documents(spark, sf_dir))


def op3_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(documents(spark, sf_dir))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.label_documents(documents(spark, sf_dir))


def op6_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.label_documents(documents(spark, sf_dir))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality.score_documents(documents(spark, sf_dir), labels).drop("tie")


def op9_arrow_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrowfile.read_documents(arrowfile.write_sequences(documents(spark, sf_dir)))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(documents(spark, sf_dir), with_text=False)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_damaged(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))


LLM_QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_imatch": op3_imatch,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_hilbert_packing": op6_hilbert_packing,
    "op7_pii": op7_pii,
    "op8_quality": op8_quality,
    "op9_arrow_sequences": op9_arrow_sequences,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_simhash": op12_simhash,
    "op13_whitening": op13_whitening,
}

LLM_SQL = {
    "op1_ngram_jaccard_join": near.SQL_NEAR,
    "op4_exact_dedup": exact.SQL_EXACT,
    "op5_license_scan": licenses.sql(),
    "op10_substring_dedup": substring.SQL_SUBSTRING,
    "op11_conversation_repair": repair.sql(),
}
