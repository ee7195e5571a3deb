"""Corpus pipeline: quality rules, near-duplicates, benchmark decontamination, secrets, pieces.

Each stage reads what the one before it kept, written as Parquet. All but the last return the columns of
``documents``; the last returns the ids of each text's pieces.

Defined cases: an empty table passes every stage empty. Rows with a null or empty text fail the quality rules. Rows
without an id are kept as rows of their own by the near-duplicate stage and go by their own text in the others. Of repeated rows one
stays; of several texts under one id each is judged by itself. Other columns, of whatever name, are carried to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelloom.llm import decontaminate, minhash, pieces, quality, secret_scan
from panelloom.llm.common import files_for, materialize, read


def in_few_files(out: DataFrame, docs: DataFrame) -> DataFrame:
    """``out`` in a file for some 16,000 documents of the stage's input, instead of one for each shuffle partition."""
    return out.coalesce(files_for(docs.sparkSession, docs.count(), 16_000))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return in_few_files(quality.keep_good(docs), docs)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return in_few_files(minhash.keep_one(docs), docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return in_few_files(decontaminate.remove_leaks(docs, read(spark, sf_dir, "benchmark")), docs)


def secrets_redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return in_few_files(secret_scan.redact(docs), docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return in_few_files(pieces.encode(docs, portion=1_000_000), docs)


STAGES = [
    ("quality_rules", good_quality),
    ("near_duplicates", one_of_each_class),
    ("decontamination", without_benchmark),
    ("secret_scan", secrets_redacted),
    ("sentencepiece", encoded),
]

#: SQL expresses neither the signatures nor the merges; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
