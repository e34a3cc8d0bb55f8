"""The corpus pipeline: quality rules, near-duplicates, benchmark passages, secrets, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from actlens.llm import bpe, decontamination, near_dedup, quality_rules, secret_scan
from actlens.llm.common import Scratch, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality policy keeps."""
    return quality_rules.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8 or more."""
    return near_dedup.deduplicate(docs, shingle=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark passage is found."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets taken out of the texts."""
    return secret_scan.redact_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and token_ids of every document."""
    return bpe.encode_documents(docs)


STAGES = [("quality_rules", quality), ("near_dedup", near_duplicates), ("benchmark_decontamination", benchmark), ("secret_scan", secrets), ("bpe", encode)]
#: Neither the retrieval nor the encoding can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again before the next; a table that is no longer read is deleted."""
    scratch = Scratch(spark, "pipeline")
    docs, written = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        docs, before = scratch.put(stage(spark, docs, sf_dir)), written
        if before is not None:
            scratch.drop(before)
        written = docs
    return docs
