"""Stages from raw documents to packed sequences. Each is written as Parquet and read as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import jaccard_join, packing, secret_scan, toxicity
from millrace.llm.common import read, written
from millrace.llm.tokenizing import tokenizer_path


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, and all that are in none."""
    return jaccard_join.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found secrets replaced by a mask."""
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 ids."""
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), end_id=1, capacity=2048)


STAGES = [("toxicity", toxic), ("ngram_jaccard_join", near_copies), ("secrets", secrets), ("packing", packed)]

#: No SQL runs a tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
