"""Documents to packed training sequences: stage after stage, each written and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, langid, neardup, packing, pii
from tidemark.llm.base import prepared, table, written


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go. The model learns from the documents it gets."""
    prepared(spark)
    return langid.keep_identified(docs, langid.train(docs))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (similarity 0.8 or more) stays, the one with the smallest id."""
    prepared(spark)
    return neardup.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    prepared(spark)
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced in the texts; no document goes."""
    prepared(spark)
    return pii.redact(docs, length="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document with its place in a sequence of 4096 tokens."""
    prepared(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), "word", end_id=1)[1]


STAGES = [
    ("language_id", identify),
    ("minhash_near_dedup", deduplicate),
    ("benchmark_decontamination", decontaminated),
    ("pii", redact),
    ("best_fit_packing", pack),
]
# Tokenizers and trained models have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
