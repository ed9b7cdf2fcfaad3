"""Corpus pipeline: toxic documents go, then exact copies, then near copies; personal data is masked; the rest is packed.

Every stage reads all that the stage before it kept.  The first four return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from metrivane.llm import exact_dedup, jaccard_join, packing, pii, toxicity
from metrivane.llm.common import stored, table


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; fitted on the labels of ``sf_dir`` that are not held out."""
    return toxicity.harmless(docs, table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: that with the largest doc_id."""
    return exact_dedup.deduplicate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (five words, 0.8): that with the smallest doc_id."""
    return jaccard_join.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every span of personal data replaced by the name of its kind."""
    return pii.mask(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 1024 tokens."""
    from public_tokenizers import path

    return packing.pack_documents(docs, path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("toxicity", harmless),
    ("exact dedup", exact_duplicates),
    ("ngram jaccard", near_duplicates),
    ("pii", personal_data),
    ("packing", packed),
]
ORACLE_SQL = None  # a fitted model and a tokenizer are beyond SQL; tests/llm compares with plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
