"""A training corpus from raw documents: five stages, each written as Parquet and read again.

Every stage but the last returns the columns it got, whatever they are; only text, doc_id, lang and
source are read, and n_chars is counted anew where texts change. Defined results: documents with null
or empty texts, or without letters, go at the first stage, which keeps all others that are written
like a labelled language; of rows that are alike, with one id or none, one stays at the second; a
null source is a source of its own in the mixture; rows that share an id, or have none, are packed
each. No documents make no sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkvigil.llm import langid, mixing, packing, secrets, simhash
from sparkvigil.llm.queries import VOCABULARY
from sparkvigil.session import stage

# The stages are tested against brute force: SQL has neither the tokeniser nor the language model.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; others go."""
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    return simhash.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked."""
    return secrets.mask_secrets(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words of each source that the mix takes, as whole copies and parts of documents."""
    return mixing.mixed_texts(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of the mixed documents in sequences."""
    return packing.pack_documents(docs, VOCABULARY)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("mixture", mixture),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
