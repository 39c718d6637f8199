"""Training corpus from raw documents: quality, language, one of each group of near copies, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickledger.llm import langid, quality
from clickledger.llm.common import stage, table
from clickledger.llm.neardup import near_duplicates
from clickledger.llm.packing import pack

#: Least quality score, and least share of a text's words in its language, of documents that stay.
LEAST_QUALITY, LEAST_SHARE = 0.3, 0.4


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine, fitted on the labels, does not reject."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("target"))
    metadata = [quality.size_class("n_chars")]
    return quality.keep_good(docs, quality.train(docs, labels, metadata), LEAST_QUALITY, metadata)


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the random field, fitted on their lang column, can tell."""
    return langid.keep_identified(docs, langid.train(docs), LEAST_SHARE)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each group of near copies by five-word shingles."""
    copies = near_duplicates(docs, width=5, percent=80).filter("NOT kept").select("doc_id")
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in sequences of at most 4096."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=4096)


STAGES = [("quality", good), ("language", identified), ("near_duplicates", distinct), ("packing", packed)]

#: The stages learn models and tokenise, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
