"""From documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame, which is written as
Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``docs`` as they were, whatever else these are called.

A null text is an empty one, which has no language and goes in the first stage. Very long texts
are rows like others. Repeated rows are judged alike; near-dedup leaves one of them. Ties go by the
smaller id. From an empty table every stage makes an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from joinwright.llm import language, mixing, packing, simhash, toxicity
from joinwright.llm.common import in_small_batches, staged

#: No SQL: Viterbi, regression, fingerprints and the genetic algorithm are not expressible.
ORACLE_SQL = None

#: Tokens that mixing is to draw, as a share of those that come in.
MIXED = 0.5


def in_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, and those of which no language holds two fifths."""
    in_small_batches(spark)
    return language.in_a_language(docs, language.learn(docs))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the severity model calls toxic; it learns from ``labels``."""
    in_small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.not_toxic(docs, toxicity.learn(docs, labels))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest id of each group of near copies: texts whose
    fingerprints of three-word shingles differ in three bits at most."""
    in_small_batches(spark)
    return simhash.first_of_groups(docs, size=3)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw documents so that sources, languages and topics come to their target shares.

    MIXED of the tokens are expected to come out; documents of rare categories may be repeated.
    """
    return mixing.sampled(docs, share=MIXED)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 2048 ids."""
    in_small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


STAGES = [
    ("language ID", in_known_languages),
    ("toxicity", without_toxic),
    ("near-dedup", without_near_copies),
    ("mixing to target weights", mixed),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = staged(docs)
    return docs
