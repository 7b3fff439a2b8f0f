"""From raw documents to token ids: language, near duplicates, benchmark passages, personal data, encoding.

Each stage applies one operator of ``sluice.llm`` to all rows that its predecessor kept. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sluice.llm import bpe, decontaminate, language_id, near_dup, pii
from sluice.session import new_folder

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents in no language that the model has learned: those without a letter, and those no landmark supports."""
    return language_id.in_known_language(spark, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest doc_id."""
    return near_dup.one_of_each_group(docs, shingle_words=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a passage of the benchmark."""
    return decontaminate.clean_documents(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With marks in place of personal data; ``n_chars`` stays that of the source."""
    return pii.masked(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, their number, and digests of the ids and of what they decode to."""
    return bpe.encoded(spark, docs, RANKS, public_tokenizers.PATTERN)


STAGES = [("language_id", known_language), ("simhash_near_dedup", near_dedup), ("decontamination", decontamination),
          ("pii", personal_data), ("byte_bpe", token_ids)]

#: Learning a classifier, scoring a graph and merging byte pairs are not for SQL; tests hold the stages against plain
#: Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        folder = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
