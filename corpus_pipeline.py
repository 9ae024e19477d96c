"""A corpus, stage by stage, from ``documents`` to token ids.

Each stage is one operator of ``meterlake.llm`` over all rows that the one before kept; what it writes is what
the next one reads.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from meterlake.llm import bpe, exact_dedup, minhash, mixing, quality
from meterlake.llm.common import stored, table

#: Near copies of the pipeline: similarity of word shingles in percent.
NEAR_PERCENT = 80


def accept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.good_documents(spark, docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.distinct_documents(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash.near_distinct_documents(spark, docs, NEAR_PERCENT)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document taken more than once is repeated."""
    return mixing.mixed_documents(spark, docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of the token ids."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encoded(spark, docs, ranks, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", accept),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix),
    ("bpe", tokenize),
]

#: Scores, minima and merges have no SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
