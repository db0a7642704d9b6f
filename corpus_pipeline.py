"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stridecast.llm import exact_dedup, mixing, packing, quality, simhash
from stridecast.llm.queries import default_tokenizer
from stridecast.llm.tables import stage, table

#: A packing worker's memory: the executor's heap is grown by then, and the workers of
#: the stages before have left theirs. Bytes of text at a time, and parts of words kept.
PACK_BYTES = 2_000_000
PACK_PARTS = 100_000


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.distinct_texts(docs)


def dissimilar_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.representatives(docs)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that the sources come near their targets."""
    return mixing.mixed(docs)


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens, with their ids."""
    return packing.packed(docs, default_tokenizer(), together=PACK_BYTES, remembered=PACK_PARTS)


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", distinct_documents),
    ("simhash near-dedup", dissimilar_documents),
    ("mixing", mixed_documents),
    ("packing", packed_documents),
]

#: The classifier, the fingerprints and the tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
