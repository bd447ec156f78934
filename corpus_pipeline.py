"""A training corpus from raw documents, stage by stage: quality, exact copies, near copies, mix of sources, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from verbalis.llm import bagminhash, exact, mixing, packing, quality
from verbalis.llm.common import space_of, table
from verbalis.llm.queries import END_ID, SEQUENCE, tokenizer_path


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text the quality model does not reject."""
    return quality.good_texts(docs, table(spark, sf_dir, "labels"), space_of(spark))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that of the smallest id."""
    return exact.without_copies(docs, space_of(spark))


def unlike_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that of the smallest id; of its rows that repeat it, one stays."""
    return bagminhash.without_near_copies(docs, space_of(spark))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by the weights of their sources: one that is taken twice is two rows."""
    return mixing.mixed(docs, space_of(spark))


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences."""
    return packing.pack_documents(docs, space_of(spark), tokenizer_path(), SEQUENCE, END_ID)


STAGES = [
    ("quality", good_documents),
    ("exact_dedup", distinct_documents),
    ("near_dedup", unlike_documents),
    ("source_mix", mixed_documents),
    ("packing", packed_documents),
]

#: The stages score, hash and tokenise in ways that SQL does not have; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet in the shared folder and read again by the next."""
    space = space_of(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = space.keep(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
