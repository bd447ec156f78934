"""The given tables as labelled records, and the lexicons used on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbalis.functions.lexicons import Lexicons, dictionary_from_corpus, seed_lexicons
from verbalis.plans.cleaner import TextCleaner
from verbalis.session import Workspace, spread

DICTIONARY_MIN_DOCS = 5
_kept: dict[tuple, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), "doc_id")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, text, label`` with the quality flag as label."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("label"))
    return documents(spark, sf_dir).select("doc_id", "text").join(labels, "doc_id")


def once(spark: SparkSession, sf_dir: str, name: str, build):
    """A value made once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _kept:
        _kept[key] = build()
    return _kept[key]


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    return once(spark, sf_dir, "workspace", lambda: Workspace(spark))


def lexicons(spark: SparkSession, sf_dir: str) -> Lexicons:
    """Seed tables and a dictionary of the words common in the English documents, kept as a table."""

    def build():
        english = documents(spark, sf_dir).filter("lang = 'en'")
        dictionary = dictionary_from_corpus(english, "text", DICTIONARY_MIN_DOCS)
        return seed_lexicons(spark, workspace(spark, sf_dir).keep(dictionary, "dictionary"))

    return once(spark, sf_dir, "lexicons", build)


def cleaner(spark: SparkSession, sf_dir: str) -> TextCleaner:
    return once(spark, sf_dir, "cleaner", lambda: TextCleaner.build(lexicons(spark, sf_dir)))
