"""The vocabulary: frequent lemmas, redundancy removal and the term union with its column order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbalis.operators.lookup import bucketed_rank, lookup_join

WHITE_SPACE = r"[\p{Z}\t\n\x0B\f\r\x1c-\x1f\x{85}]+"

# Order of the term kinds in the feature columns.
KIND_ORDER = {"lemma": 0, "bigram": 1, "trigram": 2}


def lemma_vocabulary(docs: DataFrame, lemmas_col: str = "lemmas", min_docs: int = 20, min_length: int = 3) -> DataFrame:
    """``term, df``: lemmas long enough that occur in enough records."""
    return (
        docs.select(F.explode(F.array_distinct(lemmas_col)).alias("term"))
        .filter(F.length("term") >= min_length)
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
        .filter(F.col("df") >= min_docs)
    )


def drop_redundant_lemmas(lemmas: DataFrame, bigrams: DataFrame) -> DataFrame:
    """Lemmas that are no part of a chosen bigram."""
    parts = bigrams.select(F.explode(F.split("term", " ")).alias("term")).distinct()
    return lookup_join(lemmas, parts, "term", "left_anti")


def drop_redundant_bigrams(bigrams: DataFrame, trigrams: DataFrame) -> DataFrame:
    """Bigrams that neither start nor end a chosen trigram."""
    words = F.split("term", " ")
    heads = trigrams.select(F.array_join(F.slice(words, 1, 2), " ").alias("term"))
    tails = trigrams.select(F.array_join(F.slice(words, 2, 2), " ").alias("term"))
    return lookup_join(bigrams, heads.union(tails).distinct(), "term", "left_anti")


def term_union(lemmas: DataFrame, bigrams: DataFrame, trigrams: DataFrame) -> DataFrame:
    """``term_id, term, kind``: lemmas, bigrams, trigrams, each in alphabetic order; the id is the feature column."""
    parts = [
        table.select("term", F.lit(kind).alias("kind"), F.lit(KIND_ORDER[kind]).alias("_kind"))
        for kind, table in (("lemma", lemmas), ("bigram", bigrams), ("trigram", trigrams))
    ]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    bucket = F.concat(F.col("_kind").cast("string"), F.substring("term", 1, 3))
    return bucketed_rank(union, [], bucket, ["_kind", "term"], "term_id").select("term_id", "term", "kind")


def corpus_counts(raw_words: int, vocab: DataFrame) -> DataFrame:
    """One row of vocabulary sizes."""
    count = lambda kind: F.count_if(F.col("kind") == kind)
    return vocab.agg(
        F.lit(raw_words).cast("bigint").alias("words_count"),
        count("lemma").alias("lemma_count"),
        count("bigram").alias("bigram_collocation_count"),
        count("trigram").alias("trigram_collocation_count"),
        F.count(F.lit(1)).alias("term_count"),
    )


def distinct_text_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct pieces of the lowercased texts between white space, punctuation kept."""
    return (
        docs.select(F.explode(F.split(F.lower(text_col), WHITE_SPACE)).alias("word"))
        .filter(F.col("word") != "")
        .distinct()
    )
