"""The twelve per-record numbers. Counts come from each record's own word array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbalis.functions import text as T
from verbalis.operators.lookup import lookup_join

# Feature names; the columns of the feature matrix follow their alphabetic order.
WORD_FEATURES = ("meta__words_count", "meta__sentence_count", "meta__avg_word_length", "meta__avg_sentence_length", "meta__lexical_diversity")
TAG_FEATURES = {
    "n": "meta__noun_ratio",
    "v": "meta__verb_ratio",
    "a": "meta__adjective_ratio",
    "r": "meta__adverb_ratio",
    "o": "meta__other_pos_ratio",
}
SENTIMENT_FEATURES = ("eng__polarity_avg", "eng__subjectivity_avg")
ALL_FEATURES = tuple(sorted((*WORD_FEATURES, *TAG_FEATURES.values(), *SENTIMENT_FEATURES)))


def feature_names(use_meta: bool = True, use_sentiment: bool = True) -> list[str]:
    names = [*WORD_FEATURES, *TAG_FEATURES.values()] if use_meta else []
    return sorted([*names, *(SENTIMENT_FEATURES if use_sentiment else ())])


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def word_stats(words_col: str = "words", text_col: str = "text") -> dict[str, Column]:
    """Counts, lengths and diversity as expressions over one record; ratios are 0 for a record without words."""
    count = F.size(words_col).cast("double")
    letters = F.aggregate(words_col, F.lit(0).cast("bigint"), lambda acc, w: acc + F.length(w)).cast("double")
    sentences = T.sentence_count(text_col).cast("double")
    return {
        "meta__words_count": count,
        "meta__sentence_count": sentences,
        "meta__avg_word_length": _ratio(letters, count),
        "meta__avg_sentence_length": _ratio(count, sentences),
        "meta__lexical_diversity": _ratio(F.size(F.array_distinct(words_col)).cast("double"), count),
    }


def tag_ratios(docs: DataFrame, tokens: DataFrame, tags: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Share of each tag among a record's words. ``tags`` has one row per distinct word."""
    total = F.count(F.lit(1))
    shares = lookup_join(tokens, tags, "word").groupBy(id_col).agg(
        *[(F.count_if(F.col("tag") == tag) / total).alias(name) for tag, name in TAG_FEATURES.items()]
    )
    return docs.select(id_col).join(shares, id_col, "left").na.fill(0.0, list(TAG_FEATURES.values()))


def sentiment(docs: DataFrame, tokens: DataFrame, lexicon: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Mean polarity and subjectivity of a record's words found in the lexicon, 0 if there are none."""
    scores = lexicon.groupBy("word").agg(F.avg("polarity").alias("polarity"), F.avg("subjectivity").alias("subjectivity"))
    means = lookup_join(tokens, scores, "word").groupBy(id_col).agg(
        F.avg("polarity").alias("eng__polarity_avg"), F.avg("subjectivity").alias("eng__subjectivity_avg")
    )
    return docs.select(id_col).join(means, id_col, "left").na.fill(0.0, list(SENTIMENT_FEATURES))
