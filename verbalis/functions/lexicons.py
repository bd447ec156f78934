"""Fixed word lists and rules, and small seed lexicons for tests.

Real lexicons are input tables (see ``Lexicons``); the seeds only show the schemas and give the tests known words.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The common English stop-word list of 179 entries (contractions included).
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his
    himself she she's her hers herself it it's its itself they them their theirs themselves what which who whom this
    that that'll these those am is are was were be been being have has had having do does did doing a an the and but
    if or because as until while of at by for with about against between into through during before after above below
    to from up down in out on off over under again further then once here there when where why how all any both each
    few more most other some such no nor not only own same so than too very s t can will just don don't should
    should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't
    haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't
    weren weren't won won't wouldn wouldn't
    """.split()
)

# Detachment rules (tag, suffix, replacement) in the order they are tried.
LEMMA_RULES = (
    ("n", "s", ""),
    ("n", "ses", "s"),
    ("n", "ves", "f"),
    ("n", "xes", "x"),
    ("n", "zes", "z"),
    ("n", "ches", "ch"),
    ("n", "shes", "sh"),
    ("n", "men", "man"),
    ("n", "ies", "y"),
    ("v", "s", ""),
    ("v", "ies", "y"),
    ("v", "es", "e"),
    ("v", "es", ""),
    ("v", "ed", "e"),
    ("v", "ed", ""),
    ("v", "ing", "e"),
    ("v", "ing", ""),
    ("a", "er", ""),
    ("a", "est", ""),
    ("a", "er", "e"),
    ("a", "est", "e"),
)

# Tags of words the part-of-speech lexicon does not know, by ending; the first match wins, else "n".
SUFFIX_TAGS = (("ly", "r"), ("ing", "v"), ("ed", "v"), ("ous", "a"), ("ful", "a"), ("ble", "a"))
DEFAULT_TAG = "n"

# Small seeds for tests: (word, tag), (word, tag, lemma), (word, polarity, subjectivity).
SEED_POS = (
    ("the", "o"), ("that", "o"), ("this", "o"), ("with", "o"), ("from", "o"), ("and", "o"), ("good", "a"),
    ("great", "a"), ("worthless", "a"), ("bad", "a"), ("new", "a"), ("never", "r"), ("always", "r"), ("often", "r"),
    ("run", "v"), ("said", "v"), ("make", "v"), ("children", "n"), ("thing", "n"), ("bed", "n"),
)
SEED_EXCEPTIONS = (
    ("men", "n", "man"), ("women", "n", "woman"), ("children", "n", "child"), ("feet", "n", "foot"),
    ("teeth", "n", "tooth"), ("mice", "n", "mouse"), ("geese", "n", "goose"), ("lives", "n", "life"),
    ("said", "v", "say"), ("went", "v", "go"), ("made", "v", "make"), ("ran", "v", "run"), ("took", "v", "take"),
    ("better", "a", "good"), ("best", "a", "good"), ("worse", "a", "bad"), ("worst", "a", "bad"),
    ("ininging", "v", "ining"), ("oned", "v", "on"), ("ines", "n", "in"),
)
SEED_SENTIMENT = (
    ("good", 0.7, 0.6), ("great", 0.8, 0.75), ("best", 1.0, 0.3), ("better", 0.5, 0.5), ("bad", -0.7, 0.67),
    ("worst", -1.0, 1.0), ("worthless", -0.8, 0.9), ("the", 0.0, 0.1), ("new", 0.14, 0.45), ("free", 0.4, 0.8),
    ("happy", 0.8, 1.0), ("sad", -0.5, 1.0), ("wrong", -0.5, 0.9), ("right", 0.29, 0.54), ("and", 0.05, 0.05),
    ("ing", 0.25, 0.5), ("ion", -0.25, 0.5), ("ent", -0.5, 0.25), ("ore", 0.125, 0.375), ("ati", -0.125, 0.625),
)


@dataclass(frozen=True)
class Lexicons:
    """The word tables a run uses. ``None`` switches a table off (an empty table)."""

    dictionary: DataFrame  # word
    pos: DataFrame  # word, tag in a, v, r, n, o
    exceptions: DataFrame  # word, tag, lemma
    sentiment: DataFrame  # word, polarity, subjectivity
    proper_nouns: DataFrame  # word
    stop_words: tuple[str, ...] = STOP_WORDS

    def with_tables(self, **tables) -> "Lexicons":
        return replace(self, **tables)


def seed_lexicons(spark: SparkSession, dictionary: DataFrame | None = None) -> Lexicons:
    """Seed tables; ``dictionary`` defaults to the words of the other seeds."""
    pos = spark.createDataFrame(SEED_POS, "word string, tag string")
    exceptions = spark.createDataFrame(SEED_EXCEPTIONS, "word string, tag string, lemma string")
    sentiment = spark.createDataFrame(SEED_SENTIMENT, "word string, polarity double, subjectivity double")
    if dictionary is None:
        dictionary = (
            pos.select("word").union(exceptions.select(F.col("lemma").alias("word"))).union(exceptions.select("word"))
        ).distinct()
    return Lexicons(dictionary, pos, exceptions, sentiment, spark.createDataFrame([], "word string"))


def dictionary_from_corpus(docs: DataFrame, text_col: str, min_docs: int) -> DataFrame:
    """Alphabetic lowercased words that occur in at least ``min_docs`` documents."""
    from verbalis.functions.text import corpus_tokens

    return (
        docs.select(F.explode(F.array_distinct(corpus_tokens(text_col))).alias("word"))
        .filter(F.col("word").rlike(r"^\p{L}+$"))
        .groupBy("word")
        .count()
        .filter(F.col("count") >= min_docs)
        .select("word")
    )
