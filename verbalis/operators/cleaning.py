"""Word tables: junk rules, part-of-speech tags and lemmas as joins with lexicon tables.

Rules run once per distinct word, not once per occurrence. The tables built here also feed the narrow cleaner used for
fitting and scoring (``functions.wordfacts``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbalis.functions import text as T
from verbalis.functions.lexicons import LEMMA_RULES, STOP_WORDS, Lexicons
from verbalis.operators.lookup import lookup_join


@dataclass(frozen=True)
class JunkProfile:
    """Which words count as junk. Requirements all have to hold; an enabled exemption accepts a word without them."""

    are_alpha: bool = True
    are_dictionary: bool = True
    are_not_stop: bool = True
    allow_number: bool = False
    allow_alphanum: bool = False
    allow_acronyms: bool = False
    allow_proper_nouns: bool = False


def token_table(docs: DataFrame, words_col: str = "words", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, pos, word`` from an array column."""
    return docs.select(id_col, F.posexplode(words_col).alias("pos", "word"))


def distinct_words(tokens: DataFrame) -> DataFrame:
    return tokens.select("word").distinct()


def _member(words: DataFrame, table: DataFrame, flag: str) -> DataFrame:
    """Both sides have one row per word, so a plain equi-join has no hot key."""
    return words.join(table.select("word").distinct().withColumn(flag, F.lit(True)), "word", "left").withColumn(
        flag, F.coalesce(flag, F.lit(False))
    )


def junk_condition(profile: JunkProfile, in_dictionary: Column, is_proper: Column, stop_words=STOP_WORDS) -> Column:
    """True for words to keep. Switched-off tests do not appear in the plan."""
    word = F.col("word")
    keep = F.lit(True)
    if profile.are_alpha:
        keep = keep & T.is_alpha(word)
    if profile.are_dictionary:
        keep = keep & in_dictionary
    if profile.are_not_stop:
        keep = keep & ~T.is_stop(word, stop_words)
    if profile.allow_number:
        keep = keep | T.is_number(word)
    if profile.allow_alphanum or profile.allow_acronyms:
        keep = keep | T.is_alphanumeric(word)
    if profile.allow_proper_nouns:
        keep = keep | is_proper
    return keep


def good_words(words: DataFrame, lexicons: Lexicons, profile: JunkProfile = JunkProfile()) -> DataFrame:
    """The distinct words that are not junk under the profile."""
    table = words
    in_dictionary = is_proper = F.lit(False)
    if profile.are_dictionary:
        if not (profile.allow_number or profile.allow_alphanum or profile.allow_acronyms or profile.allow_proper_nouns):
            # Nothing outside the dictionary can be kept, so the dictionary bounds the table from the start.
            table, in_dictionary = table.join(lexicons.dictionary.select("word").distinct(), "word", "left_semi"), F.lit(True)
        else:
            table, in_dictionary = _member(table, lexicons.dictionary, "_known"), F.col("_known")
    if profile.allow_proper_nouns:
        table, is_proper = _member(table, lexicons.proper_nouns, "_proper"), F.col("_proper")
    return table.filter(junk_condition(profile, in_dictionary, is_proper, lexicons.stop_words)).select("word")


def keep_good(tokens: DataFrame, good: DataFrame) -> DataFrame:
    return lookup_join(tokens, good, "word", "left_semi")


def excluded_words(tokens: DataFrame, good: DataFrame) -> DataFrame:
    """Distinct words rejected by the junk rules."""
    return distinct_words(tokens).join(good, "word", "left_anti")


def pos_tags(words: DataFrame, pos_lexicon: DataFrame) -> DataFrame:
    """``word, tag``: the lexicon's tag, else a tag by the word's ending."""
    tags = pos_lexicon.groupBy("word").agg(F.min("tag").alias("_tag"))
    return lookup_join(words, tags, "word", "left").select(
        "word", F.coalesce("_tag", T.suffix_tag(F.col("word"))).alias("tag")
    )


def lemma_candidates(word_tags: DataFrame) -> DataFrame:
    """``word, tag, candidate, rule`` for the word itself (rule 0) and every detachment rule that fits."""
    tag = F.when(F.col("tag") == "o", "n").otherwise(F.col("tag"))
    word = F.col("word")
    options = [F.struct(word.alias("candidate"), F.lit(0).alias("rule"))]
    for number, (rule_tag, suffix, replacement) in enumerate(LEMMA_RULES, start=1):
        stem = F.expr(f"substring(word, 1, length(word) - {len(suffix)})")
        fits = (tag == rule_tag) & word.endswith(suffix)
        options.append(F.when(fits, F.struct(F.concat(stem, F.lit(replacement)).alias("candidate"), F.lit(number).alias("rule"))))
    return word_tags.select("word", "tag", F.explode(F.filter(F.array(*options), lambda o: o.isNotNull())).alias("o")).select(
        "word", "tag", "o.candidate", "o.rule"
    )


def lemmas(word_tags: DataFrame, lexicons: Lexicons) -> DataFrame:
    """``word, tag, lemma`` of distinct words: exceptions first, then the shortest known candidate, else the word."""
    known = (
        lemma_candidates(word_tags)
        .join(lexicons.dictionary.select(F.col("word").alias("candidate")).distinct(), "candidate", "left_semi")
        .groupBy("word", "tag")
        .agg(F.min(F.struct(F.length("candidate").alias("len"), "rule", "candidate")).alias("best"))
        .select("word", "tag", F.col("best.candidate").alias("_lemma"))
    )
    exceptions = lexicons.exceptions.groupBy("word", F.col("tag").alias("_t")).agg(F.min("lemma").alias("_exception"))
    lookup_tag = F.when(F.col("tag") == "o", "n").otherwise(F.col("tag"))
    tagged = word_tags.withColumn("_t", lookup_tag).join(known, ["word", "tag"], "left")
    return lookup_join(tagged, exceptions, ["word", "_t"], "left").select(
        "word", "tag", F.coalesce("_exception", "_lemma", "word").alias("lemma")
    )


def word_facts(words: DataFrame, lexicons: Lexicons, profile: JunkProfile = JunkProfile(), lemmatize: bool = True) -> DataFrame:
    """``word, tag, keep, lemma, polarity, subjectivity``, one row per distinct word."""
    tagged = pos_tags(words, lexicons.pos)
    table = lemmas(tagged, lexicons) if lemmatize else tagged.withColumn("lemma", F.col("word"))
    good = good_words(words, lexicons, profile).withColumn("_keep", F.lit(True))
    scores = lexicons.sentiment.groupBy("word").agg(
        F.avg("polarity").alias("polarity"), F.avg("subjectivity").alias("subjectivity")
    )
    return (
        table.join(good, "word", "left")
        .join(scores, "word", "left")
        .select("word", "tag", F.coalesce("_keep", F.lit(False)).alias("keep"), "lemma", "polarity", "subjectivity")
    )


def inflections(lexicons: Lexicons) -> DataFrame:
    """Words a detachment rule can bring back to a dictionary word, at most one per rule and dictionary word."""
    word = F.col("word")
    options = []
    for _, suffix, replacement in LEMMA_RULES:
        stem = F.expr(f"substring(word, 1, length(word) - {len(replacement)})")
        options.append(F.when(word.endswith(replacement), F.concat(stem, F.lit(suffix))) if replacement else F.concat(word, F.lit(suffix)))
    return lexicons.dictionary.select(F.explode(F.array(*options)).alias("word")).filter("word IS NOT NULL").distinct()


def lexicon_words(lexicons: Lexicons, profile: JunkProfile = JunkProfile()) -> DataFrame:
    """Every word about which the lexicons say more than the rules for unknown words do.

    The table is bounded by the lexicons, not by the corpus. Inflected forms outside the dictionary matter only if the
    profile can keep them.
    """
    tables = [lexicons.dictionary, lexicons.pos, lexicons.exceptions, lexicons.sentiment, lexicons.proper_nouns]
    can_keep_others = not profile.are_dictionary or profile.allow_number or profile.allow_alphanum
    if can_keep_others or profile.allow_acronyms or profile.allow_proper_nouns:
        tables.append(inflections(lexicons))
    words = tables[0].select("word")
    for table in tables[1:]:
        words = words.unionByName(table.select("word"))
    return words.distinct()


def lemma_tokens(tokens: DataFrame, lexicons: Lexicons, profile: JunkProfile = JunkProfile(), lemmatize: bool = True) -> DataFrame:
    """``doc_id, pos, word, tag, lemma`` of the tokens that are not junk."""
    words = distinct_words(tokens)
    facts = word_facts(words, lexicons, profile, lemmatize).filter("keep").select("word", "tag", "lemma")
    return lookup_join(tokens, facts, "word").select("doc_id", "pos", "word", "tag", "lemma")


def lemma_phrases(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, lemma_phrase``: lemmas in token order, joined by one space; empty if nothing was kept."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("pos", "lemma"))), lambda t: t["lemma"])
    lists = kept.groupBy(id_col).agg(F.array_join(ordered, " ").alias("lemma_phrase"))
    return docs.select(id_col).join(lists, id_col, "left").select(
        id_col, F.coalesce("lemma_phrase", F.lit("")).alias("lemma_phrase")
    )
