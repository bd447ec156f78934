"""Column expressions over one record's text. All are narrow: they never move rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from verbalis.functions.lexicons import DEFAULT_TAG, STOP_WORDS, SUFFIX_TAGS

WORD = r"[\p{L}\p{N}_]+"
LONG_WORD = r"[\p{L}\p{N}_]{2,}"


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in words)


def tokens(text: str | Column) -> Column:
    """Runs of letters and digits; runs that hold an underscore are dropped."""
    column = F.col(text) if isinstance(text, str) else text
    return F.filter(F.regexp_extract_all(column, F.lit(WORD), F.lit(0)), lambda w: ~F.contains(w, F.lit("_")))


def corpus_tokens(text: str | Column) -> Column:
    """Tokens of the lowercased text, stop words included."""
    return tokens(F.lower(F.col(text) if isinstance(text, str) else text))


def drop_words(words: str, stop_words=STOP_WORDS) -> Column:
    """Array column ``words`` without the listed words (exact, case-sensitive match)."""
    if not stop_words:
        return F.col(words)
    return F.expr(f"filter(`{words}`, w -> w NOT IN ({_quoted(stop_words)}))")


def with_record_words(df, text: str, out: str = "words", stop_words=STOP_WORDS):
    """Add the words of each record: tokenise, drop stop words by their exact case, then lowercase."""
    return (
        df.withColumn(out, tokens(text))
        .withColumn(out, drop_words(out, stop_words))
        .withColumn(out, F.transform(out, F.lower))
    )


def with_corpus_words(df, text: str, out: str = "words", stop_words=STOP_WORDS):
    """Add the words used to find n-grams: lowercase first, then tokenise and drop stop words."""
    return df.withColumn(out, corpus_tokens(text)).withColumn(out, drop_words(out, stop_words))


def raw_tokens(text: str | Column) -> Column:
    """Tokens of the raw text with at least two characters, as used when collocations are counted."""
    column = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(column, F.lit(LONG_WORD), F.lit(0))


def ngrams(words: str, n: int) -> Column:
    """Array of structs ``w1 .. wn`` of adjacent words. ``words`` must be a column of the input."""
    array = F.col(words)
    heads = F.slice(array, F.lit(1), F.greatest(F.size(array) - F.lit(n - 1), F.lit(0)))
    return F.transform(
        heads,
        lambda w, i: F.struct(w.alias("w1"), *[F.get(array, i + k).alias(f"w{k + 1}") for k in range(1, n)]),
    )


def phrases(words: str, n: int) -> Column:
    """Array of adjacent words joined by one space."""
    array = F.col(words)
    heads = F.slice(array, F.lit(1), F.greatest(F.size(array) - F.lit(n - 1), F.lit(0)))
    return F.transform(heads, lambda w, i: F.concat_ws(" ", w, *[F.get(array, i + k) for k in range(1, n)]))


def sentence_count(text: str | Column) -> Column:
    """Runs of ``.!?`` before a space or the end, plus one if the trimmed text does not end in one."""
    column = F.col(text) if isinstance(text, str) else text
    trimmed = F.regexp_replace(column, r"[ \t\n\r\f]+$", "")
    ended = F.size(F.regexp_extract_all(trimmed, F.lit(r"[.!?]+([ \t\n\r\f]|$)"), F.lit(0)))
    open_end = (F.length(trimmed) > 0) & ~trimmed.rlike(r"[.!?]$")
    return (ended + open_end.cast("int")).cast("bigint")


def is_alpha(word: Column) -> Column:
    return word.rlike(r"^\p{L}+$")


def is_number(word: Column) -> Column:
    return word.rlike(r"^\p{N}+$")


def is_alphanumeric(word: Column) -> Column:
    return word.rlike(r"^[\p{L}\p{N}]+$")


def is_stop(word: Column, stop_words=STOP_WORDS) -> Column:
    return F.lower(word).isin(list(stop_words)) if stop_words else F.lit(False)


def suffix_tag(word: Column) -> Column:
    """Tag of a word no lexicon knows, by its ending."""
    rule = None
    for suffix, tag in SUFFIX_TAGS:
        hit = word.endswith(suffix)
        rule = F.when(hit, tag) if rule is None else rule.when(hit, tag)
    return rule.otherwise(DEFAULT_TAG)
