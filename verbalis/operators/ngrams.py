"""n-gram counts and collocations by log-likelihood ratio.

n-grams never cross records. They are made from each record's word array, without a window or a shuffle, and counted
with map-side aggregation. Scored n-grams are made of words that are frequent enough: these are numbered, and an n-gram
is counted and shuffled as one long.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbalis.functions import text as T
from verbalis.operators.lookup import lookup_join, settle
from verbalis.session import Workspace

#: Most words that are numbered: three numbers make one long. More words go by joins.
CODED_WORDS = (1 << 21) - 1
#: Rows of an Arrow batch of n-grams.
GRAM_ROWS = 1 << 20


def ngram_table(docs: DataFrame, n: int, words_col: str = "words", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, w1 .. wn``, one row per occurrence."""
    return docs.select(id_col, F.explode(T.ngrams(words_col, n)).alias("g")).select(
        id_col, *[F.col(f"g.w{i + 1}").alias(f"w{i + 1}") for i in range(n)]
    )


def word_counts(docs: DataFrame, words_col: str = "words") -> DataFrame:
    return docs.select(F.explode(words_col).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def ngram_counts(docs: DataFrame, n: int, words_col: str = "words") -> DataFrame:
    keys = [f"w{i + 1}" for i in range(n)]
    return ngram_table(docs, n, words_col).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def skipgram_counts(docs: DataFrame, words_col: str = "words") -> DataFrame:
    """Counts of the first and third word of every trigram."""
    return ngram_table(docs, 3, words_col).groupBy("w1", "w3").agg(F.count(F.lit(1)).alias("n"))


def _term(observed: Column, expected: Column) -> Column:
    """o * ln(o / e), 0 where nothing was observed."""
    return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(F.lit(0.0))


def _as_double(*names: str) -> list[Column]:
    return [F.col(n).cast("double") for n in names]


def bigram_g2(total: Column) -> Column:
    """Log-likelihood ratio of a 2 x 2 table, from ``n12, n1, n2`` and the number of tokens."""
    n12, n1, n2 = _as_double("n12", "n1", "n2")
    both, second_only, first_only = n12, n2 - n12, n1 - n12
    neither = total - both - second_only - first_only
    rest1, rest2 = total - n1, total - n2
    score = (
        _term(both, n1 * n2 / total)
        + _term(second_only, rest1 * n2 / total)
        + _term(first_only, n1 * rest2 / total)
        + _term(neither, rest1 * rest2 / total)
    )
    return F.round(2 * score, 4)


def trigram_g2(total: Column) -> Column:
    """Log-likelihood ratio of a 2 x 2 x 2 table under independence of the three words.

    Cells come from the counts by inclusion and exclusion. Record borders can push a cell below zero; such cells count
    as empty.
    """
    n123, n12, n13, n23 = _as_double("n123", "n12", "n13", "n23")
    n1, n2, n3 = _as_double("n1", "n2", "n3")
    cells = {
        (1, 1, 1): n123,
        (1, 1, 0): n12 - n123,
        (1, 0, 1): n13 - n123,
        (0, 1, 1): n23 - n123,
        (1, 0, 0): n1 - n12 - n13 + n123,
        (0, 1, 0): n2 - n12 - n23 + n123,
        (0, 0, 1): n3 - n13 - n23 + n123,
    }
    cells[(0, 0, 0)] = total - n1 - n2 - n3 + n12 + n13 + n23 - n123
    score = F.lit(0.0)
    for (a, b, c), observed in sorted(cells.items(), reverse=True):
        sides = (n1 if a else total - n1) * (n2 if b else total - n2) * (n3 if c else total - n3)
        score = score + _term(observed, sides / (total * total))
    return F.round(2 * score, 4)


def _frequent(counts: DataFrame, good: DataFrame | None, min_count: int) -> DataFrame:
    """Words that can be part of a kept n-gram: not junk, and at least as frequent as the n-gram has to be."""
    frequent = counts.filter(F.col("n") >= min_count)
    return frequent if good is None else frequent.join(good, "word", "left_semi")


def _named(counts: DataFrame, word: str, out: str) -> DataFrame:
    return counts.select(F.col("word").alias(word), F.col("n").alias(out))


def _total(counts: DataFrame) -> Column:
    """Number of words of all records."""
    return counts.select(F.sum("n").cast("double").alias("t")).scalar()


def kept_word_counts(docs: DataFrame, words_col: str = "words") -> DataFrame:
    """Word counts kept as a table: their sum is the number of words, and no score counts them again."""
    return Workspace(docs.sparkSession).keep(word_counts(docs, words_col), "word_counts")


class _Numbers:
    """Candidate words and their counts in every task; a word's number is its place in the table."""

    def __init__(self, words: DataFrame):
        table = words.select("word", "n").toArrow()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        self.size = table.num_rows
        self.shared = words.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes())

    def coded(self, docs: DataFrame, words_col: str) -> DataFrame:
        """``codes``: the number of every word of a record, -1 for words that are no candidates."""
        shared = self.shared

        @F.arrow_udf("array<int>")
        def number(words: pa.Array) -> pa.Array:
            known = pa.ipc.open_stream(shared.value).read_all().column("word").combine_chunks()
            encoded = words.flatten().dictionary_encode()
            # one look-up per different word of the batch
            place = pc.index_in(encoded.dictionary, value_set=known.cast(encoded.dictionary.type))
            codes = place.take(encoded.indices).fill_null(-1)
            sizes = pc.list_value_length(words).fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), codes)

        return docs.select(number(words_col).alias("codes"))

    def grams(self, coded: DataFrame, *spans: tuple[int, ...]) -> DataFrame:
        """``gram``, one row per occurrence of the words at the distances ``spans`` names; later spans are shifted."""
        size = self.size

        def emit(batches):
            for batch in batches:
                lists = batch.column(0)
                codes = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
                record = np.repeat(np.arange(len(sizes)), sizes)
                for shift, span in enumerate(spans):
                    n = max(len(codes) - span[-1], 0)
                    parts = [codes[at : at + n] for at in span]
                    whole = record[:n] == record[span[-1] : span[-1] + n]
                    whole = reduce(np.logical_and, [p >= 0 for p in parts], whole)
                    keys = reduce(lambda key, part: key * size + part, parts)[whole] + shift * size * size
                    for at in range(0, len(keys), GRAM_ROWS):
                        yield pa.RecordBatch.from_arrays([pa.array(keys[at : at + GRAM_ROWS])], ["gram"])

        return coded.mapInArrow(emit, "gram bigint")

    def words(self, grams: DataFrame, n: int) -> DataFrame:
        """``grams`` with their words ``w1 .. wn`` and the counts ``n1 .. nn`` of these in place of ``gram``."""
        shared, size, others = self.shared, self.size, [c for c in grams.columns if c != "gram"]

        def name(batches):
            known = pa.ipc.open_stream(shared.value).read_all().combine_chunks()
            for batch in batches:
                gram = batch.column("gram").to_numpy(zero_copy_only=False)
                places = [pa.array(gram // size ** (n - 1 - i) % size) for i in range(n)]
                parts = [known.column(c).take(p).combine_chunks() for c in ("word", "n") for p in places]
                parts = [c.cast(pa.string()) for c in parts[:n]] + parts[n:]
                columns = parts[:n] + [batch.column(c) for c in others] + parts[n:]
                names = [f"w{i + 1}" for i in range(n)] + others + [f"n{i + 1}" for i in range(n)]
                yield pa.RecordBatch.from_arrays(columns, names)

        kinds = [f"w{i + 1} string" for i in range(n)] + [f"{c} bigint" for c in others] + [f"n{i + 1} bigint" for i in range(n)]
        return grams.mapInArrow(name, ", ".join(kinds))


def _candidates(grams: DataFrame, words: DataFrame, keys: list[str]) -> DataFrame:
    """Occurrences made only of candidate words, dropped before they are counted."""
    for key in keys:
        grams = lookup_join(grams, words.select(F.col("word").alias(key)), key, "left_semi", small=False)
    return grams


def _counted(grams: DataFrame, keys: list[str], out: str, min_count: int = 1) -> DataFrame:
    return grams.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) >= min_count)


def _word_table(counts: DataFrame, good: DataFrame | None, min_count: int) -> tuple[DataFrame, _Numbers | None]:
    """The candidate words as a kept table, and their numbers if they are few enough to have any."""
    words, few = settle(_frequent(counts, good, min_count).filter("word IS NOT NULL"), CODED_WORDS)
    return words, _Numbers(words) if few else None


def bigram_scores(
    docs: DataFrame, good: DataFrame | None, min_count: int = 20, words_col: str = "words", counts: DataFrame | None = None
) -> DataFrame:
    """``w1, w2, n12, n1, n2, score`` of every bigram of good words that is frequent enough.

    ``counts`` is the kept table of word counts, if the caller has one.
    """
    counts = kept_word_counts(docs, words_col) if counts is None else counts
    words, numbers = _word_table(counts, good, min_count)
    if numbers:
        pairs = _counted(numbers.grams(numbers.coded(docs, words_col), (0, 1)), ["gram"], "n12", min_count)
        pairs = numbers.words(pairs, 2)
    else:
        pairs = _counted(_candidates(ngram_table(docs, 2, words_col), words, ["w1", "w2"]), ["w1", "w2"], "n12", min_count)
        for i in (1, 2):
            pairs = lookup_join(pairs, _named(words, f"w{i}", f"n{i}"), f"w{i}", "inner", small=False)
    return pairs.withColumn("score", bigram_g2(_total(counts)))


def _coded_trigrams(docs: DataFrame, numbers: _Numbers, min_count: int, words_col: str) -> DataFrame:
    """``w1, w2, w3`` and all counts, n-grams counted by the numbers of their words."""
    size = max(numbers.size, 1)
    coded = Workspace(docs.sparkSession).keep(numbers.coded(docs, words_col), "codes")
    grams, few = settle(_counted(numbers.grams(coded, (0, 1, 2)), ["gram"], "n123", min_count))
    # Pair counts are needed only for pairs inside a kept trigram; all three come from one pass.
    inside = {
        "n12": f"gram div {size}",
        "n23": f"gram % {size * size}",
        "n13": f"gram div {size * size} * {size} + gram % {size} + {size * size}",
    }
    needed = grams.select(F.explode(F.array(*[F.expr(e) for e in inside.values()])).alias("gram")).distinct()
    pairs = numbers.grams(coded, (0, 1), (0, 2))
    if few:
        pairs = _counted(lookup_join(pairs, needed, "gram", "left_semi", small=True), ["gram"], "n")
    else:
        # counted first: a frequent pair is then one row a task in the shuffle
        pairs = _counted(pairs, ["gram"], "n").join(needed, "gram", "left_semi")
    pairs, few = settle(pairs)
    for out, place in inside.items():
        named = pairs.select(F.col("gram").alias("_pair"), F.col("n").alias(out))
        grams = lookup_join(grams.withColumn("_pair", F.expr(place)), named, "_pair", "inner", few).drop("_pair")
    return numbers.words(grams, 3)


def _joined_trigrams(docs: DataFrame, words: DataFrame, min_count: int, words_col: str) -> DataFrame:
    """The same by joins with more candidate words than can be numbered."""
    keys = ["w1", "w2", "w3"]
    grams, few = settle(_counted(_candidates(ngram_table(docs, 3, words_col), words, keys), keys, "n123", min_count))
    adjacent = grams.select("w1", "w2").union(grams.select("w2", "w3")).distinct()
    pairs = _pair_counts(ngram_table(docs, 2, words_col), adjacent, ["w1", "w2"], few)
    outer = _pair_counts(ngram_table(docs, 3, words_col).drop("w2"), grams.select("w1", "w3").distinct(), ["w1", "w3"], few)
    pairs, _ = settle(pairs)
    grams = grams.join(pairs.withColumnRenamed("n", "n12"), ["w1", "w2"])
    grams = grams.join(pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("n").alias("n23")), ["w2", "w3"])
    grams = grams.join(outer.withColumnRenamed("n", "n13"), ["w1", "w3"])
    for i in (1, 2, 3):
        grams = lookup_join(grams, _named(words, f"w{i}", f"n{i}"), f"w{i}", "inner", small=False)
    return grams


def _pair_counts(pairs: DataFrame, needed: DataFrame, keys: list[str], small: bool) -> DataFrame:
    """Counts of the needed pairs; others are dropped before they are shuffled."""
    return _counted(lookup_join(pairs, needed, keys, "left_semi", small), keys, "n")


def trigram_scores(
    docs: DataFrame, good: DataFrame | None, min_count: int = 10, words_col: str = "words", counts: DataFrame | None = None
) -> DataFrame:
    """``w1, w2, w3``, all counts and the score of every trigram of good words that is frequent enough.

    ``counts`` is the kept table of word counts, if the caller has one.
    """
    counts = kept_word_counts(docs, words_col) if counts is None else counts
    words, numbers = _word_table(counts, good, min_count)
    if numbers:
        grams = _coded_trigrams(docs, numbers, min_count, words_col)
    else:
        grams = _joined_trigrams(docs, words, min_count, words_col)
    return grams.withColumn("score", trigram_g2(_total(counts)))


def top_collocations(scores: DataFrame, n: int, count: int | None) -> DataFrame:
    """The ``count`` best n-grams as phrases (all of them if ``count`` is None); ties go to the smaller n-gram."""
    keys = [f"w{i + 1}" for i in range(n)]
    top = scores.orderBy(F.desc("score"), *keys)
    top = top if count is None else top.limit(count)
    return top.select(F.concat_ws(" ", *keys).alias("term"), *keys, "score")
