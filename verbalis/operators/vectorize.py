"""Term counts, TF-IDF and scaled record statistics as long sparse tables (a missing row is a zero)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verbalis.functions import text as T
from verbalis.operators.lookup import lookup_join


def _tagged(array, kind: str):
    return F.transform(array, lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("term")))


def term_counts(
    docs: DataFrame,
    vocab: DataFrame,
    kinds=("lemma", "bigram", "trigram"),
    lemmas_col: str = "lemmas",
    grams_col: str = "gram_tokens",
    keep: tuple[str, ...] = ("doc_id",),
    presence: bool = False,
    small: bool | None = None,
) -> DataFrame:
    """``doc_id, term_id, tf``. Lemmas are counted in the lemma array, collocations in the token array ``gram_tokens``.

    All kinds come from one pass over the records; occurrences outside the vocabulary never leave their task.
    """
    arrays = {
        "lemma": lambda: _tagged(F.col(lemmas_col), "lemma"),
        "bigram": lambda: _tagged(T.phrases(grams_col, 2), "bigram"),
        "trigram": lambda: _tagged(T.phrases(grams_col, 3), "trigram"),
    }
    terms = docs.select(*keep, F.explode(F.concat(*[arrays[k]() for k in kinds])).alias("t")).select(*keep, "t.kind", "t.term")
    table = vocab.filter(F.col("kind").isin(*kinds)).select("kind", "term", "term_id")
    counted = lookup_join(terms, table, ["kind", "term"], "inner", small).groupBy(*keep, "term_id")
    return counted.agg((F.lit(1) if presence else F.count(F.lit(1))).cast("bigint").alias("tf"))


def inverse_document_frequency(counts: DataFrame, vocab: DataFrame, n_docs) -> DataFrame:
    """``term_id, df, idf`` with idf = ln((1 + n) / (1 + df)) + 1, for every term of the vocabulary.

    ``n_docs`` is a number or a column (a scalar subquery).
    """
    n = n_docs if not isinstance(n_docs, int) else F.lit(n_docs)
    df = counts.groupBy("term_id").agg(F.count(F.lit(1)).alias("df"))
    return (
        vocab.select("term_id")
        .join(df, "term_id", "left")
        .withColumn("df", F.coalesce("df", F.lit(0).cast("bigint")))
        .withColumn("idf", F.log((1.0 + n) / (1.0 + F.col("df"))) + 1.0)
    )


def tfidf(counts: DataFrame, idf: DataFrame, small: bool | None = None) -> DataFrame:
    """Counts with ``value`` = tf * idf in place of ``tf``."""
    return (
        lookup_join(counts, idf.select("term_id", "idf"), "term_id", "inner", small)
        .withColumn("value", F.col("tf") * F.col("idf"))
        .drop("tf", "idf")
    )


def l2_rows(values: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Divide each value by the length of its record's vector. A record has at most one row per feature."""
    norm = F.sqrt(F.sum(F.col("value") * F.col("value")).over(W.partitionBy(id_col)))
    return values.withColumn("value", F.when(norm > 0, F.col("value") / norm).otherwise(F.col("value")))


def long_stats(stats: DataFrame, names: list[str], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``doc_id, name, value`` from one column per statistic."""
    return stats.unpivot(list(keep), names, "name", "value")


def minmax_bounds(long: DataFrame) -> DataFrame:
    """``name, lo, hi``: one row per statistic."""
    return long.groupBy("name").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))


def minmax_scale(long: DataFrame, bounds: DataFrame) -> DataFrame:
    """Scale each statistic to 0 .. 1 with stored bounds; a constant one becomes 0. Bounds have twelve rows at most."""
    return (
        long.join(F.broadcast(bounds), "name")
        .withColumn(
            "value",
            F.when(F.col("hi") == F.col("lo"), F.lit(0.0)).otherwise(
                (F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo"))
            ),
        )
        .drop("lo", "hi")
    )


def append_stats(terms: DataFrame, scaled: DataFrame, names: list[str], n_terms) -> DataFrame:
    """Add the statistics to the term values; their ids follow the terms in name order."""
    position = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("name")) - 1
    n = F.lit(n_terms) if isinstance(n_terms, int) else n_terms
    stats = scaled.withColumn("term_id", (position + n).cast("bigint")).drop("name")
    return terms.unionByName(stats.select(*terms.columns)).filter("value <> 0")


def standard_scale(long: DataFrame, keys: tuple[str, ...] = ("name",)) -> DataFrame:
    """Zero mean and unit population deviation per feature; a constant feature becomes 0."""
    moments = long.groupBy(*keys).agg(F.avg("value").alias("_mean"), F.stddev_pop("value").alias("_sd"))
    return (
        lookup_join(long, moments, list(keys))
        .withColumn("value", F.when(F.col("_sd") > 0, (F.col("value") - F.col("_mean")) / F.col("_sd")).otherwise(0.0))
        .drop("_mean", "_sd")
    )
