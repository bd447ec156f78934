"""Repeated lines: range-partitioned line hashes, secondary sort by document and position, keep bitmaps as runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verbalis.llm.common import SPACES, columns_of, folded, whole_row, whole_text
from verbalis.session import Workspace

#: Every hash is dealt over so many sort groups by document, so a line of very many documents is not one task's work.
SALTS = 128


def stripped(line: Column) -> Column:
    """The line without white space at its ends. Most lines have none and are not copied."""
    white = (F.ascii(line) <= 32) | (F.ascii(F.substring(line, -1, 1)) <= 32)
    return F.when(white, F.btrim(line, F.lit(SPACES))).otherwise(line)


def line_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``_id, _text, _pos, _hash``: every line of at least ``min_chars`` characters, ``_text`` being its text's hash."""
    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_text"), F.split(text, "\n", -1).alias("_lines"))
    # outer, since an inner one would split every text once more to see whether it has lines
    lines = rows.select("_id", "_text", F.posexplode_outer("_lines").alias("_pos", "_line"))
    lines = lines.filter(F.length("_line") >= min_chars).withColumn("_line", stripped(F.col("_line")))
    long = lines.filter(F.length("_line") >= min_chars)
    return long.select("_id", "_text", "_pos", F.unhex(F.md5(folded(F.col("_line")))).alias("_hash"))


def occurrences(keys: DataFrame, partitions: int) -> DataFrame:
    """``line_keys`` range-partitioned by hash, and in order of document (largest first) and position.

    ``_first`` marks the first occurrence of a hash in a document, found as the sorted rows stream by.
    """
    document = F.when(F.col("_id").isNull(), F.col("_text")).otherwise(F.xxhash64("_id"))
    salted = keys.withColumn("_salt", F.pmod(document, F.lit(SALTS)))
    ranged = salted.repartitionByRange(partitions, "_hash", "_salt")
    order = Window.partitionBy("_hash", "_salt").orderBy(F.col("_id").desc(), "_text", "_pos")
    same = F.lag("_id").over(order).eqNullSafe(F.col("_id")) & (
        F.col("_id").isNotNull() | F.lag("_text").over(order).eqNullSafe(F.col("_text"))
    )
    return ranged.withColumn("_first", (F.row_number().over(order) == 1) | ~same)


def line_bitmaps(
    docs: DataFrame,
    space: Workspace,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
) -> DataFrame:
    """Documents that lose lines: ``_id, _hash, dropped`` (sorted positions), ``_hash`` being that of the text.

    Keys of at least ``min_chars`` code points in at least ``min_docs`` documents lose all their lines except in the
    largest id that holds them.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # kept, since a range partitioning reads its input twice
    keys = space.keep(line_keys(docs, id_col, text_col, min_chars), "line_keys")
    found = space.keep(occurrences(keys, partitions), "line_hashes")
    space.drop("line_keys")
    counts = found.groupBy("_hash").agg(
        F.sum(F.col("_first").cast("long")).alias("_docs"), F.max("_id").alias("_last")
    )
    repeated = counts.filter(F.col("_docs") >= min_docs).select("_hash", "_last")
    lost = found.join(repeated, "_hash").filter(~F.col("_id").eqNullSafe(F.col("_last")))
    return lost.groupBy("_id", F.col("_text").alias("_hash")).agg(F.sort_array(F.collect_set("_pos")).alias("dropped"))


def with_value(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often a function of array elements in it reads it."""
    return F.get(F.transform(F.array(value), use), 0)


def _runs(dropped: Column, n_lines: Column) -> Column:
    """The keep bitmap, compressed: (start, length) of every run of kept lines."""
    ends = F.concat(F.array(F.lit(-1)), F.coalesce(dropped, F.array().cast("array<int>")), F.array(n_lines))

    def between(ends: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(ends) - 2),
            lambda i: F.struct(
                (F.get(ends, i) + 1).alias("start"), (F.get(ends, i + 1) - F.get(ends, i) - 1).alias("length")
            ),
        )

    return F.filter(with_value(ends, between), lambda r: r["length"] > 0)


def dedup_lines(
    docs: DataFrame,
    space: Workspace,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
) -> DataFrame:
    """One row per document: all input columns, ``n_lines``, ``n_dropped`` and ``keep_runs``, the compressed keep bitmap.

    Lines end at ``\\n``; null or empty text is one empty line. Rows that repeat an id are one
    document and keep or lose their lines together; a null id is smaller than any other, and each text without an id is
    a document. A document may lose all its lines:
    ``keep_runs`` is then empty. Input columns that are called like the three added ones are left out of the result.
    Empty tables give an empty result.
    """
    bitmaps = line_bitmaps(docs, space, id_col, text_col, min_chars, min_docs)
    bitmaps = bitmaps.select(F.col("_id").alias("_of"), F.col("_hash").alias("_at"), "dropped")
    rows = docs.select(whole_row(docs), F.xxhash64(whole_text(text_col)).alias("_hash"), F.col(id_col).alias("_id"))
    same = (F.col("_hash") == F.col("_at")) & F.col("_id").eqNullSafe(F.col("_of"))
    text = whole_text(F.col("_row").getField(text_col))
    n_lines = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    return rows.join(bitmaps, same, "left").select(
        *columns_of(docs, {"n_lines", "n_dropped", "keep_runs"}),
        n_lines.cast("long").alias("n_lines"),
        F.coalesce(F.array_size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        _runs(F.col("dropped"), n_lines).alias("keep_runs"),
    )


def kept_text(text: Column, runs: Column) -> Column:
    """The lines of the runs, joined by ``\\n``."""
    def joined(lines: Column) -> Column:
        return F.array_join(F.flatten(F.transform(runs, lambda r: F.slice(lines, r["start"] + 1, r["length"]))), "\n")

    return with_value(F.split(F.coalesce(text, F.lit("")), "\n", -1), joined)
