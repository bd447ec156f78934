"""Exact duplicates: 128-bit content hash, then comparison of the bytes inside each hash group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from verbalis.llm.common import SPACE_RUN, columns_of, whole_row, whole_text
from verbalis.session import Workspace


def normalised(text: str | Column) -> Column:
    """The text with every run of white space replaced by one space; null is empty."""
    return F.regexp_replace(whole_text(text), SPACE_RUN, " ")


def content_key(sha: Column) -> Column:
    """The leading 128 bits of the SHA-256, as 32 hexadecimal digits."""
    return F.substring(sha, 1, 32)


def exact_copies(
    docs: DataFrame,
    space: Workspace,
    id_col: str = "doc_id",
    text_col: str = "text",
    key: Callable[[Column], Column] = content_key,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal if their normalised bytes are; of equal texts the smallest id stays. Rows are grouped by ``key``
    first, and only ids and hashes are shuffled for that. Texts of groups with more than one row are then grouped by
    their bytes, after a partial aggregation in every task, so a group of very many copies costs a task one row. Keys
    that hold different texts (collisions) are resolved by the bytes.

    Null text is empty text. A null id is larger than any other: it stays only if all ids of its group are null. Rows
    that repeat an id and a text have the same values, so all repeats of the smallest id are marked as kept. Empty tables
    give an empty result; other columns, whatever their names, are not read.
    """
    rows = docs.select(F.col(id_col).alias("_id"), normalised(text_col).alias("_norm"))
    rows = rows.withColumn("_sha", F.sha2("_norm", 256)).withColumn("_key", key(F.col("_sha")))
    light = space.keep(rows.select("_id", "_sha", "_key"), "exact_hashes")
    shared = light.groupBy("_key").count().filter("count > 1").select("_key")
    candidates = rows.select("_id", "_key", "_norm").join(shared, "_key", "left_semi")
    classes = candidates.groupBy("_norm").agg(F.min("_id").alias("keep_id"), F.count("*").alias("group_size"))
    classes = classes.withColumn("_sha", F.sha2("_norm", 256)).withColumn("_key", key(F.col("_sha")))
    groups = space.keep(classes.select("_key", "_sha", "keep_id", "group_size"), "exact_groups")
    collided = groups.groupBy("_key").count().filter("count > 1").select("_key")
    if collided.isEmpty():
        found = light.join(groups.drop("_sha"), "_key", "left")
    else:
        easy = light.join(collided, "_key", "left_anti").join(groups.drop("_sha"), "_key", "left")
        hard = rows.join(collided, "_key", "left_semi")
        sizes = hard.groupBy("_norm").agg(F.min("_id").alias("keep_id"), F.count("*").alias("group_size"))
        columns = ["_key", "_id", "_sha", "keep_id", "group_size"]
        found = easy.select(columns).unionByName(hard.join(sizes, "_norm").select(columns))
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("_id")).otherwise(F.col("keep_id"))
    return found.select(
        F.col("_id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def without_copies(docs: DataFrame, space: Workspace, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts: that of the smallest id.

    Of rows that repeat both id and text, one stays: the first by the hash of all its columns.
    """
    stay = exact_copies(docs.select(id_col, text_col), space, id_col, text_col).filter("kept")
    stay = stay.select(F.col(id_col).alias("_stay"), F.col("text_sha256").alias("_key")).distinct()
    rows = docs.select(whole_row(docs), F.col(id_col).alias("_id"), F.sha2(normalised(text_col), 256).alias("_sha"))
    same = (F.col("_sha") == F.col("_key")) & F.col("_id").eqNullSafe(F.col("_stay"))
    order = Window.partitionBy("_sha", "_id").orderBy(F.xxhash64("_row"))
    left = rows.join(stay, same, "left_semi").withColumn("_at", F.row_number().over(order))
    return left.filter("_at = 1").select(*columns_of(docs))
