"""Labelled records: projection, null handling and the rare-class filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbalis.operators.lookup import lookup_join


def labelled_records(df: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``doc_id, text, label``: text is never null, rows without a label are dropped, labels are strings."""
    return df.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.col(label_col).cast("string").alias("label"),
    ).filter(F.col("label").isNotNull())


def class_sizes(df: DataFrame, label_col: str = "label") -> DataFrame:
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))


def keep_frequent_classes(df: DataFrame, min_records: int, label_col: str = "label") -> DataFrame:
    """Rows whose class has at least ``min_records`` rows."""
    kept = class_sizes(df, label_col).filter(F.col("n") >= min_records).select(label_col)
    return lookup_join(df, kept, label_col, "left_semi")


def require_classes(df: DataFrame, label_col: str = "label") -> DataFrame:
    """The input, if it has at least two classes; otherwise an error."""
    if df.select(label_col).distinct().limit(2).count() < 2:
        raise ValueError("a classifier needs at least two classes; lower min_records_per_class or add records")
    return df
