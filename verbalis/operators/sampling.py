"""Exact subsamples, hold-out splits and k-fold assignments.

Rows are ordered by the hash of seed and id, which is fixed for a row no matter where it is computed. A row's part
follows from the prefix of its hash for all but the few prefixes that hold a boundary, so only those rows are sorted;
the rest is assigned without moving it, however large its class is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verbalis.operators.lookup import lookup_join
from verbalis.operators.records import class_sizes

PREFIX = 4  # hex digits, so 65,536 buckets per class


def order_hash(id_col: str, seed: int):
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))


def _assign(df: DataFrame, label_col: str, id_col: str, seed: int, ends: DataFrame, out: str) -> DataFrame:
    """Add the part of each row, given per class the ranks (``ends``, ascending) at which a part ends."""
    keyed = df.withColumn("_hash", order_hash(id_col, seed)).withColumn("_bucket", F.substring("_hash", 1, PREFIX))
    before = (
        keyed.groupBy(label_col, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_upto",
            F.sum("_n").over(W.partitionBy(label_col).orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0)),
        )
        .withColumn("_before", F.col("_upto") - F.col("_n"))
    )
    # The bucket that holds the last row of each part; an empty first part has none.
    cuts = (
        ends.select(label_col, F.explode("ends").alias("_end"))
        .join(before, label_col)
        .filter((F.col("_before") < F.col("_end")) & (F.col("_end") <= F.col("_upto")))
        .groupBy(label_col)
        .agg(F.array_sort(F.collect_list("_bucket")).alias("_cuts"))
    )
    plan = ends.join(cuts, label_col, "left").withColumn(
        "_cuts", F.coalesce("_cuts", F.array().cast("array<string>"))
    )
    plan = plan.withColumn("_empty", F.size(F.filter("ends", lambda e: e <= 0)))
    placed = lookup_join(keyed, plan, label_col, "inner")
    boundary = F.array_contains("_cuts", F.col("_bucket"))
    scratch = ["_hash", "_bucket", "_cuts", "_empty", "ends"]
    whole = placed.filter(~boundary).withColumn(
        out, F.col("_empty") + F.size(F.filter("_cuts", lambda c: c < F.col("_bucket")))
    )
    split = (
        placed.filter(boundary)
        .join(before.select(label_col, "_bucket", "_before"), [label_col, "_bucket"])
        .withColumn(
            "_rank",
            F.row_number().over(W.partitionBy(label_col, "_bucket").orderBy("_hash", id_col)) - 1 + F.col("_before"),
        )
        .withColumn(out, F.size(F.filter("ends", lambda e: e <= F.col("_rank"))))
        .drop("_rank", "_before")
    )
    return whole.drop(*scratch).unionByName(split.drop(*scratch))


def _wanted(size: int | float, total, up: bool):
    """Row count for an int or a fraction of ``total``; fractions round up for hold-outs, half-even for samples."""
    if isinstance(size, float):
        share = F.lit(size) * total
        return (F.ceil(share) if up else F.bround(share, 0)).cast("bigint")
    return F.least(F.lit(size).cast("bigint"), total)


def stratified_quotas(sizes: DataFrame, size: int | float, label_col: str = "label", up: bool = True) -> DataFrame:
    """Rows of each class on the test side: shares of the train side are floored, largest remainders get one more.

    Works on the table of class sizes. Products of two counts need more than 64 bits on large tables.
    """
    everything = W.partitionBy(F.lit(0))
    table = (
        sizes.withColumn("_total", F.sum("n").over(everything))
        .withColumn("_train", F.col("_total") - _wanted(size, F.col("_total"), up))
        .withColumn("_product", F.expr("CAST(n AS DECIMAL(18,0)) * CAST(_train AS DECIMAL(18,0))"))
        .withColumn("_base", F.expr("CAST(_product DIV CAST(_total AS DECIMAL(18,0)) AS BIGINT)"))
        .withColumn("_rest", F.expr("CAST(_product % CAST(_total AS DECIMAL(18,0)) AS BIGINT)"))
        .withColumn("_spare", F.col("_train") - F.sum("_base").over(everything))
        .withColumn("_turn", F.row_number().over(everything.orderBy(F.desc("_rest"), label_col)))
    )
    train = F.col("_base") + F.when(F.col("_turn") <= F.col("_spare"), 1).otherwise(0)
    return table.select(label_col, "n", (F.col("n") - train).cast("bigint").alias("n_test"))


def require_splittable(df: DataFrame, size: int | float, kind: str = "stratified", label_col: str = "label") -> None:
    """Raise if a stratified split is not possible: a class of one row, or a side with fewer rows than classes."""
    if kind != "stratified":
        return
    quotas = stratified_quotas(class_sizes(df, label_col), size, label_col).agg(
        F.count("*").alias("classes"), F.min("n").alias("least"), F.sum("n").alias("n"), F.sum("n_test").alias("test")
    )
    found = quotas.first()
    if found.least < 2:
        raise ValueError("a class has only one record: a stratified split needs two of each")
    if min(found.test, found.n - found.test) < found.classes:
        raise ValueError("a side of the split has fewer records than there are classes")


def holdout_split(
    df: DataFrame,
    size: int | float = 0.2,
    kind: str = "stratified",
    seed: int = 5,
    id_col: str = "doc_id",
    label_col: str = "label",
    up: bool = True,
) -> DataFrame:
    """Add ``split``: exactly the wanted number of rows are ``test``, the others ``train``."""
    if kind == "stratified":
        quotas = stratified_quotas(class_sizes(df, label_col), size, label_col, up)
        ends = quotas.select(label_col, F.array("n_test").alias("ends"))
        parts = _assign(df, label_col, id_col, seed, ends, "_part")
    elif kind == "random":
        one = df.withColumn("_all", F.lit("all"))
        ends = (
            one.groupBy("_all")
            .agg(F.count(F.lit(1)).alias("n"))
            .select("_all", F.array(_wanted(size, F.col("n"), up)).alias("ends"))
        )
        parts = _assign(one, "_all", id_col, seed, ends, "_part").drop("_all")
    else:
        raise ValueError(f"unknown kind of split: {kind}")
    return parts.withColumn("split", F.when(F.col("_part") == 0, "test").otherwise("train")).drop("_part")


def subsample(
    df: DataFrame,
    size: int | float,
    kind: str = "stratified",
    seed: int = 5,
    id_col: str = "doc_id",
    label_col: str = "label",
) -> DataFrame:
    """Keep exactly a number of rows (int) or a share of them (float below 1.0)."""
    if isinstance(size, float) and size >= 1.0:
        return df
    return holdout_split(df, size, kind, seed, id_col, label_col, up=False).filter("split = 'test'").drop("split")


def class_shares(split: DataFrame, label_col: str = "label") -> DataFrame:
    """Share of each class on the test side."""
    counts = class_sizes(split.filter("split = 'test'"), label_col)
    total = F.sum("n").over(W.partitionBy(F.lit(0)))
    return counts.select(label_col, "n", (F.col("n") / total).alias("share"))


def fold_ends(sizes: DataFrame, folds: int, label_col: str = "label") -> DataFrame:
    """Per class, the ranks at which folds 0 .. folds-2 end.

    In the list of all rows sorted by class, fold i owns the positions p with p mod folds = i; class c takes as many
    rows of fold i as positions of fold i lie in its range.
    """
    start = F.coalesce(
        F.sum("n").over(W.partitionBy(F.lit(0)).orderBy(label_col).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    table = sizes.withColumn("_start", start)

    def owned(i: int):
        upper = F.ceil((F.col("_start") + F.col("n") - i) / F.lit(folds))
        lower = F.ceil((F.col("_start") - i) / F.lit(folds))
        return (upper - lower).cast("bigint")

    ends, total = [], F.lit(0).cast("bigint")
    for i in range(folds - 1):
        total = total + owned(i)
        ends.append(total)
    return table.select(label_col, F.array(*ends).alias("ends"))


def stratified_folds(
    df: DataFrame, folds: int = 5, seed: int = 5, id_col: str = "doc_id", label_col: str = "label"
) -> DataFrame:
    """Add ``fold`` (0 .. folds-1): every class is spread evenly over the folds."""
    ends = fold_ends(class_sizes(df, label_col), folds, label_col)
    return _assign(df, label_col, id_col, seed, ends, "fold")
