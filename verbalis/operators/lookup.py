"""Joins against one-row-per-key tables, and exact ranks of very large groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verbalis.session import Workspace

#: A side of a join is broadcast if it has at most so many rows and bytes as a Parquet table.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 128 << 20


def settle(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """The table, kept in the shared folder, and whether it is small enough to be broadcast.

    It is computed once, by as many tasks as it has partitions; its size is then read from the files. Nothing of it
    passes through one task or the driver, and plans that use it do not compute it again.
    """
    kept = Workspace(df.sparkSession).keep(df, "side")
    size = int(kept._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return kept, size <= BROADCAST_BYTES and kept.count() <= max_rows


def lookup_join(
    left: DataFrame, right: DataFrame, on: list[str] | str, how: str = "inner", small: bool | None = None
) -> DataFrame:
    """Join ``left`` with ``right``, which has one row per key.

    A right side proven small is broadcast, so the left side does not move. Otherwise both are shuffled by the key, and
    adaptive execution splits the partitions of hot keys by their measured size: no other row is copied for them.
    ``small`` skips the check where the caller has a bound (a top-k table, a fixed list).
    """
    on = [on] if isinstance(on, str) else list(on)
    if small is None:
        right, small = settle(right)
    return left.join(F.broadcast(right) if small else right, on, how)


def bucketed_rank(df: DataFrame, group: list[str], bucket: Column, order: list, out: str) -> DataFrame:
    """Exact 0-based row number of each row in its group, without sorting a whole group in one task.

    ``bucket`` must rise with the order. Rows are numbered inside (group, bucket) and shifted by the size of the
    buckets before, so a group that holds most of the rows is still sorted in many tasks.
    """
    keyed = df.withColumn("_bucket", bucket)
    keys = [*group, "_bucket"]
    before = (
        keyed.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_before",
            F.coalesce(
                F.sum("_n").over(
                    W.partitionBy(*group).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
        .drop("_n")
    )
    position = F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - 1
    return (
        keyed.join(before, keys)
        .withColumn(out, (position + F.col("_before")).cast("bigint"))
        .drop("_bucket", "_before")
    )
