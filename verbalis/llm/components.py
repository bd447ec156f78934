"""Connected components by alternating large-star and small-star steps over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbalis.session import Workspace


def _stars(links: DataFrame) -> DataFrame:
    """Large star, then small star: every node is linked to the smallest node it knows of."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    moved = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).unionByName(moved).distinct()


def components(links: DataFrame, space: Workspace, name: str) -> DataFrame:
    """``node, component`` for every linked node; a component is named by its smallest node.

    ``links`` has two columns of node numbers. Every round is a table in the shared folder, so lineage stays short and a
    lost executor costs no earlier round; only counts and check sums reach the driver. Nodes of very many links are
    joined, not grouped, so the optimizer may split them.
    """
    a, b = links.columns
    now = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()
    seen, turn, kept = None, 0, None
    while True:
        table = space.keep(now, f"{name}_{turn}")
        mark = table.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if kept is not None:
            space.drop(kept)
        kept = f"{name}_{turn}"
        if mark == seen or not mark[0]:
            break
        seen, turn, now = mark, turn + 1, _stars(table)
    roots = table.select(F.col("b").alias("node")).distinct()
    out = table.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return out.unionByName(roots.withColumn("component", F.col("node")))
