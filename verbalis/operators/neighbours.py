"""Exact k nearest neighbours by Euclidean distance.

A training table within the bound is shipped to the tasks and every query row stays where it is. A larger one is cut
into blocks of bounded size: each pair of a query block and a training block is one task, which returns only the best k
per query; the partial lists are merged in two steps. No pair of rows is ever written out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BOUND = 20_000_000  # values of the training vectors that may be shipped
BLOCK = 10_000  # rows per block
CHUNK = 8_192  # training rows compared at a time
MERGE = 64  # blocks merged in the first step


class Nearest:
    """The k nearest rows to each row of ``x`` among training rows that are seen a part at a time, in order.

    ``marks`` and ``distances`` hold the marks (positions, labels) of the best so far and their squared distances, nearest
    first; ties keep the order in which rows were seen.
    """

    def __init__(self, x: np.ndarray, k: int):
        self.x, self.k, self.own = x, k, (x**2).sum(axis=1)[:, None]
        self.marks, self.distances = np.empty((len(x), 0), dtype=int), np.empty((len(x), 0))

    def see(self, part: np.ndarray, marks: np.ndarray) -> None:
        size = (part**2).sum(axis=1)
        if self.distances.shape[1] < self.k:
            squares = self.x @ part.T
            squares *= -2.0
            squares += self.own
            squares += size[None, :]
            self._fill(squares, marks)
            return
        # only a row that is nearer than the last of the best can change them
        for i, near in self._nearer(part, size):
            squares = self.own[i] + size[near] - 2.0 * (part[near] @ self.x[i])
            found = np.append(self.distances[i], np.round(np.maximum(squares, 0.0), 6))
            order = np.argsort(found, kind="stable")[: self.k]
            self.distances[i], self.marks[i] = found[order], np.append(self.marks[i], marks[near])[order]

    def _nearer(self, part: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Rows of ``x`` with all rows of ``part`` that are nearer than the last of their best, and a few more.

        Products are of single precision, unless numbers are too large for it; what they can be wrong by is allowed for.
        """
        most = float(max(self.own.max(initial=0), size.max(initial=0)))
        kind = np.float32 if most < 1e30 else np.float64
        wrong = (len(self.x.T) + 8) * np.finfo(kind).eps * most
        products = self.x.astype(kind) @ part.astype(kind).T
        products -= (size / 2).astype(kind)
        nearer = products > ((self.own - self.distances[:, -1:]) / 2 - 2 * wrong).astype(kind)
        for i in np.flatnonzero(nearer.any(axis=1)):
            yield i, np.flatnonzero(nearer[i])

    def _fill(self, squares: np.ndarray, marks: np.ndarray) -> None:
        distances = np.hstack([self.distances, np.round(np.maximum(squares, 0.0, out=squares), 6, out=squares)])
        wanted = min(self.k, distances.shape[1])
        limit = np.partition(distances, wanted - 1, axis=1)[:, wanted - 1]
        at = np.empty((len(self.x), wanted), dtype=int)
        for i, row in enumerate(distances):
            near = np.flatnonzero(row <= limit[i])
            at[i] = near[np.argsort(row[near], kind="stable")][:wanted]
        held = self.distances.shape[1]
        # the best so far come first and in order, so equal distances keep the order of the rows
        earlier = np.take_along_axis(self.marks, np.minimum(at, held - 1), axis=1) if held else at
        self.marks = np.where(at < held, earlier, marks[np.maximum(at - held, 0)])
        self.distances = np.take_along_axis(distances, at, axis=1)


def best_of(x: np.ndarray, train: np.ndarray, k: int, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``train`` (in id order) nearest to each row of ``x``, with squared distances; ties keep the order.

    Training rows are compared ``chunk`` at a time with the best so far, so memory does not grow with them.
    """
    best = Nearest(x, k)
    for start in range(0, len(train), chunk):
        part = train[start : start + chunk]
        best.see(part, np.arange(start, start + len(part)))
    return best.marks, best.distances


def _local(queries: pd.DataFrame, ids, labels, train, k: int) -> pd.DataFrame:
    """The k best of one training block for each query row."""
    out = []
    for start in range(0, len(queries), 512):
        part = queries.iloc[start : start + 512]
        picks, distances = best_of(np.stack(part["x"].to_numpy()).astype(float), train, k)
        out.append(
            pd.DataFrame(
                {
                    "query_id": part["query_id"].to_numpy(),
                    "near": [
                        [{"distance": d, "id": int(ids[p]), "label": int(labels[p])} for p, d in zip(ps, ds)]
                        for ps, ds in zip(picks, distances)
                    ],
                }
            )
        )
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "near": []})


SCHEMA = "query_id bigint, near array<struct<distance: double, id: bigint, label: int>>"


def neighbours(queries: DataFrame, training: DataFrame, k: int, bound: int = BOUND, block: int = BLOCK) -> DataFrame:
    """``query_id, near``: per query the k nearest (distance squared, id, label), nearest first, ties by id.

    ``queries`` has ``query_id, x``; ``training`` has ``id, x, label`` (int).
    """
    first = training.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).first()
    if not first.n:
        raise ValueError("no training rows")
    if first.n * first.d <= bound:
        return neighbours_of_local(queries, local_training(training), k)
    return _by_blocks(queries, training, k, -(-first.n // block), block)


def local_training(training: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and vectors of a bounded training table, in id order."""
    table = training.select("id", "x", "label").toPandas().sort_values("id")
    return table["id"].to_numpy(), table["label"].to_numpy(), np.stack(table["x"].to_numpy()).astype(float)


def neighbours_of_local(queries: DataFrame, table: tuple, k: int) -> DataFrame:
    shared = queries.sparkSession.sparkContext.broadcast(table)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, labels, train = shared.value
        for batch in batches:
            yield _local(batch, ids, labels, train, k)

    return queries.select("query_id", "x").mapInPandas(search, SCHEMA)


def _by_blocks(queries: DataFrame, training: DataFrame, k: int, train_blocks: int, block: int) -> DataFrame:
    query_blocks = -(-queries.count() // block)
    home = lambda id_, n: F.pmod(F.xxhash64(id_), F.lit(n))
    copies = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    left = queries.select("query_id", "x", home("query_id", query_blocks).alias("qb")).withColumn("tb", copies(train_blocks))
    right = training.select("id", "x", "label", home("id", train_blocks).alias("tb")).withColumn("qb", copies(max(1, query_blocks)))

    def search(key, ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if not len(ours) or not len(theirs):
            return pd.DataFrame({"query_id": [], "near": [], "tb": []})
        theirs = theirs.sort_values("id")
        train = np.stack(theirs["x"].to_numpy()).astype(float)
        return _local(ours, theirs["id"].to_numpy(), theirs["label"].to_numpy(), train, k).assign(tb=key[1])

    partial = left.groupBy("qb", "tb").cogroup(right.groupBy("qb", "tb")).applyInPandas(search, SCHEMA + ", tb bigint")
    best = F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near")
    merged = partial.groupBy("query_id", F.expr(f"tb DIV {MERGE}").alias("part")).agg(best)
    return merged.groupBy("query_id").agg(best)


def majority(near: DataFrame, label: str = "prediction") -> DataFrame:
    """Most frequent label among the neighbours; ties go to the lowest label."""
    labels = F.transform("near", lambda n: n["label"])
    counted = F.transform(
        F.array_distinct(labels),
        lambda c: F.struct((-F.size(F.filter(labels, lambda v: v == c))).alias("votes"), c.alias("label")),
    )
    return near.select("query_id", F.array_min(counted)["label"].alias(label))
