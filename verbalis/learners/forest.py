"""Tree ensembles MLlib does not have: extremely randomised trees and SAMME.R boosting."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbalis.learners.boosting import Booster, boost
from verbalis.learners.machines import totals_of
from verbalis.learners.scored import HasClassColumns, ScoredModel, matrix, set_params

SLOTS = 1_000_000  # (node, candidate, class) counts of one pass
TINY = float(np.finfo(np.float64).eps)


def leaf_of(tree: dict, x: np.ndarray) -> np.ndarray:
    """Node each row ends in. A tree is four parallel lists; leaves have feature -1."""
    feature, threshold = np.array(tree["feature"]), np.array(tree["threshold"])
    left, right = np.array(tree["left"]), np.array(tree["right"])
    node = np.zeros(len(x), dtype=int)
    rows = np.arange(len(x))
    while True:
        inner = feature[node] >= 0
        if not inner.any():
            return node
        at = node[inner]
        goes_left = x[rows[inner], feature[at]] <= threshold[at]
        node[inner] = np.where(goes_left, left[at], right[at])


def rows_of(leaf: np.ndarray, nodes: list[tuple[int, int]]) -> Iterator[tuple[np.ndarray, int]]:
    """The rows in each of ``nodes`` (node, slot), with its slot; rows are sorted by leaf once."""
    order = np.argsort(leaf, kind="stable")
    wanted = [n for n, _ in nodes]
    starts, ends = (np.searchsorted(leaf[order], wanted, side) for side in ("left", "right"))
    for (_, at), start, end in zip(nodes, starts, ends):
        yield order[start:end], at


class ForestModel(ScoredModel):
    """Trees with class shares in their leaves, combined by mean share or by the SAMME.R score."""

    @staticmethod
    def score(state: dict, x: np.ndarray) -> np.ndarray:
        classes = state["classes"]
        total = np.zeros((len(x), classes))
        for tree in state["trees"]:
            shares = np.array(tree["shares"])[leaf_of(tree, x)]
            if state["combine"] == "samme":
                logs = np.log(np.maximum(shares, TINY))
                shares = (classes - 1) * (logs - logs.mean(axis=1, keepdims=True))
            total += shares
        if state["combine"] == "samme":
            total /= max(1, len(state["trees"])) * (classes - 1)
            total = np.exp(total - total.max(axis=1, keepdims=True))
        return total / np.maximum(total.sum(axis=1, keepdims=True), TINY)


class ExtraTreesClassifier(Estimator, HasClassColumns, DefaultParamsReadable, DefaultParamsWritable):
    """Extremely randomised trees, grown level by level for all trees at once.

    Per level, two aggregations see every record once: the ranges of the candidate features in each open node, from
    which the driver draws one threshold per candidate, and the class counts on both sides of each threshold. Tasks
    send only sums per (node, candidate), so the traffic depends on the size of the model, not of the data.
    """

    numTrees = Param(Params._dummy(), "numTrees", "trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth", TypeConverters.toInt)
    maxFeatures = Param(Params._dummy(), "maxFeatures", "candidates per node, 0 for the square root", TypeConverters.toInt)
    minSplit = Param(Params._dummy(), "minSplit", "records a node needs to be split", TypeConverters.toInt)
    minLeaf = Param(Params._dummy(), "minLeaf", "records a leaf needs", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, numTrees=100, maxDepth=2, maxFeatures=0, minSplit=2, minLeaf=1, seed=5):
        super().__init__()
        self._set_class_columns()
        set_params(self)

    def _fit(self, dataset: DataFrame) -> ForestModel:
        rows = self.rows(dataset).withColumn("fold", F.lit(0)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            trees, classes = self.grow(rows, [-1])
        finally:
            rows.unpersist()
        return ForestModel({"trees": trees[0], "classes": classes, "combine": "mean"})

    def grow(self, rows: DataFrame, folds: list[int]):
        """Trees of one forest per fold, each from the rows outside it (-1: all rows), grown together; and the classes."""
        get = lambda name: self.getOrDefault(getattr(self, name))
        rng = np.random.default_rng(get("seed"))
        found = rows.groupBy("y", "fold").agg(F.count(F.lit(1)).alias("n")).collect()
        classes, dims = max(r.y for r in found) + 1, rows.select(F.size("x").alias("d")).first().d
        counts = {f: np.bincount([r.y for r in found if r.fold != f], [r.n for r in found if r.fold != f], classes) for f in folds}
        wanted = min(dims, get("maxFeatures") or max(1, int(math.sqrt(dims))))
        blank = lambda f: {"fold": f, "feature": [-1], "threshold": [0.0], "left": [-1], "right": [-1], "counts": [counts[f].tolist()]}
        trees = [blank(f) for f in folds for _ in range(get("numTrees"))]
        open_nodes = [(t, 0) for t in range(len(trees))]
        for _ in range(get("maxDepth")):
            children = []
            step = max(1, SLOTS // (wanted * classes))
            for start in range(0, len(open_nodes), step):
                part = open_nodes[start : start + step]
                children += self._split(rows, trees, part, rng, wanted, dims, classes)
            open_nodes = children
            if not open_nodes:
                break
        for tree in trees:
            tree["shares"] = [(np.array(c) / max(1.0, sum(c))).tolist() for c in tree.pop("counts")]
            del tree["fold"]
        size = get("numTrees")
        return [trees[k * size : (k + 1) * size] for k in range(len(folds))], classes

    def _split(self, rows, trees, nodes, rng, wanted, dims, classes):
        """Split the given nodes; the new nodes that may be split further."""
        get = lambda name: self.getOrDefault(getattr(self, name))
        may = [
            (t, n) for t, n in nodes if sum(trees[t]["counts"][n]) >= get("minSplit") and np.count_nonzero(trees[t]["counts"][n]) > 1
        ]
        if not may:
            return []
        picks = np.array([rng.choice(dims, wanted, replace=False) for _ in may])
        used = sorted({t for t, _ in may})
        shapes = {t: {k: trees[t][k] for k in ("fold", "feature", "threshold", "left", "right")} for t in used}
        slot = {key: i for i, key in enumerate(may)}
        by_tree = {t: [] for t in used}
        for t, n in may:
            by_tree[t].append((n, slot[(t, n)]))
        shared = rows.sparkSession.sparkContext.broadcast((shapes, by_tree, picks))

        def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            shapes, by_tree, picks = shared.value
            low, high = np.full(picks.shape, np.inf), np.full(picks.shape, -np.inf)
            for batch in batches:
                every, fold = matrix(batch["x"]), batch["fold"].to_numpy()
                parts = {f: every[fold != f] for f in {tree["fold"] for tree in shapes.values()}}
                for t, tree in shapes.items():
                    x = parts[tree["fold"]]
                    for here, at in rows_of(leaf_of(tree, x), by_tree[t]):
                        inside = x[here][:, picks[at]]
                        if len(inside):
                            low[at] = np.minimum(low[at], inside.min(axis=0))
                            high[at] = np.maximum(high[at], inside.max(axis=0))
            seen = np.argwhere(np.isfinite(low))
            yield pd.DataFrame(
                {"slot": seen[:, 0], "pick": seen[:, 1], "low": low[tuple(seen.T)], "high": high[tuple(seen.T)]}
            )

        limits = (
            rows.mapInPandas(ranges, "slot long, pick long, low double, high double")
            .groupBy("slot", "pick")
            .agg(F.min("low").alias("low"), F.max("high").alias("high"))
            .toPandas()
            .sort_values(["slot", "pick"])
        )
        cuts = np.full(picks.shape, np.nan)
        draws = rng.random(picks.shape)
        at = (limits["slot"].to_numpy(), limits["pick"].to_numpy())
        low, high = limits["low"].to_numpy(), limits["high"].to_numpy()
        cuts[at] = np.where(high > low, low + draws[at] * (high - low), np.nan)
        shared_cuts = rows.sparkSession.sparkContext.broadcast(cuts)

        def sides(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            shapes, by_tree, picks = shared.value
            cuts = shared_cuts.value
            left, whole = np.zeros((*picks.shape, classes)), np.zeros((len(picks), classes))
            for batch in batches:
                every, fold, label = matrix(batch["x"]), batch["fold"].to_numpy(), batch["y"].to_numpy()
                parts = {f: (every[fold != f], label[fold != f]) for f in {tree["fold"] for tree in shapes.values()}}
                for t, tree in shapes.items():
                    x, y = parts[tree["fold"]]
                    for here, at in rows_of(leaf_of(tree, x), by_tree[t]):
                        if len(here):
                            goes = x[here][:, picks[at]] <= cuts[at]
                            hot = np.eye(classes)[y[here]]
                            left[at] += goes.T.astype(float) @ hot
                            whole[at] += hot.sum(axis=0)
            seen = np.argwhere(left > 0)
            yield pd.DataFrame({"slot": seen[:, 0], "pick": seen[:, 1], "y": seen[:, 2], "n": left[tuple(seen.T)]})

        table = (
            rows.mapInPandas(sides, "slot long, pick long, y long, n double")
            .groupBy("slot", "pick", "y")
            .agg(F.sum("n").alias("n"))
            .toPandas()
        )
        shared.unpersist()
        shared_cuts.unpersist()
        left = np.zeros((*picks.shape, classes))
        left[table["slot"].to_numpy(), table["pick"].to_numpy(), table["y"].to_numpy()] = table["n"].to_numpy()
        out = []
        for (t, node), i in slot.items():
            tree = trees[t]
            whole = np.array(tree["counts"][node])
            right = whole - left[i]
            n_left, n_right = left[i].sum(axis=1), right.sum(axis=1)
            valid = ~np.isnan(cuts[i]) & (n_left >= max(1, get("minLeaf"))) & (n_right >= max(1, get("minLeaf")))
            if not valid.any():
                continue
            # Lowest weighted Gini is the highest sum of squared counts over side size.
            gain = (left[i] ** 2).sum(axis=1) / np.maximum(n_left, 1) + (right**2).sum(axis=1) / np.maximum(n_right, 1)
            best = int(np.argmax(np.where(valid, gain, -np.inf)))
            tree["feature"][node], tree["threshold"][node] = int(picks[i][best]), float(cuts[i][best])
            for side, counts in (("left", left[i][best]), ("right", right[best])):
                tree[side][node] = len(tree["feature"])
                for name, value in (("feature", -1), ("threshold", 0.0), ("left", -1), ("right", -1), ("counts", counts.tolist())):
                    tree[name].append(value)
                out.append((t, tree[side][node]))
        return out


class BoostedTreesClassifier(Estimator, HasClassColumns, DefaultParamsReadable, DefaultParamsWritable):
    """SAMME.R over trees that are grown from histograms of all records (``boosting.boost``)."""

    rounds = Param(Params._dummy(), "rounds", "trees", TypeConverters.toInt)
    learningRate = Param(Params._dummy(), "learningRate", "learning rate", TypeConverters.toFloat)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of each tree", TypeConverters.toInt)
    maxFeatures = Param(Params._dummy(), "maxFeatures", "candidates per node, 0 for all", TypeConverters.toInt)
    minSplit = Param(Params._dummy(), "minSplit", "records a node needs to be split", TypeConverters.toInt)
    minLeaf = Param(Params._dummy(), "minLeaf", "records a leaf needs", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, rounds=200, learningRate=0.5, maxDepth=2, maxFeatures=0, minSplit=2, minLeaf=1, seed=5):
        super().__init__()
        self._set_class_columns()
        set_params(self)

    def _fit(self, dataset: DataFrame) -> ForestModel:
        get = lambda name: self.getOrDefault(getattr(self, name))
        rows = self.rows(dataset).withColumn("fold", F.lit(0))
        classes = int(rows.agg(F.max("y").alias("m")).first().m) + 1
        one = Booster(
            -1, get("rounds"), get("learningRate"), get("maxDepth"), get("maxFeatures"), get("minSplit"), get("minLeaf"), get("seed")
        )
        return ForestModel({"trees": boost(rows, [one], classes)[0], "classes": classes, "combine": "samme"})


def forest_counts(family: str, rows: DataFrame, classes: int, settings: list[dict], folds: int, seed: int) -> np.ndarray:
    """Confusion counts (setting, fold, class, predicted class) of boosted or extra trees, grown together.

    Boosting grows all folds of all settings at once, extra trees all folds of a setting. ``rows`` has ``x, y, fold`` and
    is cached.
    """
    every = list(range(folds))
    if family == "adaboost":
        boosters = [
            Booster(f, s["trees"], s["learning_rate"], s["depth"], s.get("max_features", 0), s.get("min_split", 2), s.get("min_leaf", 1), seed)
            for s in settings
            for f in every
        ]
        grown, combine = boost(rows, boosters, classes), "samme"
    else:
        grown, combine = [], "mean"
        for s in settings:
            one = ExtraTreesClassifier(
                numTrees=s["trees"], maxDepth=s["depth"], maxFeatures=s.get("max_features", 0), minSplit=s.get("min_split", 2),
                minLeaf=s.get("min_leaf", 1), seed=seed,
            )
            grown += one.grow(rows, every)[0]
    shared = rows.sparkSession.sparkContext.broadcast([{"trees": t, "classes": classes, "combine": combine} for t in grown])

    def per_task(batches):
        counts = np.zeros((len(shared.value), classes, classes))
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            y, fold = batch.column("y").to_numpy(), batch.column("fold").to_numpy()
            for k, model in enumerate(shared.value):
                use = fold == k % folds
                if use.any():
                    found = ForestModel.score(model, x[use])
                    np.add.at(counts[k], (y[use], found.argmax(axis=1)), 1)
        return counts.ravel()

    found = totals_of(rows, per_task, len(grown) * classes * classes).reshape(len(settings), folds, classes, classes)
    shared.unpersist()
    return found
