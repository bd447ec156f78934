"""The ten classifier families, their default settings and their search spaces."""

from __future__ import annotations

import random
from dataclasses import dataclass, field

from pyspark.ml import Estimator
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)

from verbalis.learners.forest import BoostedTreesClassifier, ExtraTreesClassifier
from verbalis.learners.margins import CalibratedSvm, KernelSvm, LogisticMachine, linear_machine
from verbalis.learners.nearest import KnnClassifier

# Families in the order in which they are tried; equal scores keep it.
FAMILIES = (
    "logistic", "knn", "linear_svm", "poly_svm", "rbf_svm", "decision_tree", "random_forest", "extra_trees", "adaboost", "mlp",
)
NOT_SEARCHED = ("poly_svm", "rbf_svm")
#: Families whose folds and settings are all fitted together.
TOGETHER = ("logistic", "linear_svm", "poly_svm", "rbf_svm", "extra_trees", "adaboost")

# Default settings of each family.
DEFAULTS = {
    "logistic": {"alpha": 1e-4, "max_iter": 1000},
    "knn": {"k": 5},
    "linear_svm": {"alpha": 0.001, "max_iter": 50},
    "poly_svm": {"cost": 5.0, "max_iter": 30, "quadratic": "exact", "components": 1024},
    "rbf_svm": {"cost": 1.0, "gamma": 0.0, "max_iter": 30, "components": 512},
    "decision_tree": {"depth": 3},
    "random_forest": {"trees": 100, "depth": 3},
    "extra_trees": {"trees": 100, "depth": 2},
    "adaboost": {"trees": 200, "depth": 2, "learning_rate": 0.5},
    "mlp": {"hidden": (32,), "max_iter": 200},
}


@dataclass(frozen=True)
class Task:
    """What a learner has to know about the data."""

    classes: int
    features: int
    seed: int = 5
    overrides: dict = field(default_factory=dict)

    def settings(self, family: str, drawn: dict | None = None) -> dict:
        return {**DEFAULTS[family], **self.overrides.get(family, {}), **(drawn or {})}


def build(family: str, task: Task, drawn: dict | None = None, final: bool = False) -> Estimator:
    """An estimator with default, overridden and drawn settings.

    ``final`` builds the form that is kept: the linear SVM is scored bare and calibrated only when it is kept. Settings
    of the original without a counterpart (early stopping, rectified units, the minimum number of records to split in
    MLlib trees) use the nearest one.
    """
    s = task.settings(family, drawn)
    common = {"featuresCol": "features", "labelCol": "label_index"}
    if family == "logistic":
        return LogisticMachine(regParam=s["alpha"], maxIter=s["max_iter"])
    if family == "knn":
        return KnnClassifier(k=s["k"])
    if family == "linear_svm":
        if final:
            return CalibratedSvm(regParam=s["alpha"], maxIter=s["max_iter"], seed=task.seed)
        return linear_machine(task.classes, s["alpha"], s["max_iter"])
    if family == "poly_svm":
        return KernelSvm(
            kernel="poly", cost=s["cost"], maxIter=s["max_iter"], components=s["components"], seed=task.seed,
            quadratic=s["quadratic"],
        )
    if family == "rbf_svm":
        return KernelSvm(kernel="rbf", cost=s["cost"], gamma=s["gamma"], maxIter=s["max_iter"], components=s["components"], seed=task.seed)
    wanted = min(task.features, s["max_features"]) if s.get("max_features") else 0
    if family == "decision_tree":
        if wanted:
            return RandomForestClassifier(
                numTrees=1, bootstrap=False, featureSubsetStrategy=str(wanted), maxDepth=s["depth"],
                minInstancesPerNode=s.get("min_leaf", 1), seed=task.seed, **common,
            )
        return DecisionTreeClassifier(maxDepth=s["depth"], seed=task.seed, **common)
    if family == "random_forest":
        return RandomForestClassifier(
            numTrees=s["trees"], maxDepth=s["depth"], featureSubsetStrategy=str(wanted) if wanted else "sqrt",
            minInstancesPerNode=s.get("min_leaf", 1), seed=task.seed, **common,
        )
    if family == "extra_trees":
        return ExtraTreesClassifier(
            numTrees=s["trees"], maxDepth=s["depth"], maxFeatures=wanted, minSplit=s.get("min_split", 2),
            minLeaf=s.get("min_leaf", 1), seed=task.seed,
        )
    if family == "adaboost":
        return BoostedTreesClassifier(
            rounds=s["trees"], learningRate=s["learning_rate"], maxDepth=s["depth"], maxFeatures=wanted,
            minSplit=s.get("min_split", 2), minLeaf=s.get("min_leaf", 1), seed=task.seed,
        )
    if family == "mlp":
        layers = [task.features, *s["hidden"], task.classes]
        return MultilayerPerceptronClassifier(layers=layers, maxIter=s["max_iter"], seed=task.seed, **common)
    raise ValueError(f"unknown classifier family: {family}")


def layer_draws(rng: random.Random, count: int, layers=(4, 8), neurons=(50, 200)) -> list[tuple[int, ...]]:
    """Hidden layouts: the number of layers and of units each uniform in [low, high)."""
    return [tuple(rng.randrange(*neurons) for _ in range(rng.randrange(*layers))) for _ in range(count)]


def draws(family: str, count: int, seed: int) -> list[dict]:
    """Settings to try. A space that is a list with fewer than ``count`` entries is tried entry by entry."""
    rng = random.Random(seed)
    exponential = lambda scale: rng.expovariate(1.0 / scale)
    if family == "knn":
        options = [{"k": k} for k in (3, 4, 5)]
        return options if count >= len(options) else rng.sample(options, count)
    if family == "poly_svm":
        options = [{"cost": float(c)} for c in (1, 3, 5, 7, 9)]
        return options if count >= len(options) else rng.sample(options, count)
    if family == "mlp":
        return [{"hidden": h} for h in layer_draws(rng, max(1, count // 3))]
    out = []
    for _ in range(count):
        if family == "logistic":
            out.append({"alpha": exponential(0.1)})
        elif family == "linear_svm":
            out.append({"alpha": exponential(3e-5)})
        elif family == "rbf_svm":
            out.append({"cost": float(rng.choice((1, 10, 100, 1000))), "gamma": exponential(0.01)})
        else:
            drawn = {
                "depth": rng.randrange(3, 15), "max_features": rng.randrange(3, 15),
                "min_split": rng.randrange(2, 10), "min_leaf": rng.randrange(1, 10),
            }
            if family != "decision_tree":
                drawn["trees"] = rng.randrange(2, 150)
            out.append(drawn)
    return out
