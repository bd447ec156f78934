"""Support vector machines: one-vs-rest linear machines, Platt calibration, and kernel machines by explicit maps."""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbalis.learners.machines import Machine, fit_machines, held_out_counts, moments, one_against_one, one_against_rest, plain
from verbalis.learners.scored import HasClassColumns, ScoredModel, compacted, matrix, set_params
from verbalis.operators.sampling import stratified_folds


def linear_machine(classes: int, reg: float, max_iter: int, features: str = "features", parallelism: int = 4):
    """A linear SVM, one-vs-rest for more than two classes."""
    machine = LinearSVC(featuresCol=features, labelCol="label_index", regParam=reg, maxIter=max_iter, tol=1e-3)
    if classes <= 2:
        return machine
    return OneVsRest(classifier=machine, featuresCol=features, labelCol="label_index", parallelism=parallelism)


class CalibratedModel(ScoredModel):
    """Mean over folds of the normalised sigmoids of linear margins."""

    @staticmethod
    def score(state: dict, x: np.ndarray) -> np.ndarray:
        total = 0.0
        for fold in state["folds"]:
            margins = x @ np.array(fold["weights"]).T + np.array(fold["intercepts"])
            shares = 1.0 / (1.0 + np.exp(np.clip(margins * np.array(fold["a"]) + np.array(fold["b"]), -500, 500)))
            total = total + shares / np.maximum(shares.sum(axis=1, keepdims=True), 1e-300)
        return total / len(state["folds"])


def platt_sigmoids(margins: DataFrame, steps: int = 50) -> dict[tuple[int, int], tuple[float, float]]:
    """Sigmoid parameters per (fold, class) by Newton steps.

    ``margins`` has ``fold, class, margin, hit``. One step is one aggregation for all folds and classes together; the
    result has folds times classes rows. Targets are smoothed by the class sizes.
    """
    sizes = margins.groupBy("fold", "class").agg(F.sum("hit").alias("pos"), F.sum(1 - F.col("hit")).alias("neg")).collect()
    values = {(r["fold"], r["class"]): [0.0, math.log((r.neg + 1.0) / (r.pos + 1.0))] for r in sizes}
    slots = {key: i for i, key in enumerate(sorted(values))}
    classes = 1 + max(c for _, c in values)
    size = {(r["fold"], r["class"]): (r.pos, r.neg) for r in sizes}
    of_slot = lambda pick: F.get(
        F.array(*[F.lit(float(pick(key))) for key in sorted(values)]), F.col("slot")
    )
    index = F.array(*[F.lit(slots.get((f, c), 0)) for f in range(1 + max(f for f, _ in values)) for c in range(classes)])
    high, low = of_slot(lambda k: (size[k][0] + 1.0) / (size[k][0] + 2.0)), of_slot(lambda k: 1.0 / (size[k][1] + 2.0))
    data = (
        margins.withColumn("slot", F.get(index, F.col("fold") * classes + F.col("class")))
        .select("slot", "margin", F.when(F.col("hit") == 1, high).otherwise(low).alias("t"))
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    for _ in range(steps):
        a, b = of_slot(lambda k: values[k][0]), of_slot(lambda k: values[k][1])
        p = 1.0 / (1.0 + F.exp(a * F.col("margin") + b))
        m, w = F.col("margin"), F.col("p") * (1.0 - F.col("p"))
        sums = (
            data.withColumn("p", p)
            .groupBy("slot")
            .agg(
                F.sum((F.col("t") - F.col("p")) * m).alias("ga"),
                F.sum(F.col("t") - F.col("p")).alias("gb"),
                F.sum(w * m * m).alias("haa"),
                F.sum(w * m).alias("hab"),
                F.sum(w).alias("hbb"),
            )
            .collect()
        )
        change, keys = 0.0, sorted(values)
        for r in sums:
            at = values[keys[r.slot]]
            hessian = np.array([[r.haa + 1e-9, r.hab], [r.hab, r.hbb + 1e-9]])
            step = np.linalg.solve(hessian, np.array([r.ga, r.gb]))
            step *= min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
            at[0] -= float(step[0])
            at[1] -= float(step[1])
            change = max(change, float(np.abs(step).max()))
        if change < 1e-5:
            break
    else:
        warnings.warn(f"sigmoids took {steps} steps and still moved by {change:.1e}", stacklevel=2)
    data.unpersist()
    return {k: (v[0], v[1]) for k, v in values.items()}


class CalibratedSvm(Estimator, HasClassColumns, DefaultParamsReadable, DefaultParamsWritable):
    """Linear SVM with sigmoid calibration: one machine per fold, its sigmoid fitted on the held-out margins."""

    regParam = Param(Params._dummy(), "regParam", "regularisation", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "iterations", TypeConverters.toInt)
    folds = Param(Params._dummy(), "folds", "calibration folds", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, regParam=0.001, maxIter=50, folds=5, seed=5):
        super().__init__()
        self._set_class_columns()
        set_params(self)

    def _fit(self, dataset: DataFrame) -> CalibratedModel:
        folds = self.getOrDefault(self.folds)
        rows, classes, _ = machine_rows(self, dataset, folds, self.getOrDefault(self.seed))
        try:
            signs = one_against_rest(classes)
            _, _, deviation = moments(rows, list(range(folds)))
            machines = [Machine(f, self.getOrDefault(self.regParam), scale=deviation[f]) for f in range(folds)]
            weights = fit_machines(rows, machines, signs, "hinge", self.getOrDefault(self.maxIter))
            if classes <= 2:  # a margin per class, as for several classes
                weights, signs = [np.vstack([-w, w]) for w in weights], np.array([[1.0, -1.0], [-1.0, 1.0]])
            sigmoids = held_out_sigmoids(rows, [plain] * folds, weights, signs)
        finally:
            rows.unpersist()
        parts = []
        for fold, w in enumerate(weights):
            a, b = zip(*(sigmoids.get((fold, c), (-1.0, 0.0)) for c in range(len(w))))
            parts.append({"weights": w[:, :-1].tolist(), "intercepts": w[:, -1].tolist(), "a": list(a), "b": list(b)})
        return CalibratedModel({"folds": parts})


def machine_rows(stage: HasClassColumns, dataset: DataFrame, folds: int, seed: int, width=None) -> tuple[DataFrame, int, int]:
    """Kept rows ``x, y, fold`` for linear machines, the number of classes, and the number of features."""
    label, features = stage.col("labelCol"), stage.col("featuresCol")
    size = dataset.agg(
        F.count(F.lit(1)).alias("n"), F.max(label).alias("m"), F.max(F.size(vector_to_array(features))).alias("d")
    ).first()
    # rows without ids are dealt by their features
    own_id = stage.col("idCol") in dataset.columns
    key = F.col(stage.col("idCol")) if own_id else F.xxhash64(vector_to_array(features))
    rows = dataset.select(key.alias("doc_id"), F.col(features).alias("features"), F.col(label).alias("label_index"))
    rows = stratified_folds(rows, folds, seed, "doc_id", "label_index") if folds else rows.withColumn("fold", F.lit(0))
    rows = rows.select(vector_to_array("features").alias("x"), F.col("label_index").cast("int").alias("y"), F.col("fold").cast("int").alias("fold"))
    rows = compacted(rows, size.n, size.d, width(size.d) if width else 0).persist(StorageLevel.MEMORY_AND_DISK)
    return rows, int(size.m) + 1, size.d


def held_out_sigmoids(rows: DataFrame, maps: list, weights: list[np.ndarray], signs: np.ndarray) -> dict[tuple[int, int], tuple[float, float]]:
    """Sigmoid parameters per (fold, output) from the margins of the rows that the fold's machine has not seen."""
    shared = rows.sparkSession.sparkContext.broadcast((maps, weights, signs))

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps, weights, signs = shared.value
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            y, fold = batch.column("y").to_numpy(), batch.column("fold").to_numpy()
            for k, (features, w) in enumerate(zip(maps, weights)):
                use = fold == k
                if not use.any():
                    continue
                found = features(x[use]) @ w[:, :-1].T + w[:, -1]
                sign = signs[y[use]]
                r, c = np.nonzero(sign)
                columns = [np.full(len(r), k, np.int32), c.astype(np.int32), found[r, c], (sign[r, c] > 0).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns], names=["fold", "class", "margin", "hit"])

    return platt_sigmoids(rows.mapInArrow(margins, "fold int, class int, margin double, hit int"))


class LinearModel(ScoredModel):
    """Logistic (one output) or multinomial (an output per class) shares of linear margins."""

    @staticmethod
    def score(state: dict, x: np.ndarray) -> np.ndarray:
        margins = x @ np.array(state["weights"]).T + np.array(state["intercepts"])
        if margins.shape[1] == 1:
            margins = np.hstack([-margins / 2, margins / 2])
        shares = np.exp(margins - margins.max(axis=1, keepdims=True))
        return shares / shares.sum(axis=1, keepdims=True)


class LogisticMachine(Estimator, HasClassColumns, DefaultParamsReadable, DefaultParamsWritable):
    """Logistic regression with a penalty on squared weights."""

    regParam = Param(Params._dummy(), "regParam", "regularisation", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "iterations", TypeConverters.toInt)

    @keyword_only
    def __init__(self, regParam=1e-4, maxIter=1000):
        super().__init__()
        self._set_class_columns()
        set_params(self)

    def _fit(self, dataset: DataFrame) -> LinearModel:
        rows, classes, _ = machine_rows(self, dataset, 0, 0)
        try:
            one = Machine(-1, self.getOrDefault(self.regParam))
            w = fit_machines(rows, [one], one_against_rest(classes), "log", self.getOrDefault(self.maxIter))[0]
        finally:
            rows.unpersist()
        return LinearModel({"weights": w[:, :-1].tolist(), "intercepts": w[:, -1].tolist()})


class _ArrayMap(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A seeded map of vectors. Its random numbers come from the seed, so no table has to be shipped or saved."""

    components = Param(Params._dummy(), "components", "size of the result", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol="features", outputCol="mapped", components=512, gamma=1.0, seed=5):
        super().__init__()
        set_params(self)

    @staticmethod
    def prepare(dims: int, components: int, gamma: float, seed: int):
        raise NotImplementedError

    @staticmethod
    def apply(prepared, x: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def _transform(self, dataset: DataFrame) -> DataFrame:
        settings = tuple(self.getOrDefault(getattr(self, n)) for n in ("components", "gamma", "seed"))
        prepare, apply = type(self).prepare, type(self).apply
        cache: dict = {}

        @F.pandas_udf("array<double>")
        def mapped(rows: pd.Series) -> pd.Series:
            if not len(rows):
                return pd.Series([], dtype=object)
            x = matrix(rows)
            if "p" not in cache:
                cache["p"] = prepare(x.shape[1], *settings)
            return pd.Series(list(apply(cache["p"], x)))

        array = mapped(vector_to_array(self.getInputCol()))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(array))


class FourierFeatures(_ArrayMap):
    """Random Fourier features of the Gaussian kernel exp(-gamma |x - z|^2)."""

    @staticmethod
    def prepare(dims, components, gamma, seed):
        rng = np.random.default_rng(seed)
        return rng.normal(0.0, math.sqrt(2.0 * gamma), (dims, components)), rng.uniform(0.0, 2.0 * math.pi, components)

    @staticmethod
    def apply(prepared, x):
        directions, shifts = prepared
        return np.sqrt(2.0 / len(shifts)) * np.cos(x @ directions + shifts)


class QuadraticSketch(_ArrayMap):
    """Tensor sketch of the kernel (gamma x.z + 1)^2: two count sketches multiplied in the frequency domain."""

    @staticmethod
    def prepare(dims, components, gamma, seed):
        rng = np.random.default_rng(seed)
        buckets = rng.integers(0, components, (2, dims + 1))
        signs = rng.choice([-1.0, 1.0], (2, dims + 1))
        return buckets, signs, math.sqrt(gamma), components

    @staticmethod
    def apply(prepared, x):
        buckets, signs, scale, components = prepared
        wide = np.hstack([x * scale, np.ones((len(x), 1))])
        product = 1.0
        for h, s in zip(buckets, signs):
            sketch = np.zeros((len(x), components))
            np.add.at(sketch.T, h, (wide * s).T)
            product = product * np.fft.rfft(sketch, axis=1)
        return np.fft.irfft(product, n=components, axis=1)


class PolynomialExpansion(_ArrayMap):
    """All terms whose products add up to (gamma x.z + 1)^2 - 1: for each i the feature, then its products with 0 .. i."""

    @staticmethod
    def prepare(dims, components, gamma, seed):
        return np.array(quadratic_weights(dims, gamma))

    @staticmethod
    def apply(prepared, x):
        out = np.empty((len(x), len(prepared)))
        at = 0
        for i in range(x.shape[1]):
            out[:, at] = x[:, i]
            np.multiply(x[:, : i + 1], x[:, i : i + 1], out=out[:, at + 1 : at + 2 + i])
            at += i + 2
        out *= prepared
        return out


def quadratic_weights(dims: int, gamma: float) -> list[float]:
    """Weights of the expanded monomials for which their product is (gamma x.z + 1)^2 - 1.

    The expansion lists x_i, then x_0 x_i .. x_i x_i, for each i.
    """
    weights = []
    for i in range(dims):
        weights.append(math.sqrt(2.0 * gamma))
        weights += [math.sqrt(2.0) * gamma] * i + [gamma]
    return weights


class KernelSvm(Estimator, HasClassColumns, DefaultParamsReadable, DefaultParamsWritable):
    """Quadratic or Gaussian SVM with class shares: standard scaling, an explicit feature map, and a linear machine for
    every pair of classes on it. Sigmoids of the pairs are fitted on margins of rows that a machine has not seen.

    ``quadratic`` chooses the map of the quadratic kernel, at every number of features: ``exact`` writes out all d (d + 3)
    / 2 products, ``sketch`` approximates the kernel by ``components`` random numbers, with another model as the result.
    """

    kernel = Param(Params._dummy(), "kernel", "poly or rbf", TypeConverters.toString)
    cost = Param(Params._dummy(), "cost", "cost of errors", TypeConverters.toFloat)
    gamma = Param(Params._dummy(), "gamma", "kernel width, 0 for one over the number of features", TypeConverters.toFloat)
    components = Param(Params._dummy(), "components", "size of the random map", TypeConverters.toInt)
    maxIter = Param(Params._dummy(), "maxIter", "iterations", TypeConverters.toInt)
    folds = Param(Params._dummy(), "folds", "calibration folds", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)
    quadratic = Param(Params._dummy(), "quadratic", "map of the quadratic kernel: exact or sketch", TypeConverters.toString)

    @keyword_only
    def __init__(self, kernel="rbf", cost=1.0, gamma=0.0, components=512, maxIter=30, folds=5, seed=5, quadratic="exact"):
        if quadratic not in ("exact", "sketch"):
            raise ValueError(f"quadratic={quadratic!r} is not valid: exact or sketch")
        super().__init__()
        self._set_class_columns()
        set_params(self)

    def _fit(self, dataset: DataFrame) -> KernelModel:
        get = lambda name: self.getOrDefault(getattr(self, name))
        folds = get("folds")
        settings = {n: get(n) for n in ("kernel", "quadratic", "components", "gamma", "seed")}
        rows, classes, _ = machine_rows(self, dataset, folds, get("seed"), lambda d: mapped_width(d, settings))
        try:
            signs = one_against_one(classes)
            n, mean, deviation = moments(rows, [*range(folds), -1])
            maps = [KernelMap(m, d, size, **settings) for m, d, size in zip(mean, deviation, n)]
            machines = [Machine(f, 1.0 / (max(1, size) * get("cost")), k) for f, size, k in zip([*range(folds), -1], n, maps)]
            weights = fit_machines(rows, machines, signs, "hinge", get("maxIter"))
            sigmoids = held_out_sigmoids(rows.withColumn("group", F.lit(0)), maps[:-1], weights[:-1], signs) if folds else {}
        finally:
            rows.unpersist()
        pairs = range(signs.shape[1])
        # one sigmoid per pair: the mean of those of the folds
        of = {c: [v for (_, k), v in sigmoids.items() if k == c] or [(-1.0, 0.0)] for c in pairs}
        a, b = (np.array([np.mean([v[i] for v in of[c]]) for c in pairs]) for i in (0, 1))
        state = {"classes": classes, "mean": mean[-1].tolist(), "deviation": deviation[-1].tolist(), "rows": float(n[-1]), **settings}
        return KernelModel({**state, "weights": weights[-1].tolist(), "a": a.tolist(), "b": b.tolist()})


def mapped_width(dims: int, settings: dict) -> int:
    """Features of the kernel's map."""
    exact = settings["kernel"] == "poly" and settings["quadratic"] == "exact"
    return dims * (dims + 3) // 2 if exact else settings["components"]


def map_of(kernel: str, quadratic: str) -> type[_ArrayMap]:
    return FourierFeatures if kernel == "rbf" else {"exact": PolynomialExpansion, "sketch": QuadraticSketch}[quadratic]


class KernelMap:
    """Standard scaling and the explicit map of a kernel, for arrays. Its random numbers come from the seed."""

    def __init__(self, mean, deviation, rows, kernel, quadratic, components, gamma, seed):
        self.mean = np.array(mean)
        # the kernel is defined on features scaled by the population deviation
        deviation = np.array(deviation) * np.sqrt(max(0.0, rows - 1) / max(1.0, rows))
        self.scale = np.where(deviation > 0, 1 / np.where(deviation > 0, deviation, 1), 0.0)
        self.kind = map_of(kernel, quadratic)
        self.components, self.seed = components, seed
        self.gamma = gamma or 1.0 / max(1, len(self.mean))
        self.prepared = None

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) * self.scale
        if self.prepared is None:
            self.prepared = self.kind.prepare(len(self.mean), self.components, self.gamma, self.seed)
        return self.kind.apply(self.prepared, z)

    def __getstate__(self):
        return {**self.__dict__, "prepared": None}


def coupled(pair_shares: np.ndarray, classes: int) -> np.ndarray:
    """Class shares of every row from the shares of its pairs (second method of Wu, Lin and Weng, 2004).

    The shares p with sum 1 that minimise the sum over pairs of (r_ba p_a - r_ab p_b)^2, where r_ab is the share of a in
    the pair: a linear system of one equation per class and one for the sum.
    """
    n = len(pair_shares)
    q = np.zeros((n, classes + 1, classes + 1))
    k = 0
    for a in range(classes):
        for b in range(a + 1, classes):
            r = np.clip(pair_shares[:, k], 1e-7, 1 - 1e-7)
            q[:, a, a] += (1 - r) ** 2
            q[:, b, b] += r**2
            q[:, a, b] -= r * (1 - r)
            q[:, b, a] -= r * (1 - r)
            k += 1
    q[:, :classes, classes] = q[:, classes, :classes] = 1
    right = np.zeros((n, classes + 1, 1))
    right[:, classes] = 1
    shares = np.maximum(np.linalg.solve(q, right)[:, :classes, 0], 0)
    return shares / shares.sum(axis=1, keepdims=True)


class KernelModel(ScoredModel):
    """Machines of all pairs of classes on mapped features, a sigmoid for each, and coupled class shares."""

    @property
    def stages(self) -> list[_ArrayMap]:
        """The map of the kernel, with its settings."""
        kind = map_of(self.state["kernel"], self.state["quadratic"])
        gamma = self.state["gamma"] or 1.0 / max(1, len(self.state["mean"]))
        return [kind(components=self.state["components"], gamma=gamma, seed=self.state["seed"])]

    @staticmethod
    def score(state: dict, x: np.ndarray) -> np.ndarray:
        settings = {n: state[n] for n in ("kernel", "quadratic", "components", "gamma", "seed")}
        features = KernelMap(state["mean"], state["deviation"], state["rows"], **settings)
        w = np.array(state["weights"])
        if state["classes"] < 2:
            return np.ones((len(x), 1))
        margins = features(x) @ w[:, :-1].T + w[:, -1]
        shares = 1.0 / (1.0 + np.exp(np.clip(margins * np.array(state["a"]) + np.array(state["b"]), -500, 500)))
        return coupled(shares, state["classes"])


#: Rows, and values of their features, up to which a kernel's machines are fitted in the span of the mapped rows.
SPAN_ROWS, SPAN_VALUES = 2_000, 1 << 24


def span_rows(rows: DataFrame, basis: np.ndarray, features: KernelMap) -> DataFrame:
    """``rows`` with ``x`` in coordinates of the span of the mapped ``basis``, a number per row of it.

    For rows of the basis, inner products of the coordinates are those of the exact quadratic map, (gamma x.z + 1)^2 - 1.
    A machine's weights are sums of mapped rows, so machines fitted on the coordinates are those of the map itself,
    whose width grows with the square of the number of features.
    """
    z = (basis - features.mean) * features.scale
    value, vector = np.linalg.eigh((features.gamma * (z @ z.T) + 1) ** 2 - 1)
    kept = value > 1e-12 * max(value[-1], 1e-300)
    shared = rows.sparkSession.sparkContext.broadcast((basis, features, vector * np.where(kept, 1 / np.sqrt(np.where(kept, value, 1)), 0)))

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        basis, features, turn = shared.value
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            z = (x - features.mean) * features.scale**2
            out = ((features.gamma * (z @ basis.T - (z @ features.mean)[:, None]) + 1) ** 2 - 1) @ turn
            found = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([found, batch.column("y"), batch.column("fold")], names=["x", "y", "fold"])

    return rows.select("x", "y", "fold").mapInArrow(turned, "x array<double>, y int, fold int")


def span_counts(rows: DataFrame, machines: list[Machine], signs: np.ndarray, max_iter: int) -> np.ndarray:
    """Confusion counts of kernel machines fitted in the span of the mapped rows, which are few."""
    basis = rows.select("x").toArrow().column("x").combine_chunks()
    basis = basis.flatten().to_numpy(zero_copy_only=False).reshape(len(basis), -1)
    counts, shared_map = np.zeros((len(machines), len(signs), len(signs))), {}
    for i, m in enumerate(machines):
        shared_map.setdefault(id(m.features), []).append(i)
    for which in shared_map.values():
        turned = compacted(span_rows(rows, basis, machines[which[0]].features), len(basis), len(basis)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            here = [Machine(machines[i].fold, machines[i].reg) for i in which]
            weights = fit_machines(turned, here, signs, "hinge", max_iter)
            counts[which] = held_out_counts(turned, here, weights, signs)
        finally:
            turned.unpersist()
    return counts


def machine_counts(family: str, rows: DataFrame, classes: int, settings: list[dict], folds: int, seed: int) -> np.ndarray:
    """Confusion counts (setting, fold, class, predicted class): all folds of all settings are fitted together.

    ``rows`` has ``x, y, fold`` and is cached.
    """
    kernel = {"poly_svm": "poly", "rbf_svm": "rbf"}.get(family)
    signs = one_against_one(classes) if kernel and classes > 2 else one_against_rest(classes)
    every = list(range(folds))
    machines, maps = [], {}
    n, mean, deviation = (None, None, None) if family == "logistic" else moments(rows, every)
    for s in settings:
        for f in every:
            if kernel:
                key = (f, s.get("gamma", 0.0), s["components"], s.get("quadratic", "exact"))
                if key not in maps:
                    maps[key] = KernelMap(mean[f], deviation[f], n[f], kernel, key[3], s["components"], key[1], seed)
                machines.append(Machine(f, 1.0 / (max(1, n[f]) * s["cost"]), maps[key]))
            else:
                machines.append(Machine(f, s["alpha"], scale=None if family == "logistic" else deviation[f]))
    if family == "poly_svm" and all(s.get("quadratic", "exact") == "exact" for s in settings):
        count, dims = rows.count(), mean.shape[1]
        if count <= SPAN_ROWS and count * dims <= SPAN_VALUES and count < dims * (dims + 3) // 2:
            return span_counts(rows, machines, signs, settings[0]["max_iter"]).reshape(len(settings), folds, classes, classes)
    weights = fit_machines(rows, machines, signs, "log" if family == "logistic" else "hinge", settings[0]["max_iter"])
    return held_out_counts(rows, machines, weights, signs).reshape(len(settings), folds, classes, classes)
