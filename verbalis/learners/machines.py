"""Many linear machines at once: all folds, classes and settings share each pass over the rows."""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Corrections that the solver remembers per machine, and values of a task's largest intermediate table.
HISTORY, CELLS = 6, 1 << 22
#: Values of the features of a task's rows that are worked on at a time.
WIDE_CELLS = 1 << 18
#: Values of rows that a task may hold to fit a machine on its own.
HELD_VALUES = 1 << 23
#: Width of the rounded corner of the hinge.
CORNER = 0.2
#: Tasks whose sums are added up by one; sums of more tasks are first added up in groups.
DIRECT = 16

Map = Callable[[np.ndarray], np.ndarray]


def plain(x: np.ndarray) -> np.ndarray:
    return x


def one_against_rest(classes: int) -> np.ndarray:
    """Sign of every class for every output; two classes need one output."""
    return np.array([[-1.0], [1.0]]) if classes <= 2 else 2 * np.eye(classes) - 1


def one_against_one(classes: int) -> np.ndarray:
    """An output per pair of classes: 1 for the first, -1 for the second, 0 for all others."""
    pairs = [(a, b) for a in range(classes) for b in range(a + 1, classes)]
    signs = np.zeros((classes, len(pairs)))
    for k, (a, b) in enumerate(pairs):
        signs[a, k], signs[b, k] = 1, -1
    return signs


@dataclass(frozen=True)
class Machine:
    """A machine to fit: the fold whose rows it does not see (-1: it sees all), its regularisation, and its features.

    ``scale`` weighs the penalty of each feature (its deviation, where machines are fitted on standardised features).
    """

    fold: int
    reg: float
    features: Map = plain
    scale: np.ndarray | None = None


def hinge(margins: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Loss of every row and its slope: the hinge with a rounded corner, summed over outputs that know the row's class."""
    z = 1 - signs * margins
    bend = np.clip(z, 0, CORNER)
    loss = np.where(signs != 0, bend * bend / (2 * CORNER) + np.maximum(z - CORNER, 0), 0.0)
    return loss.sum(axis=1), -signs * bend / CORNER


def log_loss(margins: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Negative log likelihood and its slope: logistic for one output, multinomial for several."""
    if margins.shape[1] == 1:
        z = signs * margins
        return np.logaddexp(0, -z)[:, 0], -signs / (1 + np.exp(np.clip(z, -500, 500)))
    hit = signs > 0
    top = margins.max(axis=1, keepdims=True)
    total = np.exp(margins - top).sum(axis=1, keepdims=True)
    shares = np.exp(margins - top) / total
    return (top + np.log(total))[:, 0] - margins[hit], shares - hit


LOSSES = {"hinge": hinge, "log": log_loss}


def _slices(batches: Iterator[pa.RecordBatch], width: int, by_class: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(x, y, fold) of a few rows at a time; ``by_class`` sorts the rows of a batch by their class."""
    for batch in batches:
        if by_class:
            batch = batch.take(pa.array(np.argsort(batch.column("y").to_numpy(), kind="stable")))
        step = max(1, CELLS // max(1, width))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
            yield x, part.column("y").to_numpy(), part.column("fold").to_numpy()


class Held:
    """Batches of a few rows that a task holds, in place of a DataFrame."""

    def __init__(self, batches: list[pa.RecordBatch]):
        self.batches = batches


class Kept:
    """A value in place of a broadcast of it."""

    def __init__(self, value):
        self.value = value

    def unpersist(self) -> None:
        pass


def drop_shuffles(done: DataFrame) -> None:
    """Delete the shuffle files of a query that has run: else those of all passes stay until the driver collects its garbage."""
    plan, cleaner = done._jdf.queryExecution().executedPlan(), done.sparkSession.sparkContext._jsc.sc().cleaner()
    if cleaner.isDefined() and plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        for shuffle in list(plan.context().shuffleIds().keySet()):
            cleaner.get().doCleanupShuffle(shuffle, False)


def totals_of(rows: DataFrame, per_task, width: int, tasks: int | None = None) -> np.ndarray:
    """The sum over all tasks of the vector that ``per_task`` makes of its batches.

    ``tasks`` is the number of partitions of ``rows``, for callers of many passes: finding it out plans a query.
    """

    if isinstance(rows, Held):
        sums = per_task(iter(rows.batches))
        return np.zeros(width) if sums is None else sums

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = per_task(batches)
        if sums is not None:
            yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], names=["sums"])

    def added(key: tuple[pa.Scalar, ...], parts: pa.Table) -> pa.Table:
        total = np.zeros(width)
        for part in parts.sort_by("task").column("sums"):  # in a fixed order, so that repeated passes agree
            total += np.frombuffer(part.as_buffer(), np.float64)
        return pa.table({"task": pa.array([key[0].as_py()], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})

    def in_groups(sums: DataFrame, groups: int) -> DataFrame:
        return sums.groupBy(F.pmod("task", F.lit(groups)).alias("part")).applyInArrow(added, "task int, sums binary")

    tasks = tasks or rows.rdd.getNumPartitions()
    out = rows.mapInArrow(work, "sums binary").withColumn("task", F.spark_partition_id())
    # one vector reaches the driver, however many tasks there are
    if tasks > DIRECT:
        out = in_groups(out, max(2, math.isqrt(tasks)))
    if tasks > 1:
        out = in_groups(out, 1)
    out = out.select("sums")
    parts = [np.frombuffer(p, np.float64) for p in out.toArrow().column("sums").to_pylist()]
    if tasks > 1:
        drop_shuffles(out)
    return np.sum(parts, axis=0) if parts else np.zeros(width)


def fit_machines(
    rows: DataFrame, machines: list[Machine], signs: np.ndarray, loss: str = "hinge", max_iter: int = 100, tol: float = 1e-4
) -> list[np.ndarray]:
    """Weights of every machine: outputs by features, the intercept last.

    ``rows`` has ``x`` (array), ``y`` (int) and ``fold``, and is read once per pass; keep it cached. A machine minimises
    the mean loss of its rows plus reg / 2 times the squared weights (not the intercepts). One pass sums losses and
    slopes of all machines, each at its own point; tasks send sums only, whose size depends on the machines, not on the
    rows. On the driver every machine takes its own quasi-Newton (L-BFGS) step or a shorter one if its loss did not
    fall enough. A machine is done when three steps in a row lower its loss by no more than ``tol`` of it (or of a hundredth
    of the first loss), and drops out of later passes. Those that ``max_iter`` steps leave unfinished are told
    in a warning.
    """
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).first() if machines else None
    if not machines:
        return []
    args = (signs, loss, max_iter, tol)
    if size.n and size.n * size.d <= HELD_VALUES:
        fitted = _fit_held(rows, machines, *args)
    else:
        fitted = _fit(rows, machines, size.d or 0, *args, rows.rdd.getNumPartitions(), rows.sparkSession.sparkContext.broadcast)
    for left in fitted[1]:
        warnings.warn(f"a linear machine took {max_iter} steps and is not done (slope {left:.1e})", stacklevel=2)
    return fitted[0]


def _fit_held(rows: DataFrame, machines: list[Machine], signs, loss: str, max_iter: int, tol: float) -> tuple[list[np.ndarray], list[float]]:
    """Machines of few rows: each is fitted by one task that holds the rows, without a pass of the cluster per step."""
    context = rows.sparkSession.sparkContext
    table = rows.select("x", "y", "fold").toArrow().combine_chunks()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    shared = context.broadcast((sink.getvalue().to_pybytes(), machines, signs))

    def fit(i: int) -> tuple[list[np.ndarray], list[float]]:
        stream, machines, signs = shared.value
        held = Held(pa.ipc.open_stream(stream).read_all().combine_chunks().to_batches())
        dims = len(held.batches[0].column("x")[0])
        return _fit(held, [machines[i]], dims, signs, loss, max_iter, tol, 1, Kept)

    done = context.parallelize(range(len(machines)), len(machines)).map(fit).collect()
    shared.unpersist()
    return [w for one, _ in done for w in one], [v for _, left in done for v in left]


def _fit(rows, machines: list[Machine], width: int, signs, loss: str, max_iter: int, tol: float, tasks: int, share) -> tuple[list[np.ndarray], list[float]]:
    """Weights of the machines, and the slopes of those that ``max_iter`` steps leave unfinished."""
    n_out, unfinished = signs.shape[1], []
    dims = len(machines[0].features(np.zeros((1, width)))[0]) + 1
    shape = (n_out, dims)
    size = n_out * dims
    weight = np.array([np.append(np.ones(dims - 1) if m.scale is None else np.where(m.scale > 0, m.scale, 1.0), 1.0) for m in machines])
    reg = np.array([m.reg for m in machines])
    penalised = np.append(np.ones(dims - 1), 0.0)
    point = np.zeros((len(machines), *shape))
    todo = list(range(len(machines)))

    def at_once(points: np.ndarray, which: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Losses and slopes of machines at their points."""
        asked = [(machines[i].fold, machines[i].features) for i in which]
        shared = share((points / weight[which][:, None, :], asked, signs))
        slope_of = LOSSES[loss]

        def per_task(batches):
            w, asked, signs = shared.value
            values, slopes, n = np.zeros(len(asked)), np.zeros(w.shape), np.zeros(len(asked))
            seen = False
            # a row only moves the outputs that know its class
            knows = [np.flatnonzero(row) for row in signs] if (signs == 0).any() else None
            width = max(w.shape[1] * len(asked) + 2 * w.shape[2], w.shape[2] * (CELLS // WIDE_CELLS))
            for x, y, fold in _slices(batches, width, knows is not None):
                seen = True
                made = {}
                for k, (out, features) in enumerate(asked):
                    made.setdefault((out, id(features)), []).append(k)
                for (out, _), ks in made.items():
                    use = fold != out
                    mapped, label = asked[ks[0]][1](x[use]), y[use]
                    n[ks] += len(mapped)
                    for c in np.unique(label) if knows else [None]:
                        some, its, outputs = (mapped, label, np.arange(w.shape[1])) if c is None else (mapped[label == c], label[label == c], knows[c])
                        here = w[np.ix_(ks, outputs)].reshape(-1, w.shape[2])
                        margins = some @ here[:, :-1].T + here[:, -1]
                        slope = np.empty_like(margins)
                        for j, k in enumerate(ks):
                            part = slice(j * len(outputs), (j + 1) * len(outputs))
                            value, slope[:, part] = slope_of(margins[:, part], signs[its][:, outputs])
                            values[k] += value.sum()
                        at = np.ix_(ks, outputs)
                        slopes[(*at, slice(-1))] += (slope.T @ some).reshape(len(ks), len(outputs), -1)
                        slopes[(*at, -1)] += slope.sum(axis=0).reshape(len(ks), -1)
            return np.concatenate([values, n, slopes.ravel()]) if seen else None

        k = len(which)
        sums = totals_of(rows, per_task, 2 * k + k * size, tasks)
        shared.unpersist()
        n = np.maximum(sums[k : 2 * k], 1)
        slopes = sums[2 * k :].reshape(k, *shape) / n[:, None, None] / weight[which][:, None, :]
        values = sums[:k] / n + 0.5 * reg[which] * ((points * penalised) ** 2).sum(axis=(1, 2))
        return values, slopes + reg[which][:, None, None] * points * penalised

    value, slope = at_once(point, todo)
    begun = value.copy()
    memory: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in machines]
    step, small, taken = np.ones(len(machines)), np.zeros(len(machines), int), np.zeros(len(machines), int)
    grown = np.zeros(len(machines), int)
    way = np.array([_direction(g, []) for g in slope])
    while todo:
        trial = point[todo] + step[todo][:, None, None] * way[todo]
        values, slopes = at_once(trial, todo)
        left = []
        for k, i in enumerate(todo):
            fall = float((slope[i] * way[i]).sum())
            if not values[k] <= value[i] + 1e-4 * step[i] * fall:
                step[i] *= 0.5 if not np.isfinite(values[k]) else float(np.clip(-0.5 * step[i] * fall / max(values[k] - value[i] - step[i] * fall, 1e-300), 0.1, 0.5))
                if step[i] > 1e-10:
                    left.append(i)
                continue
            if not memory[i] and grown[i] < 8 and step[i] >= 1 and (slopes[k] * way[i]).sum() < 0.5 * fall:
                step[i], grown[i] = 3 * step[i], grown[i] + 1  # the first step has no measure of length: it grows while it pays
                left.append(i)
                continue
            s, g = (trial[k] - point[i]).ravel(), (slopes[k] - slope[i]).ravel()
            if s @ g > 1e-12 * (g @ g):
                memory[i] = [*memory[i], (s, g)][-HISTORY:]
            small[i] = small[i] + 1 if value[i] - values[k] <= tol * max(abs(value[i]), 0.01 * begun[i]) else 0
            point[i], value[i], slope[i] = trial[k], values[k], slopes[k]
            step[i], taken[i] = 1.0, taken[i] + 1
            way[i] = _direction(slope[i], memory[i])
            if small[i] < 3 and np.abs(slope[i]).max() > tol * 0.01 and taken[i] < max_iter:
                left.append(i)
            elif taken[i] >= max_iter:
                unfinished.append(float(np.abs(slope[i]).max()))
        todo = left
    return list(point / weight[:, None, :]), unfinished


def _direction(slope: np.ndarray, memory: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The quasi-Newton direction from the last corrections (two-loop recursion)."""
    q = slope.ravel().copy()
    held = []
    for s, g in reversed(memory):
        rho = 1 / (s @ g)
        a = rho * (s @ q)
        q -= a * g
        held.append((rho, a, s, g))
    if memory:
        s, g = memory[-1]
        q *= (s @ g) / (g @ g)
    else:
        q /= max(1.0, np.sqrt(q @ q))
    for rho, a, s, g in reversed(held):
        q += (a - rho * (g @ q)) * s
    return -q.reshape(slope.shape)


def decided(margins: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """The class of every row: the side of one output, the highest of one-against-rest, the most wins of pairs.

    Equal wins are told apart by the sum of margins, equal sums by the smaller class.
    """
    if margins.shape[1] == 1:
        return (margins[:, 0] * signs[1, 0] > 0).astype(np.int64)
    if (signs != 0).all():
        return margins.argmax(axis=1)
    wins = (np.sign(margins) @ signs.T) + np.tanh(margins @ signs.T / margins.shape[1]) * 0.5
    return wins.argmax(axis=1)


def held_out_counts(rows: DataFrame, machines: list[Machine], weights: list[np.ndarray], signs: np.ndarray) -> np.ndarray:
    """Confusion counts (machine, class, predicted class) of the rows of each machine's fold, in one pass."""
    classes = len(signs)
    shared = rows.sparkSession.sparkContext.broadcast(([(m.fold, m.features) for m in machines], weights, signs))

    def per_task(batches):
        asked, weights, signs = shared.value
        counts = np.zeros((len(asked), classes, classes))
        for x, y, fold in _slices(batches, weights[0].size * 2):
            for k, ((out, features), w) in enumerate(zip(asked, weights)):
                use = fold == out
                if use.any():
                    found = decided(features(x[use]) @ w[:, :-1].T + w[:, -1], signs)
                    np.add.at(counts[k], (y[use], found), 1)
        return counts.ravel()

    sums = totals_of(rows, per_task, len(machines) * classes * classes)
    shared.unpersist()
    return sums.reshape(len(machines), classes, classes)


def moments(rows: DataFrame, folds: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per fold, of the rows outside it (-1: of all rows): count, mean and sample deviation of every feature."""
    first = rows.select(F.size("x")).first()
    dims = first[0] if first else 0

    def per_task(batches):
        sums = np.zeros((len(folds), 2 * dims + 1))
        for x, _, fold in _slices(batches, 2 * dims):
            for k, out in enumerate(folds):
                part = x[fold != out]
                sums[k] += np.concatenate([[len(part)], part.sum(axis=0), (part**2).sum(axis=0)])
        return sums.ravel()

    sums = totals_of(rows, per_task, len(folds) * (2 * dims + 1)).reshape(len(folds), -1)
    n, total, square = sums[:, :1], sums[:, 1 : dims + 1], sums[:, dims + 1 :]
    mean = total / np.maximum(n, 1)
    spread = np.maximum(square - n * mean**2, 0) / np.maximum(n - 1, 1)
    return n[:, 0], mean, np.sqrt(np.where(spread > 1e-12 * np.abs(square / np.maximum(n, 1)), spread, 0))
