"""SAMME.R boosting of many models at once by shared histograms: all folds and settings share each pass over the rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbalis.learners.machines import HELD_VALUES, Held, Kept, totals_of
from verbalis.session import Workspace

#: Bins of a feature, quantiles of a task's summary of a feature, rounds between two kept tables of weights.
BINS, SUMMARY, KEEP_EVERY = 32, 256, 20
#: (node, feature, bin, class) sums of one pass.
SLOTS = 4_000_000
TINY = float(np.finfo(np.float64).eps)


@dataclass
class Booster:
    """One model to fit: the fold it does not see (-1: it sees all), and its settings."""

    fold: int = -1
    rounds: int = 200
    rate: float = 0.5
    depth: int = 2
    max_features: int = 0
    min_split: int = 2
    min_leaf: int = 1
    seed: int = 5
    trees: list[dict] = field(default_factory=list)
    shift: float = 0.0
    done: bool = False


def _summary(values: np.ndarray) -> np.ndarray:
    """Up to SUMMARY values that stand for all: half of them evenly by rank, half evenly among the different values.

    The second half keeps apart the few values above zero of a feature that is zero nearly everywhere.
    """
    half = SUMMARY // 2
    picks = [np.quantile(v, np.linspace(0, 1, half), method="nearest") for v in (values, np.unique(values))]
    return np.concatenate(picks)


def feature_cuts(rows: DataFrame, bins: int = BINS) -> list[np.ndarray]:
    """Rising cut points per feature, from summaries of every task that are merged feature by feature."""

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                parts = [pa.array([_summary(c).tobytes() for c in x.T], pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array(range(x.shape[1]), pa.int32()), *parts], names=["feature", "part"])

    def merged(key: tuple[pa.Scalar, ...], parts: pa.Table) -> pa.Table:
        values = np.concatenate([np.frombuffer(p, np.float64) for p in parts.column("part").to_pylist()])
        different = np.unique(values)
        if len(different) <= bins:
            cuts = (different[1:] + different[:-1]) / 2
        else:
            cuts = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="nearest"))
        return pa.table({"feature": [key[0].as_py()], "cuts": pa.array([cuts.tolist()], pa.list_(pa.float64()))}).cast(
            pa.schema([("feature", pa.int32()), ("cuts", pa.list_(pa.float64()))])
        )

    made = rows.select("x").mapInArrow(summarise, "feature int, part binary")
    found = made.groupBy("feature").applyInArrow(merged, "feature int, cuts array<double>").collect()
    return [np.array(r.cuts) for r in sorted(found, key=lambda r: r.feature)]


def _blank(counts: np.ndarray | None = None) -> dict:
    return {"feature": [-1], "bin": [0], "left": [-1], "right": [-1], "counts": [counts], "size": [None]}


def _node_of(tree: dict, codes: np.ndarray) -> np.ndarray:
    """The node of every row, down to where the tree has grown so far."""
    feature, cut, left, right = (np.asarray(tree[k]) for k in ("feature", "bin", "left", "right"))
    node, rows = np.zeros(len(codes), np.int64), np.arange(len(codes))
    while True:
        inner = np.flatnonzero(feature[node] >= 0)
        if not len(inner):
            return node
        at = node[inner]
        node[inner] = np.where(codes[rows[inner], feature[at]] <= cut[at], left[at], right[at])


def _gain(tree: dict, logs: np.ndarray, codes: np.ndarray, y: np.ndarray, step: float) -> np.ndarray:
    """What a finished tree adds to the logarithms of the rows' weights."""
    shares = logs[_node_of(tree, codes)]
    true = shares[np.arange(len(y)), y]
    return -step * (true - (shares.sum(axis=1) - true) / max(1, shares.shape[1] - 1))


def _shares(tree: dict) -> np.ndarray:
    counts = np.array(tree["counts"])
    return counts / np.maximum(counts.sum(axis=1, keepdims=True), TINY)


def boost(rows: DataFrame, boosters: list[Booster], classes: int) -> list[list[dict]]:
    """Trees of every booster, with real thresholds. ``rows`` has ``x`` (array), ``y`` (int) and ``fold``.

    Features are cut once; rows then hold a byte per feature and a log weight per booster. Per level of a round, one pass
    sums weights by (booster, node, feature, bin, class) for the open nodes of all boosters; the driver chooses splits
    from the sums, whose size does not depend on the rows. A row's weights follow from the trees since the table was last
    kept, which happens every KEEP_EVERY rounds in the shared folder. A booster ends early when it fits its rows fully.
    """
    cuts = feature_cuts(rows)
    context, rows = rows.sparkSession.sparkContext, rows.select("x", "y", "fold")
    if rows.count() * len(cuts) <= HELD_VALUES:
        return _boost_held(rows, boosters, classes, cuts)
    space = Workspace(rows.sparkSession)
    shared_cuts = context.broadcast(cuts)
    n = len(boosters)
    table = rows.mapInArrow(lambda batches: _coded(batches, shared_cuts.value, n), CODED)
    kept = "weights_0"
    table = space.keep(table, kept).persist(StorageLevel.MEMORY_AND_DISK)

    def moved(table: DataFrame, pending: list[list[dict]], round_: int) -> DataFrame:
        nonlocal kept
        steps, name = _steps(boosters, pending, classes), f"weights_{round_}"
        made = space.keep(table.mapInArrow(lambda batches: _moved(batches, steps), CODED), name).persist(StorageLevel.MEMORY_AND_DISK)
        made.count()
        table.unpersist()
        space.drop(kept)
        kept = name
        return made

    table = _boost(table, boosters, classes, cuts, moved)
    table.unpersist()
    shared_cuts.unpersist()
    space.drop()
    return [b.trees for b in boosters]


def _boost_held(rows: DataFrame, boosters: list[Booster], classes: int, cuts: list[np.ndarray]) -> list[list[dict]]:
    """Trees of boosters of few rows: each is grown by one task that holds the rows, without a pass of the cluster per level."""
    context = rows.sparkSession.sparkContext
    table = pa.Table.from_batches(_coded(rows.toArrow().combine_chunks().to_batches(), cuts, 1)).combine_chunks()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    shared = context.broadcast((sink.getvalue().to_pybytes(), boosters, cuts))

    def grown(i: int) -> list[dict]:
        stream, boosters, cuts = shared.value
        held, one = Held(pa.ipc.open_stream(stream).read_all().to_batches()), [replace(boosters[i], trees=[], shift=0.0, done=False)]
        _boost(held, one, classes, cuts, lambda table, pending, _: Held(list(_moved(table.batches, _steps(one, pending, classes)))))
        return one[0].trees

    out = context.parallelize(range(len(boosters)), max(1, len(boosters))).map(grown).collect()
    shared.unpersist()
    return out


CODED = "codes binary, y int, fold int, logs binary"


def _coded(batches: Iterator[pa.RecordBatch], cuts: list[np.ndarray], boosters: int) -> Iterator[pa.RecordBatch]:
    """Rows with a byte per feature and a log weight per booster."""
    for batch in batches:
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        codes = np.empty(x.shape, np.uint8)
        for f, c in enumerate(cuts):
            codes[:, f] = np.searchsorted(c, x[:, f], "left")
        stored = pa.array([r.tobytes() for r in codes], pa.binary())
        none = pa.array([np.zeros(boosters).tobytes()] * batch.num_rows, pa.binary())
        yield pa.RecordBatch.from_arrays([stored, batch.column("y"), batch.column("fold"), none], names=["codes", "y", "fold", "logs"])


def _boost(table: DataFrame | Held, boosters: list[Booster], classes: int, cuts: list[np.ndarray], moved) -> DataFrame | Held:
    """Grow the trees of all boosters; the table as it was last kept by ``moved``."""
    tasks_of = lambda t: 1 if isinstance(t, Held) else t.rdd.getNumPartitions()
    dims, tasks = len(cuts), tasks_of(table)
    pending: list[list[dict]] = [[] for _ in boosters]
    rngs = [np.random.default_rng(b.seed) for b in boosters]
    for round_ in range(max((b.rounds for b in boosters), default=0)):
        alive = [k for k, b in enumerate(boosters) if not b.done and round_ < b.rounds]
        if not alive:
            break
        growing = {k: _blank() for k in alive}
        open_nodes = [(k, 0, 0) for k in alive]  # booster, node, depth
        while open_nodes:
            children = []
            for part, picks in _portions(open_nodes, boosters, rngs, dims, classes):
                sums = _histograms(table, boosters, pending, growing, part, picks, classes, tasks)
                for i, (k, node, depth) in enumerate(part):
                    children += [(k, *c) for c in _split(boosters[k], growing[k], node, depth, picks[i], *sums[i])]
            open_nodes = children
        for k in alive:
            tree, b = growing[k], boosters[k]
            leaves = [c for c, f in zip(tree["counts"], tree["feature"]) if f < 0]
            b.done = all(c.sum() - c.max() <= 0 for c in leaves)
            b.shift += float(np.log(max(tree["counts"][0].sum() / max(1.0, tree["size"][0]), 1e-300)))
            b.trees.append({**{n: tree[n] for n in ("feature", "left", "right")}, "threshold": [
                float(cuts[f][c]) if f >= 0 else 0.0 for f, c in zip(tree["feature"], tree["bin"])
            ], "shares": _shares(tree).tolist()})
            pending[k].append(tree)
        if (round_ + 1) % KEEP_EVERY == 0:
            table, pending = moved(table, pending, round_ + 1), [[] for _ in boosters]
            tasks = tasks_of(table)
    return table


def _steps(boosters: list[Booster], pending: list[list[dict]], classes: int) -> list[tuple[float, list[tuple[dict, np.ndarray]]]]:
    """Per booster its step and its trees since the table was kept, with the logarithms of their shares."""
    return [
        (b.rate * (classes - 1) / classes, [({n: t[n] for n in ("feature", "bin", "left", "right")}, np.log(np.maximum(_shares(t), TINY))) for t in trees])
        for b, trees in zip(boosters, pending)
    ]


def _moved(batches: Iterator[pa.RecordBatch], steps: list) -> Iterator[pa.RecordBatch]:
    """Rows with their log weights brought up to date."""
    for batch in batches:
        codes, y, _, logs = _columns(batch)
        logs = logs.copy()
        for k, (step, trees) in enumerate(steps):
            for tree, shares in trees:
                logs[:, k] += _gain(tree, shares, codes, y, step)
        stored = pa.array([r.tobytes() for r in logs], pa.binary())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("codes", "y", "fold")), stored], names=["codes", "y", "fold", "logs"])


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
    logs = np.frombuffer(b"".join(batch.column("logs").to_pylist()), np.float64).reshape(batch.num_rows, -1)
    return codes, batch.column("y").to_numpy(), batch.column("fold").to_numpy(), logs


def _portions(nodes, boosters, rngs, dims, classes):
    """Open nodes with their candidate features, in portions of bounded sums."""
    part, picks, size = [], [], 0
    for k, node, depth in nodes:
        wanted = min(dims, boosters[k].max_features or dims)
        pick = np.arange(dims) if wanted == dims else np.sort(rngs[k].choice(dims, wanted, replace=False))
        cost = wanted * BINS * classes * 2
        if part and size + cost > SLOTS:
            yield part, picks
            part, picks, size = [], [], 0
        part.append((k, node, depth))
        picks.append(pick)
        size += cost
    if part:
        yield part, picks


def _histograms(table, boosters, pending, growing, part, picks, classes, tasks) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per open node: weights and counts of rows by (candidate feature, bin, class)."""
    steps = _steps(boosters, pending, classes)
    by_booster: dict[int, list[int]] = {}
    for i, (k, _, _) in enumerate(part):
        by_booster.setdefault(k, []).append(i)
    asked = [
        (k, boosters[k].fold, boosters[k].shift, {n: growing[k][n] for n in ("feature", "bin", "left", "right")}, [(part[i][1], i) for i in at])
        for k, at in by_booster.items()
    ]
    starts = np.cumsum([0, *[len(p) * BINS * classes for p in picks]])
    share = Kept if isinstance(table, Held) else table.sparkSession.sparkContext.broadcast
    shared = share((steps, asked, picks, starts))

    def per_task(batches):
        steps, asked, picks, starts = shared.value
        weights, counts, seen = np.zeros(starts[-1]), np.zeros(starts[-1]), False
        for batch in batches:
            seen = True
            codes, y, fold, logs = _columns(batch)
            for k, out, shift, tree, nodes in asked:
                use = np.flatnonzero(fold != out)
                some, label = codes[use], y[use]
                log = logs[use, k] - shift
                step, trees = steps[k]
                for earlier, shares in trees:
                    log = log + _gain(earlier, shares, some, label, step)
                weight = np.exp(np.minimum(log, 500))
                at = _node_of(tree, some)
                order = np.argsort(at, kind="stable")
                for node, i in nodes:
                    low, high = np.searchsorted(at[order], [node, node + 1])
                    here = order[low:high]
                    if len(here):
                        cell = (np.arange(len(picks[i])) * BINS + some[here][:, picks[i]]) * classes + label[here][:, None]
                        size = len(picks[i]) * BINS * classes
                        weights[starts[i] : starts[i + 1]] += np.bincount(cell.ravel(), np.repeat(weight[here], len(picks[i])), size)
                        counts[starts[i] : starts[i + 1]] += np.bincount(cell.ravel(), minlength=size)
        return np.concatenate([weights, counts]) if seen else None

    sums = totals_of(table, per_task, 2 * int(starts[-1]), tasks)
    shared.unpersist()
    half = int(starts[-1])
    shape = lambda i: (len(picks[i]), BINS, classes)
    return [(sums[a:b].reshape(shape(i)), sums[half + a : half + b].reshape(shape(i))) for i, (a, b) in enumerate(zip(starts, starts[1:]))]


def _split(b: Booster, tree: dict, node: int, depth: int, pick: np.ndarray, weights: np.ndarray, counts: np.ndarray) -> list[tuple[int, int]]:
    """Split a node by the lowest weighted Gini impurity; its children, if they may be split further."""
    whole, size = weights[0].sum(axis=0), counts[0].sum(axis=0)
    if tree["counts"][node] is None:
        tree["counts"][node], tree["size"][node] = whole, float(size.sum())
    if depth >= b.depth or size.sum() < b.min_split or np.count_nonzero(size) < 2:
        return []
    left, left_n = np.cumsum(weights, axis=1)[:, :-1], np.cumsum(counts.sum(axis=2), axis=1)[:, :-1]
    right, right_n = whole - left, size.sum() - left_n
    valid = (left_n >= max(1, b.min_leaf)) & (right_n >= max(1, b.min_leaf))
    score = (left**2).sum(axis=2) / np.maximum(left.sum(axis=2), 1e-300) + (right**2).sum(axis=2) / np.maximum(right.sum(axis=2), 1e-300)
    score = np.where(valid, score, -np.inf)
    f, cut = np.unravel_index(int(score.argmax()), score.shape)
    if score[f, cut] <= (whole**2).sum() / max(whole.sum(), 1e-300) * (1 + 1e-12):
        return []
    tree["feature"][node], tree["bin"][node] = int(pick[f]), int(cut)
    out = []
    for side, kept, n in (("left", left[f, cut], left_n[f, cut]), ("right", np.maximum(right[f, cut], 0), right_n[f, cut])):
        tree[side][node] = len(tree["feature"])
        for name, value in (("feature", -1), ("bin", 0), ("left", -1), ("right", -1), ("counts", kept), ("size", float(n))):
            tree[name].append(value)
        out.append((tree[side][node], depth + 1))
    return [c for c in out if c[1] < b.depth]
