"""Quality of texts by a generalised additive model with pairwise interactions, boosted cyclically from shallow trees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbalis.llm.common import fold, lean, short_batches, small_batches
from verbalis.llm.texthash import words_of
from verbalis.session import Workspace

#: Labelled rows that a model is fitted on, at most: those whose hashed id comes first. Scoring knows no such bound.
FIT_ROWS = 20_000
FEATURES = (
    "log_bytes",
    "log_words",
    "word_bytes",
    "upper",
    "digits",
    "stops",
    "symbols",
    "shouts",
    "bars",
    "beyond_ascii",
    "line_words",
    "repeated_neighbours",
    "distinct_words",
    "words_ending_in_symbols",
    "upper_words",
    "repeated_lines",
    "log_longest_word",
    "largest_word_share",
)


def _classes(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_UPPER, _LETTERS = _classes("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), np.zeros(256, bool)
_LETTERS[65:91] = _LETTERS[97:123] = True
_LETTERS[128:] = True
_KINDS = {
    "digits": _classes("0123456789"),
    "stops": _classes(".,;:?"),
    "symbols": _classes("#$%&*@^~_=+<>{}[]\\"),
    "shouts": _classes("!"),
    "bars": _classes("|"),
}


def text_features(texts: list[bytes]) -> np.ndarray:
    """One row of ``FEATURES`` per text; a text without words has zeros where a share has no base."""
    n = len(texts)
    w = words_of(texts, lower=False)
    size = np.fromiter(map(len, texts), np.int64, n)

    def total(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return (sums[w.text_starts + size] - sums[w.text_starts]).astype(float)

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return np.divide(part, whole, out=np.zeros(n), where=whole > 0)

    words = np.bincount(w.text, minlength=n).astype(float)
    length = w.end - w.start
    upper = total(_UPPER[w.data])
    letters = total(_LETTERS[w.data])
    lines = total(w.data == 10) + 1
    same = np.zeros(len(w.hash), bool)
    same[1:] = (w.hash[1:] == w.hash[:-1]) & (w.text[1:] == w.text[:-1])
    order = np.lexsort((w.hash, w.text))
    text, value = w.text[order], w.hash[order]
    new = np.ones(len(order), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    distinct = np.bincount(text[new], minlength=n).astype(float)
    at = np.flatnonzero(new)
    runs = np.diff(np.concatenate([at, [len(order)]]))
    most, longest = np.zeros(n), np.zeros(n)
    np.maximum.at(most, text[at], runs)
    np.maximum.at(longest, w.text, length)
    last = w.data[w.end - 1]
    marks = _KINDS["symbols"] | _KINDS["shouts"] | _KINDS["bars"]
    ending = np.bincount(w.text[marks[last]], minlength=n)
    capital = _UPPER[w.data[w.start]] & (length > 1)
    capital[capital] = _UPPER[w.data[w.start[capital] + 1]]
    shouted = np.bincount(w.text[capital], minlength=n)
    line_counts = [t.split(b"\n") if b"\n" in t else None for t in texts]
    twice = np.array([1 - len(set(x)) / len(x) if x else 0.0 for x in line_counts])
    columns = [
        np.log1p(size),
        np.log1p(words),
        share(np.bincount(w.text, length, n), words),
        share(upper, letters),
        *(share(total(mask[w.data]), size.astype(float)) for mask in _KINDS.values()),
        share(total(w.data >= 128), size.astype(float)),
        share(words, lines),
        share(np.bincount(w.text[same], minlength=n), words),
        # type-token ratios fall with length; the exponent keeps texts of all lengths comparable
        share(distinct, words**0.9),
        share(ending, words),
        share(shouted, words),
        twice,
        np.log1p(longest),
        share(most, words),
    ]
    return np.stack(columns, axis=1)


@dataclass
class AdditiveModel:
    """Bin edges and lookup tables: a table per feature, and one per interacting pair over coarser bins."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            out += table[np.searchsorted(edges, x[:, j], "right")]
        if self.pairs:
            bins = [np.searchsorted(edges, x[:, j], "right") for j, edges in enumerate(self.coarse)]
            for (a, b), table in zip(self.pairs, self.pair_tables):
                out += table[bins[a], bins[b]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between quantiles of the distinct values."""
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _leaf(g, h, l2):
    return g / (h + l2)


def _gain(g, h, l2):
    return g * g / (h + l2)


def _tree(grad: np.ndarray, hess: np.ndarray, leaves: int, l2: float, least: float) -> np.ndarray:
    """A tree of a few leaves over one feature's bins, as its value for every bin. Splits are found best first."""
    g, h = np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(hess)])
    parts = [(0, len(grad))]

    def best(part):
        a, b = part
        cut = np.arange(a + 1, b)
        if not len(cut):
            return 0.0, None
        gl, hl, gr, hr = g[cut] - g[a], h[cut] - h[a], g[b] - g[cut], h[b] - h[cut]
        gain = _gain(gl, hl, l2) + _gain(gr, hr, l2) - _gain(g[b] - g[a], h[b] - h[a], l2)
        gain[(hl < least) | (hr < least)] = 0
        k = int(gain.argmax())
        return float(gain[k]), int(cut[k])

    found = {p: best(p) for p in parts}
    while len(found) < leaves:
        part, (gain, cut) = max(found.items(), key=lambda x: x[1][0])
        if cut is None or gain <= 1e-9:
            break
        del found[part]
        for p in ((part[0], cut), (cut, part[1])):
            found[p] = best(p)
    out = np.zeros(len(grad))
    for a, b in found:
        out[a:b] = _leaf(g[b] - g[a], h[b] - h[a], l2)
    return out


def _pair_tree(grad: np.ndarray, hess: np.ndarray, l2: float, least: float) -> tuple[np.ndarray, float]:
    """A cut of one feature, then one of the other on either side: its value for every pair of bins, and its gain."""
    best, value = 0.0, np.zeros_like(grad)
    for turned in (False, True):
        g, h = (grad.T, hess.T) if turned else (grad, hess)
        gs, hs = (np.cumsum(np.pad(x, ((1, 0), (1, 0))), axis=0).cumsum(axis=1) for x in (g, h))
        for cut in range(1, len(g)):
            gain, table = 0.0, np.zeros_like(g)
            for a, b in ((0, cut), (cut, len(g))):
                gl, hl = gs[b] - gs[a], hs[b] - hs[a]
                gr, hr = gl[-1] - gl, hl[-1] - hl
                gains = _gain(gl, hl, l2) + _gain(gr, hr, l2)
                gains[(hl < least) | (hr < least)] = -1
                k = int(gains[1:-1].argmax()) + 1 if len(gains) > 2 else 0
                if len(gains) > 2 and gains[k] >= 0:
                    gain += gains[k]
                    table[a:b, :k], table[a:b, k:] = _leaf(gl[k], hl[k], l2), _leaf(gr[k], hr[k], l2)
                else:
                    gain += _gain(gl[-1], hl[-1], l2)
                    table[a:b] = _leaf(gl[-1], hl[-1], l2)
            if gain > best:
                best, value = gain, table.T if turned else table
    return value, best


def fit_additive(
    x: np.ndarray,
    y: np.ndarray,
    bins: int = 64,
    coarse_bins: int = 8,
    rounds: int = 150,
    rate: float = 0.1,
    leaves: int = 4,
    n_pairs: int = 10,
    pair_rounds: int = 60,
    l2: float = 1.0,
    least: float = 1.0,
) -> AdditiveModel:
    """Boost one feature after the other, round by round; then the pairs that explain most of what is left.

    With no rows the score is 0.5 everywhere; with one label only, close to that label.
    """
    model = AdditiveModel()
    if not len(y):
        return model
    share = (y.sum() + 0.5) / (len(y) + 1)
    model.base = float(np.log(share / (1 - share)))
    d = x.shape[1]
    model.edges = [_edges(x[:, j], bins) for j in range(d)]
    model.coarse = [_edges(x[:, j], coarse_bins) for j in range(d)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    binned = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.edges)]
    margin = np.full(len(y), model.base)

    def slopes():
        p = 1 / (1 + np.exp(-np.clip(margin, -40, 40)))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j in range(d):
            size = len(model.tables[j])
            g, h = slopes()
            step = rate * _tree(np.bincount(binned[j], g, size), np.bincount(binned[j], h, size), leaves, l2, least)
            model.tables[j] += step
            margin += step[binned[j]]
    rough = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.coarse)]
    sizes = [len(e) + 1 for e in model.coarse]

    def grids(a, b, g, h):
        cell = rough[a] * sizes[b] + rough[b]
        return (np.bincount(cell, v, sizes[a] * sizes[b]).reshape(sizes[a], sizes[b]) for v in (g, h))

    g, h = slopes()
    gains = [(_pair_tree(*grids(a, b, g, h), l2, least)[1], a, b) for a in range(d) for b in range(a)]
    model.pairs = [(a, b) for gain, a, b in sorted(gains, reverse=True)[:n_pairs] if gain > 0]
    model.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for k, (a, b) in enumerate(model.pairs):
            step = rate * _pair_tree(*grids(a, b, *slopes()), l2, least)[0]
            model.pair_tables[k] += step
            margin += step[rough[a], rough[b]]
    return model


def featured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and an array of features of every text; null is empty. One narrow pass over whole texts."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in small_batches(batches, "text", 1 << 18):
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            values = pa.array(text_features(texts).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * len(FEATURES), pa.int32()), values)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "features"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(measure, f"doc_id {id_type}, features array<double>")


def labels_for(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """One 0/1 label per id: rows without id or label are left out, and the smaller of several labels counts."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    return known.groupBy(F.col(id_col).alias("doc_id")).agg(F.min(label_col).cast("double").alias("label"))


def learn_quality(features: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, **settings) -> AdditiveModel:
    """A model of the labelled rows outside the held-out fold, from at most ``fit_rows`` of them."""
    train = features.join(labels, "doc_id").filter(fold(F.col("doc_id")) != 0)
    drawn = train.orderBy(F.xxhash64("doc_id"), "doc_id", "features").limit(fit_rows).select("features", "label").toArrow()
    x = drawn.column("features").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
    return fit_additive(x, drawn.column("label").to_numpy(), **settings)


def scored(features: DataFrame, model: AdditiveModel) -> DataFrame:
    """``doc_id, score``: bins are looked up and table entries added, for a batch of rows at a time."""
    id_type = features.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in batches:
            values = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            names = ["doc_id", "score"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(values))], names=names)

    return features.mapInArrow(score, f"doc_id {id_type}, score double")


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    space: Workspace,
    label_col: str = "quality",
    threshold: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Labels are learned only from rows outside the held-out fold (crc32 of the id modulo 5 is 0); a score depends on the
    text alone. Null and empty texts have a score like any other. A null id is never labelled. Rows that repeat an id
    are rows of their own. Without labels every score is 0.5. Empty tables give an empty result.
    """
    with short_batches(docs.sparkSession):
        features = space.keep(featured(docs, id_col, text_col), "features")
    model = learn_quality(features, labels_for(labels, id_col, label_col), fit_rows)
    out = scored(features, model)
    return out.select(
        F.col("doc_id").alias(id_col),
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def good_texts(docs: DataFrame, labels: DataFrame, space: Workspace, threshold: float = 0.3, **names) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, with their columns as they are.

    The model is learned first; then every text is measured and scored in one narrow pass, so no text is shuffled.
    """
    id_col, text_col = names.get("id_col", "doc_id"), names.get("text_col", "text")
    known = labels_for(labels, id_col, names.get("label_col", "quality"))
    fit_rows = names.get("fit_rows", FIT_ROWS)
    train = docs.filter(fold(F.col(id_col)) != 0).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    drawn = train.select("_id").join(known.select(F.col("doc_id").alias("_id")), "_id", "left_semi").distinct()
    drawn = space.keep(drawn.orderBy(F.xxhash64("_id"), "_id").limit(fit_rows), "drawn_ids")  # ids alone are sorted
    texts = train.join(F.broadcast(drawn), "_id", "left_semi")
    with short_batches(docs.sparkSession):
        features = space.keep(featured(texts, "_id", "_text"), "drawn_features")
    model = learn_quality(features, known, fit_rows)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in small_batches(batches, text_col, 1 << 18):
            texts = [(t or "").encode() for t in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array(model.score(text_features(texts)) >= threshold))

    return docs.mapInArrow(keep, docs.schema)
