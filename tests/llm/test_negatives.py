"""Hard negatives against a comparison of all rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from verbalis.llm import negatives

FIELDS = "vec_id long, embedding array<double>, label int"


def score(a, b):
    n = max(len(a), len(b))
    a, b = ([math.floor(256 * x) for x in v] + [0] * (n - len(v)) for v in (a, b))
    return max(-(2**63 - 1), min(2**63 - 1, sum(x * y for x, y in zip(a, b))))


def brute(rows, every):
    good = [r for r in rows if r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    out = []
    for i, a in enumerate(good):
        if a[0] is None or a[0] % every:
            continue
        found = [(-score(a[1], b[1]), b[0] is None, b[0] or 0, b[0], b[2]) for j, b in enumerate(good) if j != i]
        found.sort(key=lambda x: x[:3])
        for p in [x for x in found if x[4] == a[2]][:5]:
            window = [x for x in found if x[4] != a[2] and 30 * -p[0] <= 100 * -x[0] <= 90 * -p[0]][:10]
            out += [(a[0], p[3], k + 1, x[3], -p[0], -x[0]) for k, x in enumerate(window)]
    return sorted(out, key=str)


def ours(docs, space, every):
    out = negatives.hard_negatives(docs, space, F.col("vec_id") % every == 0, halves=4)
    return sorted((tuple(r) for r in out.collect()), key=str)


def with_clashes(docs):
    for name in ("_key", "_id", "_label", "chunk", "slot", "rank", "_cell", "keys"):
        docs = docs.withColumn(name, F.lit("x"))
    return docs


@pytest.fixture(autouse=True)
def small_steps(monkeypatch):
    for name, value in (("OPENING", 20), ("CHUNK_ROWS", 16), ("BLOCK", 4), ("BLOCKS", 2)):
        monkeypatch.setattr(negatives, name, value)


def test_all_rows_compared(spark, space):
    rng = np.random.default_rng(1)
    middle = rng.normal(size=(6, 8))
    near = rng.integers(0, 6, 400)
    vectors = middle[near] + rng.normal(scale=0.3, size=(400, 8))
    rows = [(i, v.tolist(), int(k % 3)) for i, (v, k) in enumerate(zip(vectors, near))]
    rows += [(1000 + i, rows[0][1], i % 2) for i in range(90)]  # very many copies
    rows += [(500, rows[7][1], None), (501, None, 1), (502, [1.0, None], 1), (503, [float("nan")] * 8, 1), (504, [float("inf")] * 8, 1)]
    rows += [(None, rows[3][1], 0), (None, rows[3][1], 1), (10, rows[10][1], 0), (10, rows[10][1], 0), (600, [], 1), (610, [0.5], 2)]
    docs = with_clashes(spark.createDataFrame(rows, FIELDS).repartition(3))
    assert ours(docs, space, 10) == brute(rows, 10)


def test_bounds_spare_far_cells(spark, space):
    """Clusters far apart: an anchor's requests leave out most chunks, and results stay exact."""
    rng = np.random.default_rng(2)
    middle = rng.normal(size=(16, 6)) * 10
    near = rng.integers(0, 16, 1200)
    rows = [(i, (middle[k] + rng.normal(scale=0.05, size=6)).tolist(), i % 4) for i, k in enumerate(near.tolist())]
    assert ours(spark.createDataFrame(rows, FIELDS), space, 200) == brute(rows, 200)
    looked = 0
    for step in ("opening", "closing"):
        table = spark.read.parquet(f"{space.path}/positives_{step}_requests")
        looked += table.agg(F.sum(F.octet_length("keys") / 8)).first()[0] or 0
    assert looked < 0.6 * 6 * spark.read.parquet(f"{space.path}/chunks").count()


@pytest.mark.parametrize("size", [1e3, 1e12, 1e300])
def test_large_components(spark, space, size):
    rows = [(i, [size * (i % 7 - 3), float(i % 5), size / 2], i % 2) for i in range(40)]
    assert ours(spark.createDataFrame(rows, FIELDS), space, 8) == brute(rows, 8)


def test_one_label_one_row_and_none(spark, space):
    rows = [(i, [float(i), 1.0], 1) for i in range(5)]
    assert ours(spark.createDataFrame(rows, FIELDS), space, 1) == []
    assert ours(spark.createDataFrame(rows[:1], FIELDS), space, 1) == []
    assert ours(spark.createDataFrame([], FIELDS), space, 1) == []
