import numpy as np
import pytest
from pyspark.sql import functions as F

from verbalis.llm import embeddings
from verbalis.llm.components import components


def brute(ids, vectors, threshold):
    n = len(ids)
    link = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(i):
            a, b = vectors[i], vectors[j]
            if a is None or b is None or len(a) != len(b) or not len(a):
                continue
            a, b = np.array(a, float), np.array(b, float)
            if np.isfinite(a).all() and np.isfinite(b).all() and a.any() and b.any():
                link[i, j] = link[j, i] = a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold
    group = list(range(n))
    for _ in range(n):
        group = [min([group[i], *[group[j] for j in np.flatnonzero(link[i])]]) for i in range(n)]
    low = {g: min((ids[i] for i in range(n) if group[i] == g and ids[i] is not None), default=None) for g in set(group)}
    return sorted(((ids[i], int(link[i].sum()), low[group[i]], ids[i] == low[group[i]]) for i in range(n)), key=str)


def vectors(kind, n=150, d=6):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, d))
    out = [(base[rng.integers(12)] * rng.uniform(0.1, 9) + rng.normal(size=d) * 0.25).tolist() for _ in range(n)]
    out[5:9] = [out[4]] * 4
    special = [None, [], [0.0] * d, [float("nan"), *[1.0] * (d - 1)], [float("inf"), *[1.0] * (d - 1)], [1.0, 2.0]]
    special += [[2.0, 4.0], [None, *[1.0] * (d - 1)], [1e-30] * d, [1e-30 * (1 + (i == 0)) for i in range(d)]]
    return [None if v is None else [None if x is None else float(kind(x)) for x in v] for v in out + special]


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("block_rows", [10, 8192])
def test_against_brute_force(spark, space, kind, block_rows):
    rows = vectors(np.float32 if kind == "float" else float)
    ids = [*range(len(rows))]
    ids[20], ids[30], ids[6] = None, 31, 3
    table = spark.createDataFrame(list(zip(ids, rows)), f"vec_id long, embedding array<{kind}>")
    table = table.withColumn("_key", F.lit("x")).withColumn("dim", F.lit(1))
    out = embeddings.near_vectors(table, space, 0.9, block_rows=block_rows)
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(ids, rows, 0.9)


def test_error_bound_holds():
    rng = np.random.default_rng(0)
    x = rng.standard_t(2, size=(300, 40))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    codes, scale, error = embeddings.quantised(x)
    back = codes * scale[:, None]
    slack = (1 + error[:, None]) * error + error[:, None] * (1 + error) + error[:, None] * error
    assert (np.abs(x @ x.T - back @ back.T) <= slack).all() and np.abs(codes).max() == 127


def test_wide_vectors_stay_exact():
    rng = np.random.default_rng(0)
    a = rng.integers(-127, 128, size=(5, 3000)).astype(np.float32)
    assert (embeddings._products(a, a) == a.astype(np.int64) @ a.T.astype(np.int64)).all()


def test_empty(spark, space):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embeddings.near_vectors(none, space).count() == 0
    nulls = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in embeddings.near_vectors(nulls, space).collect()] == [(1, 0, 1, True)]


def test_components(spark, space):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    links = spark.createDataFrame(chain, "x long, y long")
    found = {r.node: r.component for r in components(links, space, "t").collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {200: 200, 201: 200}


def test_very_large_and_small_doubles_link(spark, space):
    shapes = [[1.0, 2.0, 3.0], [2.0, 4.0, 6.5], [3.0, -1.0, 0.5]]
    rows, n = [], 0
    for size in (1.0, 1e200, 1e300, 1e-200, 1e-307, 5e-324):
        for shape in shapes:
            rows.append((n, [x * size for x in shape]))
            n += 1
    out = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), space)
    got = {r.vec_id: (r.n_links, r.component_id) for r in out.collect()}
    for i in range(15):
        assert got[i][1] == (0 if i % 3 < 2 else 2)
        assert got[i][0] >= (9 if i % 3 < 2 else 4)
