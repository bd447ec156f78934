import itertools
import re

import pytest
from pyspark.sql import functions as F

from verbalis.llm import mixing
from verbalis.llm.mixing import capped_targets, least_cost_routes


def test_targets_share_all_words():
    assert capped_targets([100, 100, 100], [1, 2, 3], 3) == pytest.approx([50, 100, 150])
    capped = capped_targets([10, 1000, 10], [1, 2, 3], 3)
    assert capped == pytest.approx([30, 960, 30])
    assert capped_targets([0, 0], [1, 1], 3) == [0, 0]
    assert capped_targets([], [], 3) == []


def test_routes_are_cheapest():
    """Overlapping patterns against all whole-number routings of a small case."""
    sizes, members, quotas, repeats = [3, 2, 2], [(0,), (0, 1), (1,)], [5, 4], 3

    def cost(n, size):
        return sum(k * max(0, min(n - k * size, size)) for k in range(repeats))

    best = min(
        cost(a, 3) + cost(b + c, 2) + cost(d, 2)
        for a, b, c, d in itertools.product(range(10), range(7), range(7), range(7))
        if a + b == 5 and c + d == 4 and b + c <= 6
    )
    flows = least_cost_routes(sizes, members, quotas, repeats)
    used = [sum(v for (i, _), v in flows.items() if i == p) for p in range(3)]
    assert sum(cost(u, s) for u, s in zip(used, sizes)) == best
    assert [sum(v for (_, j), v in flows.items() if j == s) for s in range(2)] == quotas


def test_quota_beyond_capacity_takes_what_there_is():
    assert least_cost_routes([2], [(0,)], [100], 3) == {(0, 0): 6}


def rows_of(n=400):
    out = []
    for i in range(n):
        source = None if i % 11 == 0 else f"s{min(i % 7, 3)}"
        out.append((i, "w " * (1 + i * 37 % 50), source))
    return out + [(n, None, "s0"), (n + 1, "", "s9"), (n + 1, "", "s9"), (None, "a b", "s1"), (5, "w w w", "s2")]


def test_mix_comes_near_its_targets(make_docs, space):
    docs = make_docs(rows_of())
    member, size = F.array("source"), mixing.words_in("text")
    mix = mixing.solve_mix(docs, space, member, size)
    taken = mixing.times_taken(docs, mix, member)
    assert set(taken.columns) == set(docs.columns) | {"times_taken"}
    rows = [(r.source, len(re.findall(r"[^\x20\x09-\x0d]+", r.text or "")), r.times_taken) for r in taken.collect()]
    assert len(rows) == docs.count() and max(t for _, _, t in rows) <= 3
    names = sorted({s for s, _, _ in rows}, key=lambda x: (x is None, x or ""))
    assert names == mix.sources
    sizes = [sum(n for s, n, _ in rows if s == x) for x in names]
    assert sizes == mix.sizes
    assert mix.targets == pytest.approx(capped_targets(sizes, [1.0 + i % 3 for i in range(len(names))], 3))
    for name, target in zip(names, mix.targets):
        # at most half of the largest document, 50 words
        assert abs(sum(n * t for s, n, t in rows if s == name) - target) <= 25
    again = mixing.solve_mix(docs.repartition(7), space, member, size)
    assert sorted(map(str, again.cuts.collect())) == sorted(map(str, mix.cuts.collect()))


def test_mixed_rows(make_docs, none, space):
    docs = make_docs(rows_of())
    out = mixing.mixed(docs, space)
    assert out.columns == docs.columns
    times = mixing.times_taken(docs, mixing.solve_mix(docs, space, F.array("source"), mixing.words_in("text")), F.array("source"))
    assert out.count() == times.agg(F.sum("times_taken")).first()[0]
    assert mixing.mixed(none, space).count() == 0


def test_overlapping_sources(spark, space):
    rows = [(i, ["a"] if i % 3 else ["b", "a"], 10) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, sources array<string>, size long")
    mix = mixing.solve_mix(docs, space, F.col("sources"), F.col("size"), weights=lambda i: [1, 1][i])
    assert mix.sources == ["a", "b"] and mix.sizes == [3000, 1000]
    taken = mixing.times_taken(docs, mix, F.col("sources"))
    words = {tuple(r.p): r.w for r in taken.groupBy(F.col("sources").alias("p")).agg(F.sum(F.col("size") * F.col("times_taken")).alias("w")).collect()}
    assert abs(sum(words.values()) - sum(mix.targets)) <= 20


def test_rows_without_ids_meet_their_targets(make_docs, space):
    rows = [(None, f"w{i} " * (i % 40 + 1), "a") for i in range(50)] + [(7, f"v{i} " * (i % 30 + 1), "b") for i in range(60)]
    rows += [(100 + i, "x y z " * (i % 20 + 1), "c") for i in range(80)]
    docs, member, size = make_docs(rows), F.array("source"), mixing.words_in("text")
    mix = mixing.solve_mix(docs, space, member, size)
    taken = mixing.times_taken(docs, mix, member).withColumn("size", size)
    sums = taken.groupBy("source").agg(F.sum(F.col("size") * F.col("times_taken")).alias("n"), F.max("size").alias("m")).collect()
    for r in sums:
        assert abs(r.n - mix.targets[mix.sources.index(r.source)]) <= r.m / 2 + 1
