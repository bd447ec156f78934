import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from verbalis.operators import records as Rec
from verbalis.operators import sampling as Sa
from verbalis.operators.lookup import bucketed_rank, lookup_join


def _rows(spark, sizes):
    rows = [(f"{label}-{i}", label) for label, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "doc_id string, label string")


def _count(df, *keys):
    return {tuple(r[k] for k in keys): r["count"] for r in df.groupBy(*keys).count().collect()}


def test_largest_remainders(spark):
    split = Sa.holdout_split(_rows(spark, {"a": 7, "b": 5, "c": 3}), 4, "stratified", 1)
    # 11 train rows: shares 5.13, 3.67, 2.2 give 5, 3, 2 and the last one to b.
    assert _count(split.filter("split = 'train'"), "label") == {("a",): 5, ("b",): 4, ("c",): 2}
    assert split.count() == 15 and split.select("doc_id").distinct().count() == 15


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(2, 60), min_size=2, max_size=4), st.floats(0.1, 0.5), st.integers(0, 99))
def test_split_is_exact_and_proportional(spark, sizes, share, seed):
    named = {f"c{i}": n for i, n in enumerate(sizes)}
    split = Sa.holdout_split(_rows(spark, named), share, "stratified", seed)
    test = {k[0]: v for k, v in _count(split.filter("split = 'test'"), "label").items()}
    total = sum(sizes)
    wanted = math.ceil(share * total)
    assert split.count() == total and sum(test.values()) == wanted
    assert all(abs(test.get(c, 0) - n * wanted / total) <= 1 + 1e-9 for c, n in named.items())


def test_hot_class_and_repeated_runs(spark):
    """One class holds almost all rows; the parts are the same whenever they are computed."""
    rows = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 50 == 0, "rare").otherwise("hot").alias("label")
    )
    one, two = (Sa.holdout_split(r, 0.25, "stratified", 3) for r in (rows, rows.repartition(7)))
    assert _count(one, "label", "split")[("hot", "test")] == 4900
    assert one.exceptAll(two).count() == 0


@pytest.mark.parametrize("size,wanted", [(10, 10), (0.05, 2), (1.0, 45), (100, 45)])
def test_subsample(spark, size, wanted):
    rows = _rows(spark, {"a": 30, "b": 15})
    assert Sa.subsample(rows, size, "stratified", 2).count() == wanted
    assert Sa.subsample(rows, size, "random", 2).count() == wanted


def test_folds_follow_the_sorted_positions(spark):
    folds = _count(Sa.stratified_folds(_rows(spark, {"a": 7, "b": 5}), 3, 4), "label", "fold")
    # Positions 0-6 belong to a (folds 0,1,2,0,1,2,0), positions 7-11 to b (1,2,0,1,2).
    assert folds == {("a", 0): 3, ("a", 1): 2, ("a", 2): 2, ("b", 0): 1, ("b", 1): 2, ("b", 2): 2}


def test_tiny_classes_leave_empty_parts(spark):
    folds = Sa.stratified_folds(_rows(spark, {"a": 1, "b": 2, "c": 9}), 5, 4)
    assert folds.count() == 12
    assert set(r.fold for r in folds.collect()) <= set(range(5))


def test_class_guards(spark):
    rows = _rows(spark, {"a": 5, "b": 3})
    assert {r.label for r in Rec.keep_frequent_classes(rows, 5).collect()} == {"a"}
    with pytest.raises(ValueError):
        Rec.require_classes(Rec.keep_frequent_classes(rows, 5))
    with pytest.raises(ValueError):
        Rec.require_classes(Rec.keep_frequent_classes(rows, 50))


def test_null_text_and_label(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "t", None), (3, "t", "y")], "id int, t string, l string")
    assert [tuple(r) for r in Rec.labelled_records(df, "id", "t", "l").orderBy("doc_id").collect()] == [(1, "", "x"), (3, "t", "y")]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_lookup_equals_broadcast(spark, how):
    left = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("w"), F.col("id"))).alias("word"))
    right = spark.createDataFrame([("hot", 1), ("w1", 2), ("w2", 3)], "word string, n int")
    a, b = (lookup_join(left, right, "word", how, small) for small in (True, False))
    assert a.count() == b.count() and a.select(sorted(a.columns)).exceptAll(b.select(sorted(b.columns))).count() == 0


def test_bucketed_rank(spark):
    df = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("h"), (F.col("id") % 2).alias("g"))
    ranked = bucketed_rank(df, ["g"], F.substring("h", 1, 1), ["h"], "r").toPandas()
    for _, part in ranked.groupby("g"):
        assert part.sort_values("h")["r"].tolist() == list(range(len(part)))
