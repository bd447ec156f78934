import numpy as np
import pytest
from pyspark.sql import functions as F

from verbalis.llm import quality
from verbalis.llm.common import table


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = quality.fit_additive(x[:3000], y[:3000])
    assert (1, 0) in model.pairs
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9
    by_hand = model.base + sum(t[np.searchsorted(e, x[:5, j], "right")] for j, (e, t) in enumerate(zip(model.edges, model.tables)))
    for (a, b), t in zip(model.pairs, model.pair_tables):
        by_hand = by_hand + t[np.searchsorted(model.coarse[a], x[:5, a], "right"), np.searchsorted(model.coarse[b], x[:5, b], "right")]
    assert model.margin(x[:5]) == pytest.approx(by_hand)


def test_models_without_choice():
    none = quality.fit_additive(np.empty((0, 3)), np.empty(0))
    assert none.score(np.ones((2, 3))).tolist() == [0.5, 0.5]
    ones = quality.fit_additive(np.ones((50, 3)), np.ones(50))
    assert (ones.score(np.ones((2, 3))) > 0.9).all()


def test_features_of_single_texts_do_not_depend_on_neighbours():
    texts = [b"", b"   ", "Ünï cödé words, WORDS!! a|b 12 ###".encode(), b"a a a a\nb\nb", b"x" * 5000, b"\n\n"]
    together = quality.text_features(texts)
    assert np.isfinite(together).all() and together.shape == (6, len(quality.FEATURES))
    for t, row in zip(texts, together):
        assert quality.text_features([t])[0] == pytest.approx(row)
    at = {n: i for i, n in enumerate(quality.FEATURES)}
    assert together[3][at["repeated_neighbours"]] == pytest.approx(4 / 6)
    assert together[3][at["repeated_lines"]] == pytest.approx(1 / 3)


def test_held_out_accuracy(spark, space):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    out = quality.quality_scores(docs, labels, space).join(labels, "doc_id").filter("held_out").toPandas()
    assert len(out) > 50 and out.score.between(0, 1).all()
    assert (out.predicted == out.quality).mean() > 0.95
    assert ((out.score >= 0.3) == (out.predicted == 1)).all()


def test_edges(edges, none, spark, space):
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (7, None), (9, 5), (8, 1)], "doc_id long, quality int")
    out = quality.quality_scores(edges, labels, space)
    assert out.count() == edges.count() and out.filter("score is null or predicted is null").count() == 0
    same = out.filter("doc_id = 4").select("score").distinct().count()
    assert same == 1
    assert quality.quality_scores(none, labels, space).count() == 0
    without = quality.quality_scores(edges, labels.limit(0), space)
    assert {r.score for r in without.collect()} == {0.5}


def test_filter_agrees_with_scores(edges, spark, space):
    sf = "/root/testdata/sf0.001"
    docs, labels = table(spark, sf, "documents").withColumn("score", F.lit(-1)), table(spark, sf, "labels")
    good = quality.good_texts(docs, labels, space)
    assert good.columns == docs.columns
    scores = quality.quality_scores(docs, labels, space)
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in scores.filter("predicted = 1").collect()}
