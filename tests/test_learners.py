import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from verbalis.learners import families as Fam
from verbalis.learners.forest import leaf_of
from verbalis.learners.margins import FourierFeatures, QuadraticSketch, quadratic_weights
from verbalis.learners.nearest import KnnClassifier
from verbalis.learners.voting import VotingModel
from verbalis.operators import neighbours as Nb
from verbalis.operators.sampling import stratified_folds
from verbalis.params import TrainingParams
from verbalis.plans import search as Se

LIGHT = {
    "linear_svm": {"max_iter": 10}, "poly_svm": {"max_iter": 10}, "rbf_svm": {"max_iter": 10, "components": 64},
    "random_forest": {"trees": 10}, "extra_trees": {"trees": 20}, "adaboost": {"trees": 4}, "mlp": {"max_iter": 60, "hidden": (8,)},
}
TASK = Fam.Task(3, 4, 5, LIGHT)


@pytest.fixture(scope="module")
def blobs(spark):
    """Three classes around different centres in four dimensions, made by Spark."""
    centres = F.array(F.col("c") * 3.0, F.lit(3.0) - F.col("c"), F.when(F.col("c") == 1, 4.0).otherwise(0.0), F.lit(1.0))
    noise = [F.randn(seed) for seed in (1, 2, 3, 4)]
    df = spark.range(180).withColumn("c", (F.col("id") % 3).cast("double"))
    x = F.array(*[F.get(centres, i) + 0.6 * n for i, n in enumerate(noise)])
    return df.select(
        F.col("id").alias("doc_id"), F.col("c").alias("label_index"), F.col("c").cast("string").alias("label"), array_to_vector(x).alias("features")
    ).coalesce(1).persist()


def _accuracy(df):
    return df.agg(F.avg((F.col("prediction") == F.col("label_index")).cast("double"))).first()[0]


@pytest.mark.parametrize("family", Fam.FAMILIES)
def test_family_learns_saves_and_loads(spark, blobs, family, tmp_path):
    model = Fam.build(family, TASK, final=True).fit(blobs)
    out = model.transform(blobs)
    assert _accuracy(out) > 0.85
    if family != "poly_svm" and family != "rbf_svm":
        shares = out.select(vector_to_array("probability").alias("p")).toPandas()["p"]
        assert all(abs(sum(p) - 1) < 1e-6 for p in shares)
    path = str(tmp_path / family)
    PipelineModel([model]).write().overwrite().save(path)
    again = PipelineModel.load(path).transform(blobs)
    same = out.select("doc_id", "prediction").exceptAll(again.select("doc_id", "prediction"))
    assert same.count() == 0


def test_bare_linear_machine(blobs):
    assert _accuracy(Fam.build("linear_svm", TASK).fit(blobs).transform(blobs)) > 0.85


@pytest.mark.parametrize("family", ["linear_svm", "adaboost", "extra_trees", "knn"])
def test_two_classes(blobs, family):
    two = blobs.filter("label_index < 2")
    model = Fam.build(family, Fam.Task(2, 4, 5, LIGHT), final=True).fit(two)
    assert _accuracy(model.transform(two)) > 0.9


def test_boosting_leaves_nothing_cached(spark, blobs):
    held = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    noisy = blobs.withColumn("label_index", F.when(F.rand(1) < 0.3, (F.col("label_index") + 1) % 3).otherwise(F.col("label_index")))
    before = held()
    model = Fam.build("adaboost", TASK, {"trees": 12}).fit(noisy)
    assert len(model.state["trees"]) == 12 and held() == before


def test_searched_tree_settings_build_trees(blobs):
    for family in ("decision_tree", "random_forest", "extra_trees", "adaboost"):
        drawn = {"depth": 4, "max_features": 3, "min_split": 4, "min_leaf": 2, "trees": 3}
        assert _accuracy(Fam.build(family, TASK, drawn).fit(blobs).transform(blobs)) > 0.8


def test_extra_trees_split_counts(blobs):
    """Leaf sizes of every tree add up to the data, and no leaf is smaller than allowed."""
    model = Fam.build("extra_trees", TASK, {"trees": 5, "depth": 3, "min_leaf": 8}).fit(blobs)
    x = np.stack(blobs.select(vector_to_array("features").alias("x")).toPandas()["x"])
    for tree in model.state["trees"]:
        sizes = np.bincount(leaf_of(tree, x))
        assert sizes.sum() == 180 and sizes[sizes > 0].min() >= 8 and len(tree["feature"]) <= 15


def _near(spark, n, d, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(v) for v in rng.integers(0, 3, d)], int(rng.integers(0, 3))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id bigint, x array<double>, label int")


def test_neighbours_against_brute_force(spark):
    """Both forms equal brute force, with many tied distances."""
    train_rows, train = _near(spark, 240, 4, 1)
    query_rows, queries = _near(spark, 60, 4, 2)
    queries = queries.select(F.col("id").alias("query_id"), "x")
    expected = {}
    for q, x, _ in query_rows:
        ranked = sorted((round(float(((np.array(x) - np.array(t)) ** 2).sum()), 6), i) for i, t, _ in train_rows)
        expected[q] = [i for _, i in ranked[:5]]
    for settings in ({}, {"bound": 0, "block": 25}):
        near = Nb.neighbours(queries, train, 5, **settings)
        assert {r.query_id: [n["id"] for n in r.near] for r in near.collect()} == expected


@pytest.mark.parametrize("ids", ["cast(doc_id as string)", "concat('a-', doc_id)", "if(doc_id % 3 = 0, null, doc_id)", None])
def test_knn_takes_any_id_or_none(blobs, ids):
    train, test = blobs.filter("doc_id >= 60"), blobs.filter("doc_id < 60")
    change = lambda df: df.withColumn("doc_id", F.expr(ids)) if ids else df.drop("doc_id")
    model = Fam.build("knn", TASK).fit(change(train))
    out = model.transform(change(test))
    assert out.count() == 60 and _accuracy(out) > 0.9
    assert all(abs(sum(r.probability) - 1) < 1e-9 for r in out.collect())


def test_knn_keeps_a_bounded_stratified_sample(blobs):
    width = len(blobs.first().features)
    model = KnnClassifier(maxValues=60 * width).fit(blobs)
    labels, vectors = model._kept
    assert 30 <= len(labels) <= 90 and vectors.shape[1] == width and set(labels) == set(range(TASK.classes))
    out = model.transform(blobs)
    assert _accuracy(out) > 0.9 and "probability" in out.columns


def test_knn_has_one_answer_at_every_size(spark, tmp_path, monkeypatch):
    """Rows beyond what is shipped are all kept, in files, and give the same neighbours as shipped ones, ties included."""
    rng = np.random.default_rng(8)
    rows = [(i // 2 if i % 7 else None, float(rng.integers(0, 3)), [float(v) for v in rng.integers(0, 4, 3)]) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, label_index double, x array<double>")
    train = df.withColumn("features", array_to_vector("x")).drop("x").repartition(5)
    monkeypatch.setattr(Nb, "CHUNK", 33)
    small, large = KnnClassifier(k=5).fit(train), KnnClassifier(k=5, shipped=10).fit(train)
    assert len(small._kept[0]) == 400 and large._kept is None and large._table.count() == 400
    path = str(tmp_path / "knn")
    PipelineModel([large]).write().overwrite().save(path)
    tests = spark.range(64).select("id", array_to_vector(F.array(*[(F.shiftright("id", 2 * i) % 4).cast("double") for i in range(3)])).alias("features"))
    shares = lambda model: {r.id: tuple(r.probability) for r in model.transform(tests).collect()}
    assert shares(small) == shares(large) == shares(PipelineModel.load(path)) and len(shares(small)) == 64
    # no default leaves out rows
    assert KnnClassifier().getOrDefault("maxValues") == 0


def test_feature_maps_approximate_their_kernels():
    rng = np.random.default_rng(0)
    x, z = rng.normal(size=(2, 20, 6)) * 0.5
    gaussian = np.exp(-0.3 * ((x - z) ** 2).sum(axis=1))
    maps = FourierFeatures.prepare(6, 4096, 0.3, 1)
    assert np.abs((FourierFeatures.apply(maps, x) * FourierFeatures.apply(maps, z)).sum(axis=1) - gaussian).max() < 0.1
    quadratic = (0.3 * (x * z).sum(axis=1) + 1) ** 2
    sketch = QuadraticSketch.prepare(6, 4096, 0.3, 1)
    assert np.abs((QuadraticSketch.apply(sketch, x) * QuadraticSketch.apply(sketch, z)).sum(axis=1) - quadratic).max() < 0.2
    expand = lambda v: np.concatenate([np.concatenate([[v[i]], v[: i + 1] * v[i]]) for i in range(len(v))])
    w = np.array(quadratic_weights(6, 0.3))
    exact = [(w * expand(a)) @ (w * expand(b)) + 1 for a, b in zip(x, z)]
    assert np.allclose(exact, quadratic)


def test_votes_over_models(blobs):
    models = [Fam.build(f, TASK).fit(blobs) for f in ("logistic", "knn", "decision_tree")]
    for voting in ("hard", "soft"):
        assert _accuracy(VotingModel(models, voting).transform(blobs)) > 0.9
    with pytest.raises(ValueError):
        VotingModel([Fam.build("linear_svm", TASK).fit(blobs)], "soft").transform(blobs)


def test_cross_predictions_cover_every_row_once(blobs):
    data = stratified_folds(blobs, 3, 1)
    out = Se.cross_predictions(Fam.build("logistic", TASK), data, 3)
    assert out.count() == 180 and out.select("doc_id").distinct().count() == 180


def test_search_is_not_worse_than_untuned(blobs):
    params = TrainingParams(n_hyperparam_combos=2, model_tuning_cv_folds_count=3)
    data = stratified_folds(blobs, 3, 1).persist()
    tuned = Se.random_search("logistic", data, TASK, params)
    folds = Se.cross_predictions(Fam.build("logistic", TASK), data, 3).withColumnRenamed("label", "label_index")
    scores = [Se.ClassMetric().evaluate(folds.filter(F.col("fold") == f)) for f in range(3)]
    assert tuned.score >= sum(scores) / 3 - 1e-9


def test_select_and_evaluate(blobs):
    params = TrainingParams(model_selection_cv_folds_count=3, n_promising_models_to_select=2, n_hyperparam_combos=1, model_tuning_cv_folds_count=3)
    metrics, promising, _ = Se.select_models(blobs, TASK, params, ("logistic", "decision_tree", "rbf_svm"))
    assert metrics.count() == 3 and len(promising) == 2
    tuned = Se.tune_models(blobs, promising, TASK, params)
    table, _, best = Se.evaluate_models(blobs, tuned, params)
    assert best.family in promising and table.count() == 2
    strict = TrainingParams(final_min_performance=1.0)
    _, _, none = Se.evaluate_models(blobs.withColumn("label_index", F.lit(0.0)), tuned, strict)
    assert none is None


def test_quadratic_map_is_chosen_by_its_setting(spark, blobs):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 80)) * rng.choice([0.5, 1.5], (600, 1))
    y = ((x**2).sum(axis=1) > 80).astype(float)
    wide = spark.createDataFrame([(float(b), a.tolist()) for a, b in zip(x, y)], "label_index double, x array<double>")
    wide = wide.select("label_index", array_to_vector("x").alias("features")).coalesce(1).persist()
    for rows, classes, dims in ((wide, 2, 80), (blobs, 3, 4)):
        task = Fam.Task(classes, dims, 5, {"poly_svm": {"max_iter": 5}})
        for drawn, kind in (({}, "PolynomialExpansion"), ({"quadratic": "sketch"}, "QuadraticSketch")):
            model = Fam.build("poly_svm", task, drawn).fit(rows)
            assert kind in [type(s).__name__ for s in model.stages]
            assert _accuracy(model.transform(rows)) > 0.85
    with pytest.raises(ValueError):
        Fam.build("poly_svm", TASK, {"quadratic": "best"})


def test_machines_fitted_together_equal_single_fits(blobs):
    """Weights of many folds and settings in one call against MLlib, one fit at a time."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import vector_to_array

    from verbalis.learners.machines import Machine, fit_machines, one_against_rest

    rows = blobs.select(vector_to_array("features").alias("x"), F.col("label_index").cast("int").alias("y"))
    rows = rows.withColumn("fold", F.pmod(F.xxhash64("x"), F.lit(3)).cast("int")).persist()
    machines = [Machine(fold, reg) for fold in (0, 2, -1) for reg in (1e-2, 0.3)]
    together = fit_machines(rows, machines, one_against_rest(3), "log", 500, 1e-7)
    for machine, weights in zip(machines, together):
        seen = rows.filter(F.col("fold") != machine.fold)
        seen = seen.select(array_to_vector("x").alias("features"), F.col("y").cast("double").alias("label"))
        one = LogisticRegression(regParam=machine.reg, standardization=False, tol=1e-9, maxIter=500).fit(seen)
        assert np.allclose(one.coefficientMatrix.toArray(), weights[:, :-1], atol=2e-2)
    rows.unpersist()


def test_every_family_has_shares(blobs):
    short = {"mlp": {"max_iter": 20, "hidden": (4,)}, "adaboost": {"trees": 3}, "random_forest": {"trees": 4}, "extra_trees": {"trees": 4}}
    task = Fam.Task(3, 4, 5, short)
    for family in Fam.FAMILIES:
        out = Fam.build(family, task, final=True).fit(blobs).transform(blobs)
        sums = out.select(vector_to_array("probability").alias("p")).selectExpr("aggregate(p, 0D, (a, v) -> a + v) AS s", "size(p) AS n")
        assert sums.filter("abs(s - 1) > 1e-6 OR n <> 3").count() == 0, family


def test_coupled_shares_give_back_the_classes():
    from verbalis.learners.margins import coupled

    rng = np.random.default_rng(8)
    shares = rng.dirichlet(np.ones(5), 50)
    pairs = np.array([[p[a] / (p[a] + p[b]) for a in range(5) for b in range(a + 1, 5)] for p in shares])
    assert np.allclose(coupled(pairs, 5), shares, atol=1e-5)


def test_models_boosted_together_equal_single_ones(blobs):
    from pyspark.ml.functions import vector_to_array

    from verbalis.learners.boosting import Booster, boost

    rows = blobs.select(vector_to_array("features").alias("x"), F.col("label_index").cast("int").alias("y"))
    rows = rows.withColumn("y", F.when(F.xxhash64("x") % 4 == 0, (F.col("y") + 1) % 3).otherwise(F.col("y")).cast("int"))
    rows = rows.withColumn("fold", F.pmod(F.xxhash64("x"), F.lit(3)).cast("int")).persist()
    settings = [(0, 6, 0.5, 2), (1, 3, 1.0, 3), (-1, 25, 0.5, 1)]
    together = boost(rows, [Booster(*s, max_features=2) for s in settings], 3)
    for s, trees in zip(settings, together):
        assert boost(rows, [Booster(*s, max_features=2)], 3)[0] == trees
        assert len(trees) == s[1]
    rows.unpersist()


def test_neighbours_by_chunks_are_those_of_one_comparison():
    rng = np.random.default_rng(3)
    train, x = rng.integers(0, 4, (500, 3)).astype(float), rng.integers(0, 4, (40, 3)).astype(float)  # many ties
    distances = ((x[:, None, :] - train[None, :, :]) ** 2).sum(axis=2)
    expected = np.argsort(distances, axis=1, kind="stable")[:, :7]
    for chunk in (1, 5, 64, 1000):
        picks, found = Nb.best_of(x, train, 7, chunk)
        assert np.array_equal(picks, expected)
        assert np.array_equal(found, np.take_along_axis(distances, expected, axis=1))
    assert Nb.best_of(x, train[:3], 7, 2)[0].shape == (40, 3)


def test_neighbours_need_no_memory_for_all_pairs():
    import tracemalloc

    train, x = np.zeros((200_000, 2)), np.zeros((64, 2))
    tracemalloc.start()
    Nb.best_of(x, train, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 * 200_000 * 8 / 2


def test_sums_of_many_tasks_reach_the_driver_as_one(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    from verbalis.learners import machines as Ma

    received, real = [], Classic.toArrow
    monkeypatch.setattr(Classic, "toArrow", lambda self: received.append(real(self)) or received[-1])
    rows = spark.range(400).select(F.array(F.col("id").cast("double")).alias("x"))

    def per_task(batches):
        total = [b.column("x").flatten().to_numpy(zero_copy_only=False).sum() for b in batches]
        return np.array([sum(total), 1.0]) if total else None

    for tasks in (1, 5, 40):
        sums = Ma.totals_of(rows.repartition(tasks), per_task, 2)
        assert sums[0] == 399 * 200 and received[-1].num_rows == 1


def test_few_rows_of_many_features_are_fitted_in_their_span(spark, monkeypatch):
    from verbalis.learners import margins as Mg

    rng = np.random.default_rng(4)
    data = [(x.tolist(), int(x[0] + x[1] * x[2] > 0), i % 3) for i, x in enumerate(rng.normal(size=(90, 30)))]
    rows = spark.createDataFrame(data, "x array<double>, y int, fold int").coalesce(1).persist()
    settings = [{"cost": 1.0, "max_iter": 30, "components": 8, "quadratic": "exact"}, {"cost": 5.0, "max_iter": 30, "components": 8, "quadratic": "exact"}]
    widths, real = [], Mg.fit_machines

    def fitted(rows, machines, *rest):
        out = real(rows, machines, *rest)
        widths.extend(w.shape[1] for w in out)
        return out

    monkeypatch.setattr(Mg, "fit_machines", fitted)
    narrow = Mg.machine_counts("poly_svm", rows, 2, settings, 3, 5)
    assert max(widths) == 91  # a weight per row, not the 495 products
    monkeypatch.setattr(Mg, "SPAN_ROWS", 0)
    wide = Mg.machine_counts("poly_svm", rows, 2, settings, 3, 5)
    assert max(widths) == 496
    assert np.abs(narrow - wide).sum() <= 2
    rows.unpersist()


def test_passes_leave_no_shuffle_files(spark, tmp_path):
    """Sums of a pass are as wide as a model; those of all passes would fill the disk."""
    import gc

    from verbalis.learners import machines as Ma

    tracked = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses
    rows = spark.range(400).select(F.array(F.col("id").cast("double")).alias("x")).repartition(20).persist()
    rows.count()
    gc.collect()
    known = lambda: {int(k) for k in tracked().keySet().mkString(",").split(",") if k}
    before = known()
    for _ in range(3):
        assert Ma.totals_of(rows, lambda batches: np.ones(1) if sum(b.num_rows for b in batches) else None, 1)[0] == 20
    assert known() <= before
    rows.unpersist()


def test_mapped_rows_do_not_spread_over_more_partitions_than_their_work_needs(spark):
    from verbalis.learners.scored import compacted

    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(10)
    assert compacted(rows, 492_307, 64, 2144).rdd.getNumPartitions() <= max(2 * cores, 492_307 * 64 // 1_000_000)
    assert compacted(rows, 100, 4, 14).rdd.getNumPartitions() == 1


def test_pairs_of_classes_are_fitted_on_their_rows(spark):
    """Machines of pairs fitted together equal those fitted on the rows of each pair alone."""
    from verbalis.learners import machines as Ma

    rng = np.random.default_rng(6)
    data = [((rng.normal(size=3) + 2 * np.eye(3)[i % 3]).tolist(), i % 3, i % 2) for i in range(90)]
    rows = spark.createDataFrame(data, "x array<double>, y int, fold int").coalesce(1).persist()
    signs = Ma.one_against_one(3)
    together = Ma.fit_machines(rows, [Ma.Machine(0, 0.1), Ma.Machine(1, 0.1)], signs, max_iter=200, tol=1e-8)
    for k, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
        size = 2 / 3  # the mean loss counts the rows of all classes
        pair = rows.filter(F.col("y").isin(a, b)).withColumn("y", F.when(F.col("y") == a, 1).otherwise(0)).persist()
        alone = Ma.fit_machines(pair, [Ma.Machine(0, 0.1 / size)], Ma.one_against_rest(2), max_iter=200, tol=1e-8)[0][0]
        assert np.abs(together[0][k] - alone).max() < 0.02
        pair.unpersist()
    rows.unpersist()


def test_machines_of_few_rows_take_no_pass_of_the_cluster_per_step(spark, monkeypatch):
    """Few rows are held by a task per machine; the weights are those of passes over the rows."""
    from verbalis.learners import machines as Ma

    rng = np.random.default_rng(7)
    data = [((rng.normal(size=4) + np.eye(4)[i % 4]).tolist(), i % 4, i % 3) for i in range(120)]
    rows = spark.createDataFrame(data, "x array<double>, y int, fold int").repartition(3).persist()
    passes, real = [], Ma.totals_of
    monkeypatch.setattr(Ma, "totals_of", lambda *a: passes.append(1) or real(*a))
    machines = [Ma.Machine(f, reg) for f in (0, 1, -1) for reg in (0.01, 1.0)]
    few = Ma.fit_machines(rows, machines, Ma.one_against_rest(4), "log", 200, 1e-7)
    assert not passes
    monkeypatch.setattr(Ma, "HELD_VALUES", 0)
    many = Ma.fit_machines(rows, machines, Ma.one_against_rest(4), "log", 200, 1e-7)
    assert len(passes) > 5 and all(np.abs(a - b).max() < 1e-3 for a, b in zip(few, many))
    rows.unpersist()


def test_boosters_of_few_rows_take_no_pass_of_the_cluster_per_level(spark, blobs, monkeypatch):
    from verbalis.learners import boosting as Bo

    x = vector_to_array("features").alias("x")
    noisy = (F.col("label_index") + (F.col("doc_id") % 7 == 0).cast("int")) % 3
    rows = blobs.select(x, noisy.cast("int").alias("y"), (F.col("doc_id") % 2).cast("int").alias("fold")).persist()
    passes, real = [], Bo.totals_of
    monkeypatch.setattr(Bo, "totals_of", lambda *a: passes.append(1) or real(*a))
    made = lambda: Bo.boost(rows, [Bo.Booster(f, 23, depth=3, max_features=3) for f in (0, 1, -1)], 3)
    few = made()
    assert not passes
    monkeypatch.setattr(Bo, "HELD_VALUES", 0)
    many = made()
    assert len(passes) >= 23
    for a, b in zip(few, many):
        assert len(a) == len(b) == 23
        for s, t in zip(a, b):
            assert [s[n] for n in ("feature", "left", "right", "threshold")] == [t[n] for n in ("feature", "left", "right", "threshold")]
            assert np.allclose(s["shares"], t["shares"])
    rows.unpersist()
