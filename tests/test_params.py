import pytest

from verbalis.learners import families as Fam
from verbalis.params import TrainingParams


def test_defaults_are_valid_and_complete():
    params = TrainingParams()
    assert params.lemmas_freq_requirement == 20 and params.profile("tri_cols").are_dictionary


@pytest.mark.parametrize(
    "bad",
    [
        {"term_value": "tf"}, {"min_records_per_class": 0}, {"testing_set_size": 1.5}, {"testing_set_size": True},
        {"final_min_performance": 2}, {"lemmas_are_alpha": 1}, {"model_tuning_cv_folds_count": 1}, {"random_state": "5"},
        {"bi_cols_term_count": -1}, {"feature_col_name": ""}, {"model_tuning_scoring": "f2"},
    ],
)
def test_bad_values_are_rejected(bad):
    with pytest.raises(ValueError):
        TrainingParams.of(bad)


def test_unknown_names_are_rejected():
    with pytest.raises(AttributeError):
        TrainingParams.of({"lemas_are_alpha": True})
    with pytest.raises(ValueError):
        TrainingParams().profile("words")


@pytest.mark.parametrize("family", Fam.FAMILIES)
def test_draws_are_reproducible_and_buildable(family, spark):
    task = Fam.Task(3, 8)
    drawn = Fam.draws(family, 9, 5)
    assert drawn == Fam.draws(family, 9, 5)
    assert len(drawn) == {"knn": 3, "poly_svm": 5, "mlp": 3}.get(family, 9)
    for settings in drawn[:3]:
        assert Fam.build(family, task, settings, final=True) is not None
    for settings in drawn:
        if "hidden" in settings:
            assert 4 <= len(settings["hidden"]) < 8 and all(50 <= n < 200 for n in settings["hidden"])
        if "depth" in settings and "max_features" in settings:
            assert 3 <= settings["depth"] < 15 and 3 <= settings["max_features"] < 15


def test_training_queries_use_default_settings(monkeypatch):
    from unittest.mock import MagicMock

    from verbalis.learners import families as Fam
    from verbalis.plans import queries as Q

    assert all(Q.TASK.settings(f) == Fam.DEFAULTS[f] for f in Fam.FAMILIES)
    trainer, data, search = MagicMock(), MagicMock(), MagicMock()
    search.select_models.return_value = [None] * 3
    data.once = lambda spark, sf, name, build: build()
    for name, value in (("AutoTextClassifier", trainer), ("D", data), ("Se", search)):
        monkeypatch.setattr(Q, name, value)
    monkeypatch.setattr(Q, "_sides", lambda spark, sf: (MagicMock(), MagicMock()))
    Q._run(None, "")
    Q.QUERIES["select_models"](None, "")
    run, default = trainer.call_args.args[0], TrainingParams()
    for name in (
        "model_selection_cv_folds_count", "n_promising_models_to_select", "n_hyperparam_combos", "model_tuning_cv_folds_count",
    ):
        assert getattr(run, name) == getattr(default, name)
    assert len(trainer.call_args.args) == 2 and not trainer.call_args.kwargs
    assert len(search.select_models.call_args.args) == 3 and search.select_models.call_args.args[2] == default
