"""Settings of a training run, checked when they are made."""

from __future__ import annotations

from dataclasses import dataclass, fields

from verbalis.operators.cleaning import JunkProfile
from verbalis.operators.metrics import METRICS

# Allowed words of the settings that take one of a few.
CHOICES = {
    "model_type": ("classifier",),
    "feature_selection_metric": ("chi^2", "F", "mutual_info"),
    "term_value": ("frequency", "presence"),
    "data_splitting": ("stratified", "random"),
    "ngram_source": ("raw", "clean"),
    "fit_scope": ("train", "all"),
    "model_selection_performance_metric": METRICS,
    "model_tuning_scoring": METRICS,
    "final_min_performance_metric": METRICS,
}
AT_LEAST_ONE = (
    "min_records_per_class", "lemmas_freq_requirement", "lemmas_len_requirement", "bi_cols_freq_requirement",
    "tri_cols_freq_requirement", "model_selection_data_limit", "n_promising_models_to_select", "n_hyperparam_combos",
)
AT_LEAST_TWO = ("model_selection_cv_folds_count", "model_tuning_cv_folds_count")
SIZES = ("number_of_records_to_include", "training_set_size", "testing_set_size", "n_selected_features")
SHARES = ("model_selection_min_performance", "final_min_performance")


@dataclass(frozen=True)
class TrainingParams:
    """Defaults are those of the original settings; a size is a count (int) or a share (float).

    Two settings bound the labelled rows that a model is fitted on: ``number_of_records_to_include`` (a stratified sample
    of the given records; the default share of 0.05 leaves out 95 of 100 rows, 1.0 takes all) and
    ``model_selection_data_limit`` (rows on which families are compared). Nothing else leaves out rows.
    ``include_ensemble_voters`` lets the tuned models also vote together in the evaluation.
    """

    # Names and defaults of the settings.
    feature_col_name: str = "text"
    label_col_name: str = "label"
    id_col_name: str = "doc_id"
    model_type: str = "classifier"
    verbosity: int = 1
    number_of_records_to_include: int | float = 0.05
    min_records_per_class: int = 5000
    random_state: int = 5

    # Accepted for compatibility; nothing depends on them.
    use_spell_checking: bool = True
    title_proper_nouns: bool = True
    uppercase_acronyms: bool = True
    use_eng_features_emotions: bool = True
    training_set_size: int | float = 0.8
    model_selection_param_tuning: bool = False

    remove_sub_terms: bool = False
    lemmatize_unigrams: bool = True
    lemmas_are_alpha: bool = True
    lemmas_are_not_stop: bool = True
    lemmas_are_dictionary: bool = True
    lemmas_allow_number: bool = False
    lemmas_allow_alphanum: bool = False
    lemmas_allow_acronyms: bool = False
    lemmas_allow_proper_nouns: bool = False
    lemmas_freq_requirement: int = 20
    lemmas_len_requirement: int = 3
    bi_cols_term_count: int | None = 300
    bi_cols_are_alpha: bool = True
    bi_cols_are_dictionary: bool = True
    bi_cols_are_not_stop: bool = True
    bi_cols_allow_number: bool = False
    bi_cols_allow_alphanum: bool = False
    bi_cols_allow_acronyms: bool = False
    bi_cols_allow_proper_nouns: bool = False
    bi_cols_freq_requirement: int = 20
    tri_cols_term_count: int | None = 200
    tri_cols_are_alpha: bool = True
    tri_cols_are_dictionary: bool = True
    tri_cols_are_not_stop: bool = True
    tri_cols_allow_number: bool = False
    tri_cols_allow_alphanum: bool = False
    tri_cols_allow_acronyms: bool = False
    tri_cols_allow_proper_nouns: bool = False
    tri_cols_freq_requirement: int = 10

    use_meta_features: bool = True
    use_eng_features_subjectivity: bool = True
    ngram_source: str = "raw"
    fit_scope: str = "train"
    n_selected_features: int | float = 0.1
    feature_selection_metric: str = "chi^2"
    term_value: str = "frequency"
    use_tfidf_scaling: bool = True
    use_L2_row_normalization: bool = True
    remove_zero_length_vectors: bool = True

    model_selection_data_limit: int = 1500
    data_splitting: str = "stratified"
    testing_set_size: int | float = 0.2
    model_selection_cv_folds_count: int = 5
    n_promising_models_to_select: int = 3
    model_selection_performance_metric: str = "f1_macro"
    model_selection_min_performance: float = 0.1
    n_hyperparam_combos: int = 10
    model_tuning_cv_folds_count: int = 5
    include_ensemble_voters: bool = True
    model_tuning_scoring: str = "f1_macro"
    final_min_performance_metric: str = "f1_macro"
    final_min_performance: float = 0.0
    refit_on_all: bool = False

    def __post_init__(self):
        def fail(name, wanted):
            raise ValueError(f"{name}={getattr(self, name)!r} is not valid: {wanted}")

        for name, allowed in CHOICES.items():
            if getattr(self, name) not in allowed:
                fail(name, f"one of {', '.join(allowed)}")
        for names, least in ((AT_LEAST_ONE, 1), (AT_LEAST_TWO, 2)):
            for name in names:
                value = getattr(self, name)
                if not isinstance(value, int) or isinstance(value, bool) or value < least:
                    fail(name, f"an int of at least {least}")
        for name in SIZES:
            value = getattr(self, name)
            if isinstance(value, bool) or not isinstance(value, (int, float)) or value <= 0 or (isinstance(value, float) and value > 1):
                fail(name, "a positive int or a float in (0, 1]")
        for name in SHARES:
            value = getattr(self, name)
            if isinstance(value, bool) or not isinstance(value, (int, float)) or not 0 <= value <= 1:
                fail(name, "a number in [0, 1]")
        for name in ("bi_cols_term_count", "tri_cols_term_count"):
            value = getattr(self, name)
            if value is not None and (not isinstance(value, int) or isinstance(value, bool) or value < 0):
                fail(name, "None or an int of at least 0")
        for name in ("feature_col_name", "label_col_name", "id_col_name"):
            if not isinstance(getattr(self, name), str) or not getattr(self, name):
                fail(name, "a column name")
        for field in fields(self):
            if field.type == "bool" and not isinstance(getattr(self, field.name), bool):
                fail(field.name, "True or False")
        if not isinstance(self.random_state, int) or isinstance(self.random_state, bool):
            fail("random_state", "an int")

    @classmethod
    def of(cls, settings: dict) -> "TrainingParams":
        """From a dict; an unknown name is an error."""
        known = {f.name for f in fields(cls)}
        unknown = sorted(set(settings) - known)
        if unknown:
            raise AttributeError(f"unknown setting: {', '.join(unknown)}")
        return cls(**settings)

    def profile(self, kind: str) -> JunkProfile:
        """Junk rules of ``lemmas``, ``bi_cols`` or ``tri_cols``."""
        if kind not in ("lemmas", "bi_cols", "tri_cols"):
            raise ValueError(f"unknown junk profile: {kind}")
        return JunkProfile(**{f.name: getattr(self, f"{kind}_{f.name}") for f in fields(JunkProfile)})
