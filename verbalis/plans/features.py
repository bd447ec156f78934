"""Fitting the features: vocabulary, IDF, scaling bounds and selected columns; and the stages that apply them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    NGram,
    Normalizer,
    SQLTransformer,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbalis.functions import text as T
from verbalis.functions.lexicons import Lexicons
from verbalis.operators import cleaning as C
from verbalis.operators import ngrams as N
from verbalis.operators import rowstats as R
from verbalis.operators import selection as S
from verbalis.operators import vectorize as V
from verbalis.operators import vocabulary as Y
from verbalis.operators.records import class_sizes
from verbalis.params import TrainingParams
from verbalis.plans.cleaner import TextCleaner
from verbalis.session import Workspace

KINDS = ("lemma", "bigram", "trigram")
#: A model holds its terms: most terms of a vocabulary, tested as soon as it is built.
VOCABULARY_BOUND = 2_000_000


def build_cleaner(lexicons: Lexicons, params: TrainingParams) -> TextCleaner:
    return TextCleaner.build(
        lexicons,
        params.profile("lemmas"),
        params.lemmatize_unigrams,
        params.ngram_source,
        params.feature_col_name,
        params.id_col_name,
    )


def cleaned_records(docs: DataFrame, cleaner: TextCleaner, text_col: str = "text") -> DataFrame:
    """``docs`` cleaned, with ``corpus_words`` for the n-gram statistics. Narrow."""
    stop_words = tuple(cleaner.getOrDefault(cleaner.stopWords))
    return cleaner.transform(T.with_corpus_words(docs, text_col, "corpus_words", stop_words))


def collocations(cleaned: DataFrame, lexicons: Lexicons, params: TrainingParams, n: int, counts: DataFrame | None = None) -> DataFrame:
    """Top bigrams (n = 2) or trigrams (n = 3) by log-likelihood; ``counts`` are kept counts of ``corpus_words``."""
    kind = "bi_cols" if n == 2 else "tri_cols"
    counts = N.kept_word_counts(cleaned, "corpus_words") if counts is None else counts
    good = C.good_words(counts.select("word"), lexicons, params.profile(kind))
    score = N.bigram_scores if n == 2 else N.trigram_scores
    scores = score(cleaned, good, getattr(params, f"{kind}_freq_requirement"), "corpus_words", counts)
    return N.top_collocations(scores, n, getattr(params, f"{kind}_term_count"))


def build_vocabulary(cleaned: DataFrame, lexicons: Lexicons, params: TrainingParams, space: Workspace) -> DataFrame:
    """``term_id, term, kind``, kept as a table."""
    lemmas = Y.lemma_vocabulary(cleaned, "lemmas", params.lemmas_freq_requirement, params.lemmas_len_requirement)
    counts = space.keep(N.word_counts(cleaned, "corpus_words"), "word_counts")
    bigrams = space.keep(collocations(cleaned, lexicons, params, 2, counts).select("term", "score"), "bigrams")
    trigrams = space.keep(collocations(cleaned, lexicons, params, 3, counts).select("term", "score"), "trigrams")
    if params.remove_sub_terms:
        lemmas, bigrams = Y.drop_redundant_lemmas(lemmas, bigrams), Y.drop_redundant_bigrams(bigrams, trigrams)
    return space.keep(Y.term_union(lemmas.select("term"), bigrams, trigrams), "vocab")


@dataclass
class FeatureModel:
    """Everything learned about the features. Tables are small and kept; the rest are plain values."""

    vocab: DataFrame
    idf: DataFrame
    names: list[str]
    bounds: dict[str, tuple[float, float]]
    selected: DataFrame
    params: TrainingParams
    counts: dict[str, int] = field(default_factory=dict)

    def stages(self) -> list:
        """MLlib stages from the cleaner's columns to ``features``: narrow, persistable, usable on streams."""
        p = self.params
        binary = p.term_value == "presence"
        terms = [(r.term, r.kind) for r in self.vocab.orderBy("term_id").toLocalIterator()]
        stages, parts = [], []
        for n, kind in enumerate(KINDS, start=1):
            words = [t for t, k in terms if k == kind]
            if not words:
                continue
            source = "lemmas" if n == 1 else f"_grams{n}"
            if n > 1:
                stages.append(NGram(n=n, inputCol="gram_tokens", outputCol=source))
            counter = CountVectorizerModel.from_vocabulary(words, source, f"_counts{n}", binary=binary)
            stages.append(counter)
            parts.append(f"_counts{n}")
        inputs = []
        if parts:
            stages.append(VectorAssembler(inputCols=parts, outputCol="_terms"))
            last = "_terms"
            if p.use_tfidf_scaling and not binary:
                weights = [r.idf for r in self.idf.orderBy("term_id").toLocalIterator()]
                stages.append(ElementwiseProduct(scalingVec=Vectors.dense(weights), inputCol=last, outputCol="_tfidf"))
                last = "_tfidf"
                if p.use_L2_row_normalization:
                    stages.append(Normalizer(p=2.0, inputCol=last, outputCol="_unit"))
                    last = "_unit"
            inputs.append(last)
        if self.names:
            scaled = []
            for name in self.names:
                low, high = self.bounds[name]
                scaled.append(
                    f"0.0D AS `_{name}`" if high == low else f"(`{name}` - {low!r}D) / {high - low!r}D AS `_{name}`"
                )
            stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(scaled)} FROM __THIS__"))
            inputs += [f"_{name}" for name in self.names]
        stages.append(VectorAssembler(inputCols=inputs, outputCol="_all"))
        chosen = [r.term_id for r in self.selected.orderBy("feature").collect()]
        if p.use_L2_row_normalization:
            stages.append(VectorSlicer(inputCol="_all", outputCol="_selected", indices=chosen))
            stages.append(Normalizer(p=2.0, inputCol="_selected", outputCol="features"))
        else:
            stages.append(VectorSlicer(inputCol="_all", outputCol="features", indices=chosen))
        return stages


def feature_catalog(vocab: DataFrame, names: list[str], n_terms: int) -> DataFrame:
    """``term_id, name`` of every feature column."""
    stats = vocab.sparkSession.createDataFrame(
        [(n_terms + i, name) for i, name in enumerate(names)], "term_id bigint, name string"
    )
    return vocab.select("term_id", F.col("term").alias("name")).unionByName(stats)


def term_values(cleaned: DataFrame, vocab: DataFrame, n_docs: int, params: TrainingParams, keep=("doc_id", "label"), space: Workspace | None = None):
    """Long table of term values as the settings ask for them, and the IDF table.

    Both need the term counts; with ``space`` these and the IDF are kept, so that texts are counted once.
    """
    presence = params.term_value == "presence"
    counts = V.term_counts(cleaned, vocab, keep=keep, presence=presence)
    if space:
        counts = space.keep(counts, "term_counts")
    idf = V.inverse_document_frequency(counts, vocab, n_docs)
    if space:
        idf = space.keep(idf, "idf")
    if presence or not params.use_tfidf_scaling:
        return counts.select(*keep, "term_id", F.col("tf").cast("double").alias("value")), idf
    values = V.tfidf(counts, idf)
    return (V.l2_rows(values) if params.use_L2_row_normalization else values), idf


def feature_scores(features: DataFrame, sizes: DataFrame, metric: str, n_terms: int) -> DataFrame:
    if metric == "mutual_info":
        return S.mi_scores(S.bin_counts(features, n_terms), sizes)
    moments = S.class_moments(features)
    return S.chi2_scores(moments, sizes) if metric == "chi^2" else S.f_scores(moments, sizes)


def selection_size(n_features: int, wanted: int | float) -> int:
    return max(1, min(n_features, int(n_features * wanted) if isinstance(wanted, float) else wanted))


def fit_features(cleaned: DataFrame, lexicons: Lexicons, params: TrainingParams, space: Workspace) -> FeatureModel:
    """Learn the features from cleaned training records (``doc_id, label`` and the cleaner's columns)."""
    vocab = build_vocabulary(cleaned, lexicons, params, space)
    n_terms, n_docs = vocab.count(), cleaned.count()
    if n_terms > VOCABULARY_BOUND:
        raise ValueError("the vocabulary does not fit a model; raise the frequency requirements")
    names = R.feature_names(params.use_meta_features, params.use_eng_features_subjectivity)
    if n_terms + len(names) == 0:
        raise ValueError("no features: the vocabulary is empty and the record statistics are switched off")

    values, idf = term_values(cleaned, vocab, n_docs, params, space=space)
    bounds: dict[str, tuple[float, float]] = {}
    if names:
        long = V.long_stats(cleaned.select("doc_id", "label", *names), names, ("doc_id", "label"))
        limits = V.minmax_bounds(long)
        bounds = {r.name: (r.lo, r.hi) for r in limits.collect()}
        table = cleaned.sparkSession.createDataFrame(
            [(n, *b) for n, b in bounds.items()], "name string, lo double, hi double"
        )
        values = V.append_stats(values, V.minmax_scale(long, table), names, n_terms)
    values = space.keep(values, "values")
    space.drop("term_counts")
    catalog = feature_catalog(vocab, names, n_terms)
    scores = feature_scores(values, class_sizes(cleaned), params.feature_selection_metric, n_terms)
    k = selection_size(n_terms + len(names), params.n_selected_features)
    selected = space.keep(S.select_k_best(scores, catalog, k), "selected")
    words = cleaned.agg(F.sum(F.array_size("corpus_words")).alias("n")).first().n or 0
    sizes = Y.corpus_counts(words, vocab).first().asDict()
    counts = {**sizes, "term_count": n_terms, "features_count": n_terms + len(names), "selected_features_count": k}
    return FeatureModel(vocab, idf, names, bounds, selected, params, counts)


class TextFeatures(Estimator):
    """``fit`` on cleaned labelled records gives a saveable model from the cleaner's columns to ``features``."""

    def __init__(self, lexicons: Lexicons, params: TrainingParams, space: Workspace | None = None):
        super().__init__()
        self.lexicons, self.params, self.space = lexicons, params, space

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        space = self.space or Workspace(dataset.sparkSession)
        return PipelineModel(fit_features(dataset, self.lexicons, self.params, space).stages())
