"""One query per operator, each over whole tables. ``oracles`` holds the SQL they are checked with."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verbalis.functions import text as T
from verbalis.learners import families as Fam
from verbalis.learners.scored import compacted
from verbalis.learners.voting import VotingModel
from verbalis.operators import cleaning as C
from verbalis.operators import metrics as M
from verbalis.operators import neighbours as Nb
from verbalis.operators import ngrams as N
from verbalis.operators import records as Rec
from verbalis.operators import rowstats as R
from verbalis.operators import sampling as Sa
from verbalis.operators import selection as S
from verbalis.operators import vectorize as V
from verbalis.operators import vocabulary as Y
from verbalis.params import TrainingParams
from verbalis.plans import data as D
from verbalis.plans import features as Fe
from verbalis.plans import fixtures
from verbalis.plans import search as Se
from verbalis.plans.training import AutoTextClassifier, load_model, score
from verbalis.sources import tables
from verbalis.sources.workbooks import parse_workbooks
from verbalis.streaming.scoring import read_scored, read_text_stream, score_stream

SEED = 5
SETTINGS = TrainingParams(number_of_records_to_include=1.0, min_records_per_class=20)
NAMES = R.feature_names()
QUERIES: dict = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def _round(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# ---- sources, records -------------------------------------------------------------------------------------------


@query
def read_csv_project(spark: SparkSession, sf: str) -> DataFrame:
    """All documents written as CSV and read back by column name."""
    path = f"{D.workspace(spark, sf).path}/documents.csv"
    tables.write_csv(D.documents(spark, sf), path, header=True)
    return tables.read_labelled(spark, path, "text", "lang", fmt="csv").withColumnRenamed("lang", "label")


@query
def write_rows(spark, sf):
    """Headless CSV rows and back, by position."""
    path = f"{D.workspace(spark, sf).path}/turns.csv"
    turns = D.table(spark, sf, "conversations").select(F.col("conv_id").cast("string"), F.col("turn").cast("string"), "role", "text")
    tables.write_csv(turns, path)
    reader = spark.read.schema("conv_id string, turn string, role string, text string").option("multiLine", True)
    return reader.option("escape", '"').option("lineSep", "\n").csv(path)


@query
def read_labelled_parquet(spark, sf):
    return tables.read_labelled(spark, f"{sf}/documents.parquet", "text", "source", "doc_id").withColumnRenamed("source", "label")


@query
def labelled_records(spark, sf):
    """Text of every document, null labels dropped."""
    joined = D.documents(spark, sf).join(D.table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return Rec.labelled_records(joined, "doc_id", "text", "quality")


def _turns(spark, sf):
    turn_id = F.concat_ws("-", F.col("conv_id"), F.col("turn"))
    return D.table(spark, sf, "conversations").select(turn_id.alias("doc_id"), "text", F.col("role").alias("label"))


@query
def rare_class_filter(spark, sf):
    return Rec.keep_frequent_classes(_turns(spark, sf), 50)


@query
def class_counts(spark, sf):
    return Rec.class_sizes(Rec.require_classes(_turns(spark, sf)))


# ---- sampling and splitting -------------------------------------------------------------------------------------


def _by_source(spark, sf):
    return D.documents(spark, sf).select("doc_id", F.col("lang").alias("label"))


@query
def subsample_stratified(spark, sf):
    return Sa.subsample(_by_source(spark, sf), 0.05, "stratified", SEED)


@query
def subsample_random(spark, sf):
    return Sa.subsample(_by_source(spark, sf), 77, "random", SEED)


@query
def split_stratified(spark, sf):
    return Sa.holdout_split(_by_source(spark, sf), 0.2, "stratified", SEED)


@query
def split_random(spark, sf):
    return Sa.holdout_split(_by_source(spark, sf), 0.2, "random", SEED)


@query
def split_class_shares(spark, sf):
    return _round(Sa.class_shares(Sa.holdout_split(_by_source(spark, sf), 0.2, "stratified", SEED)), "share")


@query
def capped_pool(spark, sf):
    """A stratified pool of 300 rows of the train side."""
    split = Sa.holdout_split(_by_source(spark, sf), 0.2, "stratified", SEED)
    return Sa.subsample(split.filter("split = 'train'").drop("split"), 300, "stratified", SEED)


@query
def kfold_assign(spark, sf):
    return Sa.stratified_folds(_by_source(spark, sf), 5, SEED)


# ---- cleaning ---------------------------------------------------------------------------------------------------


def _words(spark, sf):
    return T.with_record_words(D.documents(spark, sf).select("doc_id", "text"), "text")


def _tokens(spark, sf):
    return C.token_table(_words(spark, sf))


@query
def tokens(spark, sf):
    return _tokens(spark, sf)


@query
def stop_words_removed(spark, sf):
    """Tokens left per document by the case-sensitive and by the lowercased stop-word test."""
    docs = D.documents(spark, sf).select("doc_id", T.tokens("text").alias("all"), T.corpus_tokens("text").alias("low"))
    return docs.select(
        "doc_id",
        F.size("all").cast("bigint").alias("tokens"),
        F.size(T.drop_words("all")).cast("bigint").alias("kept_raw_case"),
        F.size(T.drop_words("low")).cast("bigint").alias("kept_lower"),
    )


def _vocabulary_words(spark, sf):
    return C.distinct_words(_tokens(spark, sf))


@query
def alpha_words(spark, sf):
    return _vocabulary_words(spark, sf).filter(T.is_alpha(F.col("word")))


@query
def word_classes(spark, sf):
    """Alphabetic, numeric and alphanumeric tests of every distinct word."""
    word = F.col("word")
    return _vocabulary_words(spark, sf).select(
        "word", T.is_alpha(word).alias("alpha"), T.is_number(word).alias("number"), T.is_alphanumeric(word).alias("alphanumeric")
    )


@query
def dictionary_words(spark, sf):
    return _vocabulary_words(spark, sf).join(D.lexicons(spark, sf).dictionary, "word", "left_semi")


@query
def proper_noun_words(spark, sf):
    """Words accepted only as proper nouns: here the words of the benchmark items are the list of names."""
    names = D.table(spark, sf, "benchmark").select(F.explode(T.corpus_tokens("text")).alias("word")).distinct()
    lexicons = D.lexicons(spark, sf).with_tables(proper_nouns=names)
    profile = C.JunkProfile(allow_proper_nouns=True)
    words = _vocabulary_words(spark, sf)
    return C.good_words(words, lexicons, profile).join(C.good_words(words, lexicons), "word", "left_anti")


PROFILES = {
    "lemmas": C.JunkProfile(),
    "no_dictionary": C.JunkProfile(are_dictionary=False),
    "with_numbers": C.JunkProfile(allow_number=True),
}


@query
def junk_filter(spark, sf):
    """Words kept by three junk profiles."""
    words, lexicons = _vocabulary_words(spark, sf), D.lexicons(spark, sf)
    parts = [C.good_words(words, lexicons, p).withColumn("profile", F.lit(n)) for n, p in PROFILES.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def excluded_words(spark, sf):
    tokens = _tokens(spark, sf)
    return C.excluded_words(tokens, C.good_words(C.distinct_words(tokens), D.lexicons(spark, sf)))


@query
def good_tokens(spark, sf):
    tokens = _tokens(spark, sf)
    return C.keep_good(tokens, C.good_words(C.distinct_words(tokens), D.lexicons(spark, sf)))


@query
def pos_tags(spark, sf):
    return C.pos_tags(_vocabulary_words(spark, sf), D.lexicons(spark, sf).pos)


@query
def lemmas(spark, sf):
    lexicons = D.lexicons(spark, sf)
    return C.lemmas(C.pos_tags(_vocabulary_words(spark, sf), lexicons.pos), lexicons)


@query
def lemma_tokens(spark, sf):
    """Kept tokens with tag and lemma, by joins."""
    return C.lemma_tokens(_tokens(spark, sf), D.lexicons(spark, sf))


def _cleaned(spark, sf):
    return D.cleaner(spark, sf).transform(D.documents(spark, sf).select("doc_id", "text"))


@query
def lemma_phrases(spark, sf):
    """Lemmas of each document as one string, by the narrow cleaner."""
    return _cleaned(spark, sf).select("doc_id", F.array_join("lemmas", " ").alias("lemma_phrase"))


@query
def lemma_phrases_joined(spark, sf):
    """The same by joins over exploded tokens."""
    kept = C.lemma_tokens(_tokens(spark, sf), D.lexicons(spark, sf))
    return C.lemma_phrases(D.documents(spark, sf), kept)


@query
def sentence_counts(spark, sf):
    return D.documents(spark, sf).select("doc_id", T.sentence_count("text").alias("sentences"))


# ---- corpus statistics and vocabulary ---------------------------------------------------------------------------


def _corpus(spark, sf):
    """The word arrays from which n-grams are counted, kept as a table: every count is then a pass over words only."""

    def build():
        words = T.with_corpus_words(D.documents(spark, sf).select("doc_id", "text"), "text").drop("text")
        return D.workspace(spark, sf).keep(words, "corpus")

    return D.once(spark, sf, "corpus", build)


def _corpus_counts(spark, sf):
    """Word counts of the corpus, kept as a table for all scores."""
    return D.once(spark, sf, "word_counts", lambda: D.workspace(spark, sf).keep(N.word_counts(_corpus(spark, sf)), "corpus_word_counts"))


@query
def distinct_words(spark, sf):
    return Y.distinct_text_words(D.documents(spark, sf))


@query
def distinct_bigrams(spark, sf):
    return N.ngram_table(_corpus(spark, sf), 2).select("w1", "w2").distinct()


@query
def distinct_trigrams(spark, sf):
    return N.ngram_table(_corpus(spark, sf), 3).select("w1", "w2", "w3").distinct()


@query
def word_freq(spark, sf):
    return N.word_counts(_corpus(spark, sf))


@query
def bigram_freq(spark, sf):
    return N.ngram_counts(_corpus(spark, sf), 2)


@query
def trigram_freq(spark, sf):
    return N.ngram_counts(_corpus(spark, sf), 3)


@query
def skipgram_freq(spark, sf):
    return N.skipgram_counts(_corpus(spark, sf))


@query
def bigram_collocations(spark, sf):
    corpus = _corpus(spark, sf).withColumnRenamed("words", "corpus_words")
    return Fe.collocations(corpus, D.lexicons(spark, sf), SETTINGS, 2, _corpus_counts(spark, sf)).select("term", "score")


@query
def trigram_collocations(spark, sf):
    corpus = _corpus(spark, sf).withColumnRenamed("words", "corpus_words")
    return Fe.collocations(corpus, D.lexicons(spark, sf), SETTINGS, 3, _corpus_counts(spark, sf)).select("term", "score")


@query
def bigram_scores(spark, sf):
    """Scores of all frequent bigrams, junk words included."""
    return N.bigram_scores(_corpus(spark, sf), None, 20, counts=_corpus_counts(spark, sf)).select("w1", "w2", "n12", "n1", "n2", "score")


@query
def trigram_scores(spark, sf):
    return N.trigram_scores(_corpus(spark, sf), None, 10, counts=_corpus_counts(spark, sf)).select("w1", "w2", "w3", "n123", "score")


@query
def lemma_vocab(spark, sf):
    return Y.lemma_vocabulary(_cleaned(spark, sf))


def _phrases(spark, sf, n):
    """All frequent n-grams of any words as terms, so that the redundancy rules have something to drop."""
    corpus, counts = _corpus(spark, sf), _corpus_counts(spark, sf)
    scores = N.bigram_scores(corpus, None, 20, counts=counts) if n == 2 else N.trigram_scores(corpus, None, 10, counts=counts)
    return N.top_collocations(scores, n, 300 if n == 2 else 200).select("term")


@query
def redundant_lemmas(spark, sf):
    """Lemmas dropped because a chosen bigram holds them."""
    vocab = Y.lemma_vocabulary(_cleaned(spark, sf)).select("term")
    return vocab.join(Y.drop_redundant_lemmas(vocab, _phrases(spark, sf, 2)), "term", "left_anti")


@query
def redundant_bigrams(spark, sf):
    """Bigrams left after those that start or end a chosen trigram are dropped."""
    return Y.drop_redundant_bigrams(_phrases(spark, sf, 2), _phrases(spark, sf, 3))


def _train(spark, sf):
    """Cleaned labelled records and their vocabulary, kept as tables."""

    def build():
        space = D.workspace(spark, sf)
        docs = Fe.cleaned_records(D.labelled(spark, sf), D.cleaner(spark, sf)).drop("text")
        cleaned = space.keep(docs, "cleaned")
        return cleaned, Fe.build_vocabulary(cleaned, D.lexicons(spark, sf), SETTINGS, space)

    return D.once(spark, sf, "train", build)


@query
def term_vocab(spark, sf):
    return _train(spark, sf)[1]


@query
def corpus_counts(spark, sf):
    words = Y.distinct_text_words(D.labelled(spark, sf)).count()
    return Y.corpus_counts(words, _train(spark, sf)[1])


# ---- record statistics ------------------------------------------------------------------------------------------


@query
def row_word_stats(spark, sf):
    docs = _words(spark, sf)
    stats = R.word_stats()
    return docs.select("doc_id", *[F.round(stats[n], 6).alias(n) for n in R.WORD_FEATURES])


@query
def row_pos_ratios(spark, sf):
    tokens = _tokens(spark, sf)
    tags = C.pos_tags(C.distinct_words(tokens), D.lexicons(spark, sf).pos)
    return _round(R.tag_ratios(D.documents(spark, sf), tokens, tags), *R.TAG_FEATURES.values())


@query
def row_sentiment(spark, sf):
    out = R.sentiment(D.documents(spark, sf), _tokens(spark, sf), D.lexicons(spark, sf).sentiment)
    return _round(out, *R.SENTIMENT_FEATURES)


@query
def row_features(spark, sf):
    """All twelve statistics by the narrow cleaner."""
    return _round(_cleaned(spark, sf).select("doc_id", *NAMES), *NAMES)


# ---- vectors ----------------------------------------------------------------------------------------------------


def _counts(spark, sf, kinds=Fe.KINDS, presence=False):
    cleaned, vocab = _train(spark, sf)
    return V.term_counts(cleaned, vocab, kinds, presence=presence)


@query
def count_unigrams(spark, sf):
    return _counts(spark, sf, ("lemma",))


@query
def count_bigrams(spark, sf):
    return _counts(spark, sf, ("bigram",))


@query
def count_trigrams(spark, sf):
    return _counts(spark, sf, ("trigram",))


@query
def presence(spark, sf):
    return _counts(spark, sf, presence=True)


def _kept_counts(spark, sf, keep=("doc_id",)):
    """Term counts kept as a table: document frequencies and weights both need them, and texts are counted once."""

    def build():
        cleaned, vocab = _train(spark, sf)
        return D.workspace(spark, sf).keep(V.term_counts(cleaned, vocab, keep=keep), "counts_by_" + "_".join(keep))

    return D.once(spark, sf, ("counts", keep), build)


def _n_docs(cleaned: DataFrame):
    return cleaned.select(F.count(F.lit(1)).alias("n")).scalar()


@query
def idf(spark, sf):
    cleaned, vocab = _train(spark, sf)
    return _round(V.inverse_document_frequency(_kept_counts(spark, sf), vocab, _n_docs(cleaned)), "idf")


def _tfidf(spark, sf, keep=("doc_id",)):
    cleaned, vocab = _train(spark, sf)
    counts = _kept_counts(spark, sf, keep)
    return V.tfidf(counts, V.inverse_document_frequency(counts, vocab, _n_docs(cleaned)))


@query
def tfidf(spark, sf):
    return _round(_tfidf(spark, sf), "value")


@query
def tfidf_l2(spark, sf):
    return _round(V.l2_rows(_tfidf(spark, sf)), "value")


def _long_stats(spark, sf):
    cleaned, _ = _train(spark, sf)
    return V.long_stats(cleaned.select("doc_id", "label", *NAMES), NAMES, ("doc_id", "label"))


@query
def minmax_meta(spark, sf):
    long = _long_stats(spark, sf)
    return _round(V.minmax_scale(long, V.minmax_bounds(long)).select("doc_id", "name", "value"), "value")


def _features(spark, sf):
    """Term weights and scaled statistics with labels, kept as a table."""

    def build():
        cleaned, vocab = _train(spark, sf)
        values = V.l2_rows(_tfidf(spark, sf, ("doc_id", "label")))
        long = _long_stats(spark, sf)
        values = V.append_stats(values, V.minmax_scale(long, V.minmax_bounds(long)), NAMES, _n_docs(vocab))
        return D.workspace(spark, sf).keep(values, "features")

    return D.once(spark, sf, "features", build)


@query
def feature_table(spark, sf):
    return _round(_features(spark, sf), "value")


def _sizes(spark, sf):
    return Rec.class_sizes(_train(spark, sf)[0])


@query
def chi2_scores(spark, sf):
    return S.chi2_scores(S.class_moments(_features(spark, sf)), _sizes(spark, sf))


@query
def f_scores(spark, sf):
    return S.f_scores(S.class_moments(_features(spark, sf)), _sizes(spark, sf))


@query
def mi_scores(spark, sf):
    bins = S.bin_counts(_features(spark, sf), _n_docs(_train(spark, sf)[1]))
    return S.mi_scores(bins, _sizes(spark, sf))


def _selected(spark, sf):
    def build():
        _, vocab = _train(spark, sf)
        n_terms = vocab.count()
        scores = S.chi2_scores(S.class_moments(_features(spark, sf)), _sizes(spark, sf))
        catalog = Fe.feature_catalog(vocab, NAMES, n_terms)
        k = Fe.selection_size(n_terms + len(NAMES), SETTINGS.n_selected_features)
        selected = S.select_k_best(scores, catalog, k)
        return D.workspace(spark, sf).keep(selected, "selected"), catalog

    return D.once(spark, sf, "selected", build)


@query
def select_k_best(spark, sf):
    return _selected(spark, sf)[0].select("term_id", "name", "feature")


def _chosen_values(spark, sf):
    return S.apply_selection(_features(spark, sf).drop("label"), _selected(spark, sf)[0])


@query
def selected_values(spark, sf):
    return _round(_chosen_values(spark, sf), "value")


@query
def drop_zero_vectors(spark, sf):
    return S.records_with_values(_chosen_values(spark, sf))


@query
def renormalised(spark, sf):
    return _round(V.l2_rows(_chosen_values(spark, sf)), "value")


@query
def selection_summary(spark, sf):
    cleaned, _ = _train(spark, sf)
    selected, catalog = _selected(spark, sf)
    return S.selection_summary(cleaned, catalog, selected, _chosen_values(spark, sf))


@query
def separating_words(spark, sf):
    """The fifty words that separate the quality classes best, by chi-squared of TF-IDF weights (flagship query)."""
    docs = D.labelled(spark, sf)
    words = docs.select("doc_id", "label", T.corpus_tokens("text").alias("lemmas"))
    words = D.workspace(spark, sf).keep(words.withColumn("lemmas", T.drop_words("lemmas")), "labelled_words")
    terms = Y.lemma_vocabulary(words, "lemmas", 20, 3).select("term")
    empty = terms.filter(F.lit(False))
    vocab = Y.term_union(terms, empty, empty)
    counts = V.term_counts(words, vocab, ("lemma",), keep=("doc_id", "label"))
    idf = V.inverse_document_frequency(counts, vocab, _n_docs(words))
    values = V.l2_rows(V.tfidf(counts, idf))
    scores = S.chi2_scores(S.class_moments(values), Rec.class_sizes(words))
    catalog = vocab.select("term_id", F.col("term").alias("name"))
    return S.select_k_best(scores, catalog, 50).select("name", "score", "feature")


# ---- scaling of numeric features, votes and metrics --------------------------------------------------------------


@query
def standard_scale(spark, sf):
    """Every embedding dimension to zero mean and unit deviation."""
    long = D.table(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("dim", "value"))
    long = long.withColumn("value", F.col("value").cast("double"))
    return _round(V.standard_scale(long, ("dim",)), "value", digits=5)


def _split_docs(spark, sf):
    docs = D.documents(spark, sf).select("doc_id", "source", F.col("lang").alias("label"), F.length("text").alias("chars"))
    return Sa.holdout_split(docs, 0.2, "stratified", SEED)


RULES = ("source", "length", "all")


def _rule_probabilities(spark, sf) -> DataFrame:
    """``model, doc_id, label, probability`` of three simple models for the test side.

    Each model looks at one property of a document and gives the class shares of the train side for it.
    """

    def build():
        split = _split_docs(spark, sf)
        keys = F.array(F.col("source"), F.log2(F.col("chars") + 1).cast("int").cast("string"), F.lit("all"))
        models = F.arrays_zip(F.array(*[F.lit(r) for r in RULES]).alias("model"), keys.alias("key"))
        rows = split.select("doc_id", "label", "split", F.inline(models))
        train = rows.filter("split = 'train'").groupBy("model", "key", "label").agg(F.count(F.lit(1)).alias("n"))
        total = F.sum("n").over(W.partitionBy("model", "key"))
        shares = train.select("model", "key", F.col("label").alias("prediction"), (F.col("n") / total).alias("probability"))
        test = rows.filter("split = 'test'").select("model", "key", "doc_id", F.col("label").alias("truth"))
        out = test.join(shares, ["model", "key"]).drop("key")
        return D.workspace(spark, sf).keep(out, "rule_probabilities")

    return D.once(spark, sf, "rule_probabilities", build)


def _rule_predictions(spark, sf) -> DataFrame:
    """``model, doc_id, label, prediction``: the likeliest class, ties to the lowest label."""
    best = F.max_by("prediction", F.struct("probability", F.expr("-ascii(prediction)"), F.expr("-ascii(substring(prediction, 2))")))
    return (
        _rule_probabilities(spark, sf)
        .withColumn("probability", F.round("probability", 9))
        .groupBy("model", "doc_id", F.col("truth").alias("label"))
        .agg(best.alias("prediction"))
    )


@query
def vote_hard(spark, sf):
    return M.vote_hard(_rule_predictions(spark, sf))


@query
def vote_soft(spark, sf):
    return M.vote_soft(_rule_probabilities(spark, sf).withColumnRenamed("prediction", "label"))


@query
def confusion(spark, sf):
    return M.confusion(_rule_predictions(spark, sf), ("model",))


@query
def confusion_matrix(spark, sf):
    source = _rule_predictions(spark, sf).filter("model = 'length'")
    return M.confusion_matrix(source, ["de", "en", "es", "fr"])


def _fold_predictions(spark, sf):
    folds = Sa.stratified_folds(_by_source(spark, sf).select("doc_id", "label"), 5, SEED).select("doc_id", "fold")
    return _rule_predictions(spark, sf).join(folds, "doc_id")


@query
def accuracy_folds(spark, sf):
    return _round(M.fold_accuracy(_fold_predictions(spark, sf), ("model",)), "accuracy")


def _summary(spark, sf):
    return M.summary(M.confusion(_rule_predictions(spark, sf), ("model",)), ("model",))


@query
def balanced_accuracy(spark, sf):
    return _round(_summary(spark, sf).select("model", "balanced_accuracy"), "balanced_accuracy")


@query
def macro_prf(spark, sf):
    return _round(_summary(spark, sf).select("model", "precision", "recall", "f1_macro"), "precision", "recall", "f1_macro")


@query
def micro_f1(spark, sf):
    return _round(_summary(spark, sf).select("model", "f1_micro"), "f1_micro")


@query
def classification_report(spark, sf):
    predictions = _rule_predictions(spark, sf).filter("model = 'length'")
    return _round(M.report(M.confusion(predictions)), "precision", "recall", "f1")


@query
def rank_models(spark, sf):
    """The two best models by macro F1 among those that reach 0.1."""
    order = F.array_position(F.array(*[F.lit(r) for r in RULES]), F.col("model"))
    table = _summary(spark, sf).withColumn("model_order", order)
    table = _round(table, "f1_macro")
    return M.rank_models(table, "f1_macro", 0.1, 2).select("model", "f1_macro")


@query
def passing_models(spark, sf):
    """Models that reach a macro F1 of 0.15."""
    table = _round(_summary(spark, sf), "f1_macro").withColumn("model_order", F.lit(0))
    return M.rank_models(table, "f1_macro", 0.15).select("model", "f1_macro")


# ---- classifiers ------------------------------------------------------------------------------------------------


def _vectors(spark, sf) -> DataFrame:
    """The embeddings as training rows: ``doc_id, label, label_index, features, split``."""

    def build():
        rows = D.table(spark, sf, "embeddings").select(
            F.col("vec_id").alias("doc_id"),
            F.col("label").cast("string").alias("label"),
            F.col("label").cast("double").alias("label_index"),
            array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
        )
        split = Sa.holdout_split(rows, 0.2, "stratified", SEED)
        return D.workspace(spark, sf).keep(compacted(split, rows.count(), 64), "vectors")

    return D.once(spark, sf, "vectors", build)


def _sides(spark, sf):
    vectors = _vectors(spark, sf)
    return vectors.filter("split = 'train'").drop("split"), vectors.filter("split = 'test'").drop("split")


TASK = Fam.Task(classes=10, features=64, seed=SEED)


def _predicted(model, test: DataFrame) -> DataFrame:
    return model.transform(test).select("doc_id", "label", F.col("prediction").cast("int").cast("string").alias("prediction"))


def _family_query(family: str):
    def run(spark, sf):
        train, test = _sides(spark, sf)
        return _predicted(Fam.build(family, TASK).fit(train), test)

    run.__name__ = f"clf_{family}"
    run.__doc__ = f"Hold-out predictions of a {family} classifier fitted on the train side of the embeddings."
    return query(run)


for _family in Fam.FAMILIES:
    _family_query(_family)


@query
def calibrated_svm(spark, sf):
    """Hold-out predictions of the calibrated linear SVM."""
    train, test = _sides(spark, sf)
    return _predicted(Fam.build("linear_svm", TASK, final=True).fit(train), test)


@query
def knn_predict(spark, sf):
    """Five nearest train rows of every test row, and their majority label."""
    train, test = _sides(spark, sf)
    array = vector_to_array("features").alias("x")
    near = Nb.neighbours(
        test.select(F.col("doc_id").alias("query_id"), array),
        train.select(F.col("doc_id").alias("id"), array, F.col("label_index").cast("int").alias("label")),
        5,
    )
    return Nb.majority(near)


@query
def voting_models(spark, sf):
    """Soft vote of three fitted models."""
    train, test = _sides(spark, sf)
    models = [Fam.build(f, TASK).fit(train) for f in ("logistic", "knn", "random_forest")]
    return _predicted(VotingModel(models, "soft"), test)


@query
def cv_predictions(spark, sf):
    """Out-of-fold predictions of all rows."""
    vectors = _vectors(spark, sf).drop("split")
    data = compacted(Sa.stratified_folds(vectors, 5, SEED), vectors.count(), 64)
    return Se.cross_predictions(Fam.build("decision_tree", TASK), data, 5)


@query
def random_search(spark, sf):
    """Best drawn settings of a decision tree and its mean macro F1."""
    params = TrainingParams()
    train, _ = _sides(spark, sf)
    data = compacted(Sa.stratified_folds(train, params.model_tuning_cv_folds_count, SEED), train.count(), 64)
    tuned = Se.random_search("decision_tree", data, TASK, params)
    rows = [("score", str(round(tuned.score, 6)))] + [(k, str(v)) for k, v in sorted(tuned.settings.items())]
    return spark.createDataFrame(rows, "setting string, value string")


@query
def select_models(spark, sf):
    """Cross-validated metrics of all families on a capped pool."""
    train, _ = _sides(spark, sf)
    metrics, _, _ = Se.select_models(train, TASK, TrainingParams())
    return metrics


@query
def evaluate_best(spark, sf):
    """Hold-out metrics of a fitted model of every family."""
    train, test = _sides(spark, sf)
    tuned = [Se.Tuned(f, Fam.build(f, TASK).fit(train), {}, None) for f in Fam.FAMILIES]
    return Se.evaluate_models(test, tuned, TrainingParams())[0]


# ---- whole runs -------------------------------------------------------------------------------------------------


def _run(spark, sf):
    """A training run on the language of the documents, with all families and default search settings."""

    def build():
        params = TrainingParams(
            label_col_name="lang",
            number_of_records_to_include=1.0,
            min_records_per_class=20,
        )
        trainer = AutoTextClassifier(params, D.lexicons(spark, sf))
        return trainer.fit(D.documents(spark, sf).drop("source"))

    return D.once(spark, sf, "run", build)


@query
def fit_classifier(spark, sf):
    """Hold-out metrics of a whole training run."""
    return _run(spark, sf).evaluation


@query
def run_report(spark, sf):
    return _run(spark, sf).report()


@query
def score_documents(spark, sf):
    """Every document scored by the fitted model."""
    docs = D.documents(spark, sf).select("doc_id", "text", "lang")
    return score(_run(spark, sf).model, docs).select("doc_id", "lang", "predicted_label")


@query
def save_load_score(spark, sf):
    """The same after saving and loading the model."""
    path = f"{D.workspace(spark, sf).path}/saved"
    _run(spark, sf).save(path)
    docs = D.documents(spark, sf).select("doc_id", "text", "lang")
    return score(load_model(path), docs).select("doc_id", "lang", "predicted_label")


@query
def stream_score(spark, sf):
    """All conversation turns scored as a file stream."""
    space = D.workspace(spark, sf)
    turns = D.table(spark, sf, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("doc_id"), "text")
    landed = space.keep(turns, "turns")
    stream = read_text_stream(spark, f"{space.path}/turns", landed.schema)
    sink = f"{space.path}/scored-{uuid.uuid4().hex}"
    score_stream(_run(spark, sf).model, stream, sink, f"{sink}-checkpoint").awaitTermination()
    return read_scored(spark, sink).select("doc_id", "predicted_label")


@query
def read_xlsx(spark, sf):
    """Documents packed into workbooks by Spark and read back."""
    columns = ["doc_id", "text", "lang"]
    books = D.documents(spark, sf).select(F.col("doc_id").cast("string"), "text", "lang").mapInPandas(
        fixtures.pack_workbooks(columns), "content binary"
    )
    return parse_workbooks(books, columns).withColumnRenamed("lang", "label")
