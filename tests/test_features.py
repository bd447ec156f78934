import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from verbalis.functions.lexicons import seed_lexicons
from verbalis.operators import cleaning as C
from verbalis.operators import metrics as M
from verbalis.operators import ngrams as N
from verbalis.operators import rowstats as R
from verbalis.operators import selection as S
from verbalis.operators import vectorize as V
from verbalis.operators import vocabulary as Y
from verbalis.params import TrainingParams
from verbalis.plans import data as D
from verbalis.plans import features as Fe
from verbalis.plans.cleaner import OUTPUTS, TextCleaner
from verbalis.session import Workspace


def _long(spark, columns, labels):
    rows = [(i, labels[i], t, float(v)) for t, values in enumerate(columns) for i, v in enumerate(values) if v]
    features = spark.createDataFrame(rows, "doc_id int, label string, term_id int, value double")
    sizes = spark.createDataFrame([(c, labels.count(c)) for c in sorted(set(labels))], "label string, n bigint")
    return features, sizes


def _scores(df):
    return {r.term_id: r.score for r in df.collect()}


def test_chi2_worked_value(spark):
    features, sizes = _long(spark, [(1, 3, 2), (0, 0, 4)], ["0", "1", "1"])
    scores = _scores(S.chi2_scores(S.class_moments(features), sizes))
    # Column 0: O = (1, 5), E = (2, 4). Column 1: O = (0, 4), E = (4/3, 8/3).
    assert scores == {0: 0.75, 1: 2.0}


def test_f_worked_value(spark):
    features, sizes = _long(spark, [(1, 2, 5, 6), (0, 0, 3, 3)], ["a", "a", "b", "b"])
    scores = _scores(S.f_scores(S.class_moments(features), sizes))
    # Column 0: between 16 on 1, within 1 on 2. Column 1 separates perfectly.
    assert scores[0] == 32.0 and scores[1] == math.inf


def test_mutual_information_worked_value(spark):
    features, sizes = _long(spark, [(1, 1, 0, 0), (1, 0, 1, 0)], ["a", "a", "b", "b"])
    scores = _scores(S.mi_scores(S.bin_counts(features, 2), sizes))
    assert scores[0] == round(math.log(2), 6) and scores[1] == 0.0


def test_select_k_keeps_the_higher_column_on_ties(spark):
    catalog = spark.createDataFrame([(i, f"t{i}") for i in range(5)], "term_id int, name string")
    scores = spark.createDataFrame([(0, 1.0), (1, 1.0), (2, 5.0), (3, float("nan"))], "term_id int, score double")
    best = S.select_k_best(scores, catalog, 2).orderBy("feature").collect()
    assert [(r.term_id, r.feature) for r in best] == [(1, 0), (2, 1)]
    assert S.select_k_best(scores, catalog, 0).count() == 1


def test_idf_of_a_term_in_all_records_is_one(spark):
    counts = spark.createDataFrame([(d, 0, 1) for d in range(4)], "doc_id int, term_id int, tf bigint")
    vocab = spark.createDataFrame([(0,), (1,)], "term_id int")
    idf = {r.term_id: r.idf for r in V.inverse_document_frequency(counts, vocab, 4).collect()}
    assert idf[0] == 1.0 and idf[1] == pytest.approx(math.log(5) + 1)


def test_constant_column_scales_to_zero(spark):
    long = spark.createDataFrame([(i, "c", 5.0) for i in range(3)] + [(i, "v", float(i)) for i in range(3)], "doc_id int, name string, value double")
    scaled = V.minmax_scale(long, V.minmax_bounds(long)).collect()
    assert {r.value for r in scaled if r.name == "c"} == {0.0}
    assert sorted(r.value for r in scaled if r.name == "v") == [0.0, 0.5, 1.0]


def _collocations(spark, texts, n):
    docs = spark.createDataFrame([(i, t.split()) for i, t in enumerate(texts)], "doc_id int, words array<string>")
    score = N.bigram_scores if n == 2 else N.trigram_scores
    return {tuple(r[f"w{i + 1}"] for i in range(n)): r.score for r in score(docs, None, 1).collect()}


def test_bigram_g2_by_hand(spark):
    scores = _collocations(spark, ["a b", "a b", "c d"], 2)
    # a b: cells 2, 0, 0, 4 of 6 tokens with margins 2 and 2.
    expected = 2 * (2 * math.log(2 / (4 / 6)) + 4 * math.log(4 / (16 / 6)))
    assert scores[("a", "b")] == pytest.approx(expected, abs=1e-4)


def test_trigram_g2_by_hand(spark):
    scores = _collocations(spark, ["a b c", "a b c", "d e f"], 3)
    # 2 in the full cell, 0 with one or two of the words, 9 - 2 elsewhere as counted by inclusion and exclusion.
    n, cells = 9.0, {(1, 1, 1): 2.0, (0, 0, 0): 9.0 - 6 + 6 - 2}
    expected = 0.0
    for sides, o in cells.items():
        e = math.prod((2.0 if s else n - 2.0) for s in sides) / n**2
        expected += o * math.log(o / e)
    assert scores[("a", "b", "c")] == pytest.approx(2 * expected, abs=1e-4)


def _by_hand(texts, n, least):
    """Counts of the n-grams of frequent words, their words and pairs, as plain Python counts them."""
    words = Counter(w for t in texts for w in t or [])
    grams = Counter(tuple(t[i : i + n]) for t in texts for i in range(len(t or []) - n + 1))
    pairs = Counter(tuple(t[i : i + 2]) for t in texts for i in range(len(t or []) - 1))
    outer = Counter((t[i], t[i + 2]) for t in texts for i in range(len(t or []) - 2))
    kept = {g: c for g, c in grams.items() if c >= least and None not in g}
    if n == 2:
        return {(*g, c, *[words[w] for w in g]) for g, c in kept.items()}
    return {(*g, c, pairs[g[:2]], pairs[g[1:]], outer[g[0], g[2]], *[words[w] for w in g]) for g, c in kept.items()}


@pytest.mark.parametrize("numbered", [True, False])
@pytest.mark.parametrize("least", [1, 3])
def test_ngram_counts_are_those_by_hand(spark, monkeypatch, numbered, least):
    if not numbered:
        monkeypatch.setattr(N, "CODED_WORDS", 0)
    draw = random.Random(least)
    texts = [[draw.choice(["a", "b", "c", "é", "z", None]) for _ in range(draw.randrange(12))] for _ in range(60)] + [None, [], ["q"]]
    docs = spark.createDataFrame([(1, t) for t in texts], "doc_id int, words array<string>").repartition(3)
    bigrams = N.bigram_scores(docs, None, least).select("w1", "w2", "n12", "n1", "n2")
    assert sorted(map(tuple, bigrams.collect())) == sorted(_by_hand(texts, 2, least))
    trigrams = N.trigram_scores(docs, None, least).select("w1", "w2", "w3", "n123", "n12", "n23", "n13", "n1", "n2", "n3")
    assert sorted(map(tuple, trigrams.collect())) == sorted(_by_hand(texts, 3, least))


def test_many_trigrams_have_the_same_scores(spark, monkeypatch):
    """Tables too large to be broadcast are shuffled."""
    texts = ["a b c d", "a b c", "b c d a b c", "c c c c"]
    few = _collocations(spark, texts, 3)
    settle = N.settle
    monkeypatch.setattr(N, "settle", lambda df, most=1: (settle(df)[0], most > 1))
    assert _collocations(spark, texts, 3) == few


def test_no_frequent_words_no_ngrams(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "c"])], "doc_id int, words array<string>")
    assert N.bigram_scores(docs, None, 2).count() == N.trigram_scores(docs, None, 2).count() == 0


@pytest.mark.parametrize("n", [2, 3])
def test_occurrences_are_shuffled_as_numbers(spark, n, capsys):
    docs = spark.createDataFrame([(1, ["a", "b", "c"])], "doc_id int, words array<string>")
    kept = N.kept_word_counts(docs)
    score = N.bigram_scores if n == 2 else N.trigram_scores
    score(docs, None, 1, counts=kept).explain()
    plan = capsys.readouterr().out
    assert "hashpartitioning(w1" not in plan and "ArrayTransform" not in plan and "transform(" not in plan


def test_redundant_terms(spark):
    terms = lambda *t: spark.createDataFrame([(x,) for x in t], "term string")
    lemmas = Y.drop_redundant_lemmas(terms("new", "york", "city"), terms("new york"))
    assert [r.term for r in lemmas.collect()] == ["city"]
    bigrams = Y.drop_redundant_bigrams(terms("new york", "york city", "new city"), terms("new york city"))
    assert [r.term for r in bigrams.collect()] == ["new city"]


def test_term_ids_follow_kind_and_alphabet(spark):
    terms = lambda *t: spark.createDataFrame([(x,) for x in t], "term string")
    vocab = Y.term_union(terms("b", "a", "abcd", "abc"), terms("a b"), terms("a b c")).orderBy("term_id").collect()
    assert [(r.term_id, r.term, r.kind) for r in vocab] == [
        (0, "a", "lemma"), (1, "abc", "lemma"), (2, "abcd", "lemma"), (3, "b", "lemma"), (4, "a b", "bigram"), (5, "a b c", "trigram"),
    ]


def test_macro_f1_is_not_weighted(spark):
    pairs = [(0, 0), (0, 0), (0, 1), (1, 1), (2, 0)]
    predictions = spark.createDataFrame(pairs, "label int, prediction int")
    row = M.summary(M.confusion(predictions)).first()
    assert row.f1_macro == pytest.approx(4 / 9) and row.f1_micro == pytest.approx(0.6)
    assert row.balanced_accuracy == pytest.approx((2 / 3 + 1 + 0) / 3)


def test_votes_break_ties_to_the_lowest_label(spark):
    votes = spark.createDataFrame([(1, "b"), (1, "a"), (2, "b"), (2, "b"), (2, "a")], "doc_id int, prediction string")
    assert {r.doc_id: r.prediction for r in M.vote_hard(votes).collect()} == {1: "a", 2: "b"}
    shares = spark.createDataFrame([(1, "b", 0.5), (1, "a", 0.5), (2, "a", 0.2), (2, "b", 0.9)], "doc_id int, label string, probability double")
    assert {r.doc_id: r.prediction for r in M.vote_soft(shares).collect()} == {1: "a", 2: "b"}


def test_empty_record_has_zero_ratios(spark):
    cleaner = TextCleaner.build(seed_lexicons(spark))
    row = cleaner.transform(spark.createDataFrame([(1, ""), (2, None)], "doc_id int, text string")).collect()
    assert all(r[name] == 0.0 for r in row for name in R.ALL_FEATURES) and row[0].lemmas == []


PROFILES = [C.JunkProfile(), C.JunkProfile(are_dictionary=False), C.JunkProfile(allow_number=True), C.JunkProfile(are_alpha=False, are_not_stop=False)]


@pytest.mark.parametrize("profile", PROFILES)
def test_narrow_cleaner_equals_joins(spark, sf, profile):
    """The lookup in batches, the join form of the same stage, and the joins over the corpus words agree."""
    lexicons = D.lexicons(spark, sf)
    docs = D.documents(spark, sf).select("doc_id", "text")
    narrow = TextCleaner.build(lexicons, profile)
    joined = TextCleaner.build(lexicons, profile)
    joined.with_facts(joined._facts_table, max_rows=1)
    assert narrow._facts is not None and joined._facts is None
    columns = ["doc_id", "lemmas", *[F.round(n, 9).alias(n) for n in R.ALL_FEATURES]]
    a, b = narrow.transform(docs).select(*columns), joined.transform(docs).select(*columns)
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()
    from verbalis.functions.text import with_record_words

    tokens = C.token_table(with_record_words(docs, "text"))
    phrases = C.lemma_phrases(docs, C.lemma_tokens(tokens, lexicons, profile))
    ours = a.select("doc_id", F.array_join("lemmas", " ").alias("lemma_phrase"))
    assert ours.exceptAll(phrases).count() == 0


@pytest.mark.parametrize("joined", [False, True])
def test_cleaner_does_not_use_ids(spark, sf, joined):
    """Records with the same id, no id or text ids keep their own lemmas, in both forms."""
    cleaner = TextCleaner.build(D.lexicons(spark, sf), C.JunkProfile(are_dictionary=False))
    if joined:
        cleaner.with_facts(cleaner._facts_table, max_rows=1)
    assert cleaner.joins == joined
    texts = ["good men say", "bad feet", "", "good men say"]
    for ids in ([7, 7, 7, 7], [None] * 4, ["a", "a", None, "b"], None):
        kind = "doc_id string, text string" if ids and isinstance(ids[0], str) else "doc_id int, text string"
        rows = spark.createDataFrame(list(zip(ids or [1] * 4, texts)), kind)
        out = cleaner.transform(rows if ids else rows.drop("doc_id")).select("text", "lemmas").collect()
        lemmas = {(r.text, tuple(r.lemmas)) for r in out}
        assert len(out) == 4 and len(lemmas) == 3 and ("", ()) in lemmas


@pytest.mark.parametrize("settings", [{}, {"term_value": "presence"}, {"use_L2_row_normalization": False, "feature_selection_metric": "F"}, {"use_meta_features": False, "use_eng_features_subjectivity": False, "feature_selection_metric": "mutual_info"}, {"ngram_source": "clean", "remove_sub_terms": True, "n_selected_features": 40}])
def test_vector_stages_equal_the_long_tables(spark, sf, settings):
    """The saveable stages give the same numbers as the tables the scores were computed from."""
    params = TrainingParams(lemmas_freq_requirement=8, bi_cols_freq_requirement=5, tri_cols_freq_requirement=3, **settings)
    lexicons, space = D.lexicons(spark, sf), Workspace(spark)
    cleaner = Fe.build_cleaner(lexicons, params)
    cleaned = space.keep(Fe.cleaned_records(D.labelled(spark, sf), cleaner).select("doc_id", "label", "corpus_words", *OUTPUTS), "cleaned")
    model = Fe.fit_features(cleaned, lexicons, params, space)
    chosen = S.apply_selection(spark.read.parquet(f"{space.path}/values"), model.selected)
    if params.use_L2_row_normalization:
        chosen = V.l2_rows(chosen)
    vectors = PipelineModel(model.stages()).transform(cleaned)
    array = vectors.select("doc_id", F.posexplode(vector_to_array("features")).alias("feature", "value")).filter("value <> 0")
    a = {(r.doc_id, r.feature): r.value for r in array.collect()}
    b = {(r.doc_id, r.feature): r.value for r in chosen.collect()}
    assert a.keys() == b.keys() and len(a) > 50
    assert max(abs(a[k] - b[k]) for k in a) < 1e-9
    lengths = vectors.select(vector_to_array("features").alias("x")).toPandas()["x"].map(lambda x: float(np.linalg.norm(x)))
    if params.use_L2_row_normalization:
        assert all(abs(v - 1) < 1e-9 or v == 0 for v in lengths)
    space.drop()


def test_lexicons_are_shipped_as_bytes(spark, sf, monkeypatch):
    """A worker holds no object per word of a lexicon, and records are described in parts of a batch."""
    from verbalis.functions import wordfacts as Wf

    context, shipped = type(spark.sparkContext), []
    real = context.broadcast
    monkeypatch.setattr(context, "broadcast", lambda self, value: shipped.append(value) or real(self, value))
    facts = {"cats": ("n", True, "cat", 0.5, None), "run": ("v", False, "run", None, None), "nice": ("a", True, "nice", -0.25, 1.0)}
    words = [["cats", "run", "nice", "xyz", "cats"], [], ["nice"], ["quickly", "unknown"]] * 3
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id int, words array<string>").coalesce(1)
    rows = {}
    for size in (1000, 2):
        monkeypatch.setattr(Wf, "RECORDS", size)
        out = docs.select("doc_id", Wf.facts_column(spark, facts, C.JunkProfile())("words").alias("f")).select("doc_id", "f.*")
        rows[size] = [tuple(r) for r in out.orderBy("doc_id").collect()]
    assert rows[1000] == rows[2]
    assert rows[2][0][1] == ["cat", "nice", "cat"] and rows[2][0][2:7] == (3, 1, 1, 0, 0)
    assert rows[2][0][7:] == (0.25, 1 / 3)
    assert rows[2][1][1] == [] and rows[2][2][7:] == (-0.25, 1.0)
    assert isinstance(shipped[0][0], bytes)
