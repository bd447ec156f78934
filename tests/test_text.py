from pyspark.sql import functions as F

from verbalis.functions import text as T
from verbalis.functions.lexicons import seed_lexicons
from verbalis.operators import cleaning as C


def _one(spark, value, column):
    return spark.createDataFrame([(value,)], "text string").select(column.alias("c")).first().c


def test_tokens(spark):
    assert _one(spark, "a_b The the 3D naïve-café", T.tokens("text")) == ["The", "the", "3D", "naïve", "café"]
    assert _one(spark, "   ", T.tokens("text")) == []


def test_record_words_drop_stop_words_by_case(spark):
    df = spark.createDataFrame([("The men and the Cat",)], "text string")
    assert T.with_record_words(df, "text").first().words == ["the", "men", "cat"]
    assert T.with_corpus_words(df, "text").first().words == ["men", "cat"]


def test_raw_tokens_skip_single_characters(spark):
    assert _one(spark, "a bc d_e F", T.raw_tokens("text")) == ["bc", "d_e"]


def test_ngrams_stay_inside_a_record(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["d"],), ([],)], "words array<string>")
    rows = df.select(F.explode(T.ngrams("words", 2)).alias("g")).select("g.*").collect()
    assert [(r.w1, r.w2) for r in rows] == [("a", "b"), ("b", "c")]
    assert df.select(T.phrases("words", 3).alias("p")).first().p == ["a b c"]


def test_sentence_count(spark):
    cases = {"": 0, "One": 1, "One. Two": 2, "One. Two.": 2, "One?! Two. ": 2, "3.5 is one": 1, "Hi...": 1}
    for text, count in cases.items():
        assert _one(spark, text, T.sentence_count("text")) == count, text


def _words(spark, *words):
    return spark.createDataFrame([(w,) for w in words], "word string")


def test_tags_from_lexicon_then_suffix(spark):
    lexicons = seed_lexicons(spark)
    tags = C.pos_tags(_words(spark, "good", "quickly", "walked", "famous", "chair"), lexicons.pos)
    assert {r.word: r.tag for r in tags.collect()} == {"good": "a", "quickly": "r", "walked": "v", "famous": "a", "chair": "n"}


def test_lemmas(spark):
    lexicons = seed_lexicons(spark, _words(spark, "dog", "box", "make", "walk", "glass", "men", "fly"))
    tagged = spark.createDataFrame(
        [("dogs", "n"), ("boxes", "n"), ("making", "v"), ("walked", "v"), ("glass", "n"), ("men", "n"), ("unknowns", "n"), ("flies", "o")],
        "word string, tag string",
    )
    got = {r.word: r.lemma for r in C.lemmas(tagged, lexicons).collect()}
    assert got == {
        "dogs": "dog", "boxes": "box", "making": "make", "walked": "walk", "glass": "glass", "men": "man",
        "unknowns": "unknowns", "flies": "fly",
    }


def test_junk_profiles(spark):
    lexicons = seed_lexicons(spark, _words(spark, "good", "the", "bed")).with_tables(proper_nouns=_words(spark, "paris"))
    words = _words(spark, "good", "the", "bed", "paris", "42", "x9")
    kept = lambda **rules: {r.word for r in C.good_words(words, lexicons, C.JunkProfile(**rules)).collect()}
    assert kept() == {"good", "bed"}
    assert kept(are_not_stop=False) == {"good", "bed", "the"}
    assert kept(are_dictionary=False) == {"good", "bed", "paris"}
    assert kept(allow_number=True) == {"good", "bed", "42"}
    assert kept(allow_alphanum=True) == {"good", "the", "bed", "paris", "42", "x9"}
    assert kept(allow_proper_nouns=True) == {"good", "bed", "paris"}
