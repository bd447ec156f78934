"""The automaton against the tokenizer library, and exact round trips."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from verbalis.llm import bpe
from verbalis.llm.queries import tokenizer_path

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def automaton():
    return bpe.MergeAutomaton.compiled(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


ALPHABETS = ["ab", "aaabb", "the in er", "  \n\t\x0b\x0c\r\x1c x'll 's", "éèüñ 漢字かな😀", "0123456789 .,!?", "aA lLeErR", "՘ᲀ\x85\xa0  a"]
ALPHABETS.append("".join(map(chr, range(32, 127))))


def test_random_texts_equal_the_library(automaton, library):
    draw = random.Random(3)
    encoder = bpe.Encoder(automaton)
    texts = ["".join(draw.choice(draw.choice(ALPHABETS)) for _ in range(draw.randint(0, 400))) for _ in range(600)]
    texts += ["", " ", "  ", " a", "a ", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext", "don't 'LL"]
    texts += ["a" * 5000, "\n" * 3000, " " * 5000 + "x", "=-" * 4000, "é" * 3000, "x" * 49, "the" * 17]
    for ids, other in zip(encoder(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert ids.tolist() == other.ids


def test_one_way_and_the_other_agree(automaton):
    draw = random.Random(5)
    words = ["".join(draw.choice("abetinor") for _ in range(draw.randint(1, bpe.SHORT))).encode() for _ in range(300)]
    assert automaton.encode_words(words) == [automaton._one(w) for w in words]


def test_paths_are_the_sequences_that_merging_yields(tmp_path):
    """All label pairs of a small vocabulary: an arc is there exactly if merging the joined bytes gives the pair back."""
    import json

    with open(PATH, encoding="utf-8") as f:
        data = json.load(f)
    merges = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]][:300]
    kept = {a + b for a, b in merges}
    data["model"]["merges"] = [list(m) for m in merges]
    data["model"]["vocab"] = {t: i for t, i in data["model"]["vocab"].items() if len(t) == 1 or t in kept}
    path = tmp_path / "small.json"
    path.write_text(json.dumps(data), encoding="utf-8")
    small, library = bpe.MergeAutomaton.compiled(str(path)), Tokenizer.from_file(str(path))
    of = {t: i for t, i in data["model"]["vocab"].items()}
    letters = {i: t for t, i in of.items() if t.isascii() and t.isalpha()}
    ids = sorted(letters)
    pairs = [(a, b) for a in ids for b in ids]
    arcs = small.has_arc(*(np.array(x) for x in zip(*pairs)))
    for (a, b), arc in zip(pairs, arcs):
        assert (library.encode(letters[a] + letters[b]).ids == [a, b]) == bool(arc)


def test_memory_bound_does_not_change_ids(automaton, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3000)
    encoder = bpe.Encoder(automaton)
    for k in range(20):
        text = " ".join(f"word{k}{i * i}" for i in range(50))
        assert encoder([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
        assert encoder.size <= 3000


def test_documents(edges, none, automaton, library):
    rows = bpe.decoded(bpe.encoded(edges, automaton), automaton)
    found = sorted((tuple(r) for r in rows.collect()), key=str)
    expected = []
    for r in edges.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        expected.append((r.doc_id, ids, library.decode(ids, skip_special_tokens=False)))
    assert found == sorted(expected, key=str)
    assert bpe.encoded(none, automaton).collect() == []


def test_decode_odd_ids(spark, automaton, library):
    pieces = library.encode("漢字😀 <|endoftext|> x").ids
    rows = spark.createDataFrame([(1, pieces), (2, pieces[1:]), (3, pieces[:-4]), (4, [])], "k int, ids array<int>")
    for r in bpe.decoded(rows, automaton).collect():
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False)
    odd = spark.createDataFrame([(1, None), (2, [10**6, -5])], "k int, ids array<int>")
    assert [r.decoded for r in bpe.decoded(odd, automaton).orderBy("k").collect()] == [None, ""]


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        bpe.MergeAutomaton.compiled(PATH.replace("byte_bpe_50k", "word_bpe_49k"))


def test_query_columns(spark, sf):
    from verbalis.llm.queries import op13_bpe

    out = op13_bpe(spark, sf)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.sha2("text", 256).alias("s"))
    assert out.join(texts, "doc_id").filter("decoded_sha256 <> s").count() == 0
