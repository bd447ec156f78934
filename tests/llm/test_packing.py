import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from verbalis.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def encoder():
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(PATH)
    out.encode_special_tokens = True
    return out


TRICKY = ["", " ", "a", " a", "a ", "a  b", "a\n b", "a \nb", "a\tb c", "it's we'll  x", "é ß ñ", "a b c", "x² y½ z",
          "<|endoftext|> a", "日本 語", "a\x1fb c", "a\r\nb c", "12 345 6", "word " * 50, "a.b, c;\nd e\n\nf", "x　y z", "a\x85b c"]


def test_chunks_have_the_ids_of_whole_texts():
    chunked, whole = packing.ChunkedTokenizer(PATH), encoder()
    for _ in range(2):
        for text, ids in zip(TRICKY, chunked(TRICKY)):
            assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab' .,!1\n\té\xa0 日²", max_size=30))
def test_chunks_of_any_text(text):
    ids = packing.ChunkedTokenizer.of(PATH)([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == encoder().encode(text, add_special_tokens=False).ids


def test_memory_of_chunks_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    chunked, whole = packing.ChunkedTokenizer(PATH), encoder()
    for text in ("a b c d e f", "c d g h", "a z"):
        assert np.frombuffer(chunked([text])[0], "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    assert len(chunked.ids) == 3


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_lower_bound_and_best_fit(lengths):
    lengths = np.array(sorted(lengths, reverse=True))
    bins, offsets = packing.best_fit(lengths, 20)
    at = defaultdict(int)
    for n, b, o in zip(lengths, bins, offsets):
        assert at[b] == o
        at[b] += n
    assert max(at.values()) <= 20

    def fewest(items, rooms):
        if not items:
            return len(rooms)
        n, best = items[0], math.inf
        for k in {r: k for k, r in enumerate(rooms) if r >= n}.values():
            best = min(best, fewest(items[1:], rooms[:k] + (rooms[k] - n,) + rooms[k + 1 :]))
        return min(best, fewest(items[1:], (*rooms, 20 - n))) if len(rooms) < best else best

    optimum = fewest(tuple(lengths.tolist()), ())
    assert packing.lower_bound(lengths, 20) <= optimum <= len(at)


def check(docs, out, limit):
    rows, whole = out.collect(), encoder()
    want = defaultdict(int)
    for r in docs.collect():
        ids = [*whole.encode(r.text or "", add_special_tokens=False).ids, 0]
        first = len(ids) if len(ids) <= limit else len(ids) % limit or limit
        cuts = [0, *range(first, len(ids) + 1, limit)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[r.doc_id, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    found = defaultdict(int)
    for r in rows:
        found[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
    assert found == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    return len(sequences), sum(r.length for r in rows)


def test_pack_documents(make_docs, space):
    rows = [(i, "some words " * (i * 31 % 90)) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, " \n"), (5, rows[5][1]), (None, "x y"), (1003, "z " * 3000)]
    docs = make_docs(rows)
    out = packing.pack_documents(docs, space, PATH, 256, group_rows=40)
    made, tokens = check(docs, out, 256)
    assert made <= -(-tokens // 256) + 2
    again = packing.pack_documents(docs.repartition(5), space, PATH, 256, group_rows=40)
    columns = ["doc_id", "piece", "ids_crc32", "sequence_id", "offset"]
    plain = lambda df: sorted(map(str, df.filter("length < 256").select(columns).collect()))
    assert plain(again) == plain(out)


def test_equal_rows_fill_sequences_together(make_docs, space):
    docs = make_docs([(None, None)] * 700 + [(None, "x y")] * 40 + [(1, "a b c")] * 30)
    out = packing.pack_documents(docs, space, PATH, 64, group_rows=50)
    made, tokens = check(docs, out, 64)
    assert made <= -(-tokens // 64) + 1
    assert packing.numbered(out.drop("sequence_id", "offset")).select("_key").distinct().count() == 770


def test_empty(none, space):
    assert packing.pack_documents(none, space, PATH).count() == 0
