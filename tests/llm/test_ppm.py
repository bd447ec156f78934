import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from verbalis.llm import ppm
from verbalis.llm.common import space_of


class Brute:
    """The trie as nested tables. Longest contexts count occurrences, shorter ones the longer contexts a symbol follows."""

    def __init__(self, texts, order):
        self.order, grams = order, Counter()
        for t in texts:
            s = b"\xff" * order + t + b"\xfe"
            grams.update(s[p - order : p + 1] for p in range(order, len(s)))
        self.counts = {}
        for k in range(order, -1, -1):
            for g, n in grams.items():
                self.counts.setdefault(g[:-1], {})[g[-1]] = n
            grams = Counter(g[1:] for g in grams) if k else grams

    def symbols(self, context):
        """log10 probabilities by symbol; -1 stands for each symbol that was never seen."""
        out, log, seen = {}, 0.0, set()
        for k in range(self.order + 1):
            rest = {s: n for s, n in self.counts.get(context[k:], {}).items() if s not in seen}
            if rest:
                total = sum(rest.values())
                out |= {s: log + math.log10((n - 0.5) / total) for s, n in rest.items()}
                log += math.log10(len(rest) / 2 / total)
                seen |= set(rest)
        out[-1] = log - math.log10(257 - len(seen)) if len(seen) < 257 else -math.inf
        return out, len(seen)

    def score(self, text):
        s, total = b"\xff" * self.order + text + b"\xfe", 0.0
        for p in range(self.order, len(s)):
            logs, _ = self.symbols(s[p - self.order : p])
            total += logs.get(s[p], logs[-1])
        return total


def rows():
    out = [(i, "The cat sat on mat. " * (1 + i % 4) + "Dog é ß " * (i % 3) + chr(97 + i % 26) * 5) for i in range(80)]
    return out + [(100, None), (101, ""), (102, " \n"), (103, "日本語 new Words ONLY here"), (3, out[3][1]), (None, "no id"), (104, "ab " * 9000)]


@pytest.mark.parametrize("order, block_bytes", [(5, 64 << 20), (2, 300)])
def test_against_brute_force(make_docs, space, order, block_bytes):
    data = rows()
    out = ppm.ppm_scores(make_docs(data), space, order=order, block_bytes=block_bytes).collect()
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in data]
    low = [(t or "").encode().lower() for _, t in data]
    train = [t for t, h in zip(low, held) if not h]
    brute, words = Brute(train, order), Counter(w for t in train for w in t.split())
    n, v = sum(words.values()) + len(train), len(words) + 1
    want = []
    for (i, _), t, h in zip(data, low, held):
        tokens = t.split()
        base = sum(math.log10((words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        base += math.log10((len(train) + 0.5) / (n + 0.5 * (v + 1)))
        want.append((str(i), h, len(tokens) + 1, sum(w in words for w in tokens) + 1, n, base, brute.score(t)))
    got = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in out]
    assert len(got) == len(want)
    for a, b in zip(sorted(got), sorted(want)):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:])


def test_probabilities_sum_to_one():
    brute = Brute([b"abracadabra", b"abab", b"cadab"], 3)
    for context in (b"\xff\xff\xff", b"bra", b"xyz", b"aca", b"xab"):
        logs, seen = brute.symbols(context)
        assert sum(10**x * (257 - seen if s == -1 else 1) for s, x in logs.items()) == pytest.approx(1)


def test_no_training_texts_and_empty(make_docs, none, space):
    out = ppm.ppm_scores(make_docs([(1, "ab c"), (2, None)]), space, held_out=F.lit(True)).orderBy("doc_id").collect()
    assert [r.score for r in out] == pytest.approx([-5 * math.log10(257), -math.log10(257)])
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in out] == [(3, 0, 0), (1, 0, 0)]
    assert ppm.ppm_scores(none, space).count() == 0


def test_blocks_end_at_their_keys_and_long_texts_are_cut(make_docs, space):
    """Random text of many scripts: blocks stay within the bound of keys, texts are cut, and scores do not change."""
    draw = random.Random(4)
    letters = [chr(c) for c in (*range(97, 123), *range(0x400, 0x450), *range(0x4E00, 0x4E80))] + [" ", "\n"] * 20
    data = [(i, "".join(draw.choice(letters) for _ in range(draw.randint(0, 900)))) for i in range(60)]
    data += [(100, "x" * 5000 + " y"), (101, "ab cd " * 900), (101, "ab cd " * 900), (None, "q " * 800)]
    docs = make_docs(data).repartition(2)
    whole = ppm.ppm_scores(docs, space).collect()
    other = space_of(docs.sparkSession)
    parts = ppm.ppm_scores(docs, other, block_keys=2000, longest=700).collect()
    assert docs.sparkSession.read.parquet(f"{other.path}/ppm_scored").filter("cut IS NOT NULL").count() > 10
    rows = lambda x: sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in x)
    assert rows(parts) == rows(whole)


def test_blocks_are_bounded(spark, make_docs):
    draw = random.Random(5)
    data = [(i, "".join(chr(draw.randint(97, 122)) for _ in range(400))) for i in range(100)]
    rows = make_docs(data).selectExpr("doc_id", "false AS held_out", "text").coalesce(1)
    made = rows.mapInArrow(ppm._blocks(5, 1 << 20, 3000, 1000), "block long, key long, n long, docs binary")
    sizes = [r["count"] for r in made.filter("key IS NOT NULL").groupBy("block").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 3000 + 2 * 1000


@pytest.mark.parametrize("order", [0, 1, 5])
def test_keys_of_parts_are_those_of_the_text(order):
    text = bytes(range(97, 123)) * 3
    begin = bytes([ppm.BEFORE]) * order
    whole, _ = ppm.gram_keys(ppm.Segments([text, b"", text], [begin] * 3, [True] * 3), order)
    cuts = [0, 7, 8, 40, len(text)]
    parts = [text[a:b] for a, b in zip(cuts, cuts[1:])]
    heads = [(begin + text[:a])[len(begin + text[:a]) - order :] for a in cuts[:-1]]
    made, starts = ppm.gram_keys(ppm.Segments([*parts, b"", *parts], [*heads, begin, *heads], [False] * 3 + [True] * 2 + [False] * 3 + [True]), order)
    assert made.tolist() == whole.tolist()
    assert starts.tolist() == [0, 7, 8, 40, 79, 80, 87, 88, 120]


def test_merging_counts_takes_little_memory():
    import tracemalloc

    rng = np.random.default_rng(2)
    counts, every, n = ppm._Counts(), [], []
    for counted in (True, False, True, True):
        keys = rng.integers(0, 3_000, 2_000).astype(ppm.U)
        counts.add(keys, counted)
        every.append(keys)
        n.append(np.full(len(keys), int(counted)))
    keys, total = counts.merged()
    expected, place = np.unique(np.concatenate(every), return_inverse=True)
    assert np.array_equal(keys, expected)
    assert np.array_equal(total, np.bincount(place, np.concatenate(n)).astype(np.int64))
    assert [len(x) for x in ppm._Counts().merged()] == [0, 0]

    counts = ppm._Counts()
    counts.add(np.arange(0, 2_000_000, 2).astype(ppm.U), True)
    counts.parts.append((np.arange(1, 200_000, 2).astype(ppm.U), np.ones(100_000, np.int64)))
    tracemalloc.start()
    assert len(counts.merged()[0]) == 1_100_000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30_000_000
