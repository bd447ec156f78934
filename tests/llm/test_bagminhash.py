import random
from collections import Counter

import numpy as np
import pytest

from verbalis.llm import bagminhash as B
from verbalis.llm.texthash import shingles_of, words_of




def bag(text, k=5):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else " " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else Counter([tuple(words)])


def jaccard(a, b):
    joint = sum((a | b).values())
    return sum((a & b).values()) / joint if joint else 1.0


def brute(rows, similarity=0.8):
    bags = [bag(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if jaccard(bags[i], bags[j]) >= similarity:
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    ids = [i for i, _ in rows]
    low = {g: min((i for i, h in zip(ids, group) if h == g and i is not None), default=None) for g in set(group)}
    size = Counter(group)
    return sorted(((i, low[g], size[g], i == low[g]) for i, g in zip(ids, group)), key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_signatures_are_unbiased():
    rng = np.random.default_rng(1)
    values = rng.integers(1, 2**63, 200).astype(np.uint64)
    a = rng.integers(0, 9, 200)
    b = np.where(rng.random(200) < 0.6, a, rng.integers(0, 9, 200))
    text = np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()])
    both = np.concatenate([values[a > 0], values[b > 0]]), np.concatenate([a[a > 0], b[b > 0]])
    sketch = B.signatures(text, *both, 2, 20_000)
    assert np.isfinite(sketch).all()
    assert (sketch[0] == sketch[1]).mean() == pytest.approx(np.minimum(a, b).sum() / np.maximum(a, b).sum(), abs=0.015)


def test_signatures_do_not_depend_on_neighbours():
    texts = [b"a", b"a b c d e f g", b"x y " * 4000, b"", b"one two three four five"]
    together = B.signatures(*shingles_of(words_of(texts), 5, 5), 5, 64)
    for i, t in enumerate(texts):
        alone = B.signatures(*shingles_of(words_of([t]), 1, 5), 1, 64)
        assert np.array_equal(alone[0], together[i])
    assert np.isinf(together[3]).all()


def test_signatures_do_not_depend_on_the_size_of_the_batch():
    rng = np.random.default_rng(2)
    lengths = [30, 300, 7, 2500, *rng.integers(5, 4000, 120)]
    texts = [" ".join(map(str, rng.integers(0, 500, n))).encode() for n in lengths]
    found = shingles_of(words_of(texts), len(texts), 5)
    assert len(found[0]) > 200_000
    together = B.signatures(*found, len(texts), 240)
    for i in (0, 1, 2, 3, 60, len(texts) - 1):
        alone = B.signatures(*shingles_of(words_of([texts[i]]), 1, 5), 1, 240)
        assert np.array_equal(alone[0], together[i])


def test_overlap_is_that_of_multisets():
    pairs = [("a b c d e f", "a b c d e g"), ("a b", "a b"), ("a b", "a c"), ("", ""), ("x " * 30, "x " * 40), ("", "a")]
    out = B.overlaps([a.encode() for a, _ in pairs], [b.encode() for _, b in pairs], 5)
    assert out == pytest.approx([jaccard(bag(a), bag(b)) for a, b in pairs])


def corpus():
    random.seed(4)
    word = lambda: "".join(random.choices("abcdefgh", k=4))
    rows, passage = [], [word() for _ in range(40)]
    for family in range(12):
        text = [word() for _ in range(random.choice([6, 60, 300]))]
        for copy in range(random.choice([1, 3, 8])):
            changed = list(text)
            for _ in range(random.choice([0, 1, 2, 5])):
                changed[random.randrange(len(changed))] = word()
            rows.append((family * 100 + copy, " ".join(changed)))
    # texts that share a passage but are no copies, and a chain of small steps
    rows += [(2000 + i, " ".join([*passage, *(word() for _ in range(30))])) for i in range(15)]
    chain = [word() for _ in range(200)]
    for i in range(10):
        chain[i * 18 : i * 18 + 6] = [word() for _ in range(6)]
        rows.append((3000 + i, " ".join(chain)))
    return rows


def test_classes_against_brute_force(make_docs, space):
    rows = corpus()
    assert found(B.near_copies(make_docs(rows), space)) == brute(rows)


def test_crowded_buckets_are_compared_in_tiles(make_docs, space, monkeypatch):
    monkeypatch.setattr(B, "TILE", 4)
    rows = corpus()
    # one place per band, so that buckets are full of texts that are no copies
    assert found(B.near_copies(make_docs(rows), space, bands=60, rows=1)) == brute(rows)


def one_band_in_common(shingle, bands, rows):
    """In the place of ``_sketch``: all texts share their first band, and no two of them another one."""

    def sketch(batches):
        import zlib

        import pyarrow as pa

        for batch in batches:
            own = [zlib.crc32(t.encode()) << 20 for t in batch.column("words").to_pylist()]
            keys = pa.array([[7, *(h + k for k in range(1, bands))] for h in own], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("print"), keys], names=["doc_id", "print", "keys"])

    return sketch


def test_pairs_that_share_one_crowded_bucket(make_docs, space, monkeypatch):
    random.seed(6)
    words = lambda n: [f"w{random.randrange(10_000)}" for _ in range(n)]
    rows = [(i, " ".join(words(60))) for i in range(B.TILE + 36)]
    text = words(120)
    rows += [(1000 + i, " ".join([*text, *words(2)])) for i in range(2)]
    monkeypatch.setattr(B, "_sketch", one_band_in_common)
    expected = [(i, i, 1, True) for i, _ in rows[:-2]] + [(1000, 1000, 2, True), (1001, 1000, 2, False)]
    assert found(B.near_copies(make_docs(rows), space, rows=6)) == sorted(expected, key=str)


def test_overlaps_of_all_pairs(monkeypatch):
    texts = [t.encode() for t in ("a b c d e f", "a b c d e g", "a b", "x " * 30, "x " * 40, "", "a b c d e f g")]
    pairs = [(a, b) for a in texts for b in texts]
    expected = B.overlaps([a for a, _ in pairs], [b for _, b in pairs], 5).reshape(len(texts), -1)
    for limit in (1, 20, 1 << 20):
        monkeypatch.setattr(B, "TEXT_BYTES", limit)
        out = np.full(expected.shape, np.nan)
        for i, start, values in B.all_overlaps(texts, texts, 5, np.ones(expected.shape, bool)):
            out[i, start : start + len(values)] = values
        assert np.array_equal(out, expected)


def test_edges(edges, none, space):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    assert found(B.near_copies(edges, space)) == brute(rows)
    assert B.near_copies(none, space).count() == 0


def test_repeated_rows_without_ids_are_verified_once(make_docs, spark, space):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(None, text)] * 300 + [(None, text + " more")] * 300
    assert B.near_copies(make_docs(rows), space).filter("class_size = 600").count() == 600
    links = spark.read.parquet(f"{space.path}/links_1")
    assert links.count() == 1


def test_sizes_rule_out_only_what_cannot_link():
    a, b = np.meshgrid(np.arange(0, 60), np.arange(0, 60))
    best = np.divide(np.minimum(a, b), np.maximum(a, b), out=np.ones(a.shape), where=np.maximum(a, b) > 0)
    assert (B.may_reach(a, b, 0.8) == (best >= 0.8 - 1e-12)).all()


def test_crowd_of_many_sizes(make_docs, space, monkeypatch):
    """One passage in common, texts of very different lengths: chunks by size lose no link."""
    monkeypatch.setattr(B, "TILE", 3)
    monkeypatch.setattr(B, "SIDE", 5)
    draw = random.Random(9)
    passage = [f"p{i}" for i in range(12)]
    rows = []
    for i in range(60):
        body = [f"b{draw.randrange(10_000)}" for _ in range(draw.choice([0, 3, 8, 15, 60, 200]))]
        rows.append((i, " ".join(passage + body)))
        if i % 6 == 0:
            rows.append((100 + i, " ".join(passage + body + ["end"])))
    assert found(B.near_copies(make_docs(rows), space, bands=60, rows=1)) == brute(rows)


def test_members_of_a_crowd_make_one_row_each(make_docs, space, monkeypatch):
    """Texts of many lengths in one bucket of moderate size: none is dealt to several tiles, and no link is lost."""
    random.seed(8)
    words = lambda n: [f"w{random.randrange(10_000)}" for _ in range(n)]
    rows = [(i, " ".join(words(20 + 3 * i))) for i in range(B.TILE + 60)]
    text = words(120)
    rows += [(1000 + i, " ".join([*text, *words(2)])) for i in range(2)]
    monkeypatch.setattr(B, "_sketch", one_band_in_common)
    real = B._tile
    monkeypatch.setattr(B, "_tile", lambda *given: counted(real(*given), space.path))

    def counted(tile, folder):
        def run(key, members):
            import os
            import uuid

            os.makedirs(f"{folder}/dealt", exist_ok=True)
            with open(f"{folder}/dealt/{uuid.uuid4().hex}", "w") as out:
                out.write(str(members.num_rows))
            return tile(key, members)

        return run

    out = found(B.near_copies(make_docs(rows), space, rows=6))
    assert [r for r in out if r[2] == 2] == [(1000, 1000, 2, True), (1001, 1000, 2, False)]
    from pathlib import Path

    tiles = [int(f.read_text()) for f in Path(f"{space.path}/dealt").iterdir()]
    # the two copies may have joined in an earlier turn
    assert len(rows) - 2 <= sum(tiles) <= len(rows)
