"""Manifest against a plain loop over lists."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from verbalis.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def low(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def climb(nodes):
    """(top, siblings of every node by level)."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, a in enumerate(at):
            run = level[a // 8 * 8 : a // 8 * 8 + 8]
            paths[i].append(("".join(run[: a % 8]), "".join(run[a % 8 + 1 :])))
        level = [h(*level[k : k + 8]) for k in range(0, len(level), 8)]
        at = [a // 8 for a in at]
    return level[0], paths


def expected(rows):
    groups = {}
    for doc_id, source, lang, n, text in rows:
        first = leaf_of([doc_id, source, lang, n, text])
        changed = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 3 == 0
        now = leaf_of([doc_id, source, lang, n, low(text)]) if changed else first
        groups.setdefault(b"" if lang is None else b"=" + lang.encode(), []).append(
            ((doc_id is not None, doc_id or 0), first, now, doc_id)
        )
    names = sorted(groups)
    trees = {g: climb([x[1] for x in sorted(groups[g])]) for g in names}
    root, above = climb([trees[g][0] for g in names])
    out = []
    for g, over in zip(names, above):
        for (_, first, now, doc_id), path in zip(sorted(groups[g]), trees[g][1]):
            path = path + over
            folded = now
            for left, right in path:
                folded = h(left, folded, right)
            out.append((doc_id, first, trees[g][0], root, h(*(a + b for a, b in path)), folded))
    return sorted(out, key=str)


def ours(docs, space):
    proof = F.sha2(F.array_join(F.transform("path", lambda x: F.concat(x["left"], x["right"])), ""), 256)
    out = merkle.manifest(docs, space).select("doc_id", "leaf", "subroot", "root", proof, "folded_root")
    return sorted((tuple(r) for r in out.collect()), key=str)


FIELDS = "doc_id long, source string, lang string, n_chars long, text string"


def with_clashes(docs):
    for name in ("tree", "rank", "node", "path", "_at", "block", "items", "top", "run", "_task"):
        docs = docs.withColumn(name, F.lit("x"))
    return docs


def test_manifest_equals_a_plain_loop(spark, space):
    rows = [(i * 7 % 5000, "s", "en", i, f"Text Number {i} Ä") for i in range(1300)]
    rows += [(i, None, "fr", None, "A" * i) for i in range(9)] + [(i, "é", "ζ", 1, None) for i in range(8)]
    rows += [(7, "s", None, 3, ""), (None, "s", None, 3, "B"), (None, None, None, None, None), (1, "s", "", 0, "Q" * 70_000)]
    rows += [(1, "s", "", 0, "q" * 70_000), (5, "x", "one", 1, "ONE"), rows[3], rows[3]]
    rows += [(i, "s", f"lang{i}", 1, "Z") for i in range(20)]
    assert ours(with_clashes(spark.createDataFrame(rows, FIELDS)), space) == expected(rows)


@pytest.mark.parametrize("n", [1, 8, 9, 513])
def test_sizes_at_the_borders(spark, space, n):
    rows = [(i, "s", "en", i, "Same") for i in range(n)]
    found = ours(spark.createDataFrame(rows, FIELDS), space)
    assert found == expected(rows)


def test_verified_unless_a_capital_changed(spark, space):
    rows = [(i, "s", "en", 1, "lower" if i % 2 else "Upper") for i in range(60)]
    for r in merkle.manifest(spark.createDataFrame(rows, FIELDS), space).collect():
        tampered = zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and r.doc_id % 2 == 0
        assert (r.folded_root == r.root) == (not tampered)


def test_empty_table(spark, space):
    assert merkle.manifest(spark.createDataFrame([], FIELDS), space).collect() == []
