from collections import Counter

import corpus_pipeline as pipeline
from test_bagminhash import bag, jaccard
from test_bagminhash import brute as near_brute
from test_exact import brute as exact_brute

from verbalis.llm import quality
from verbalis.llm.common import space_of, table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    space, docs, kept = space_of(spark), table(spark, SF, "documents"), {}
    for name, stage in pipeline.STAGES:
        kept[name] = docs
        docs = space.keep(stage(spark, docs, SF), name)
        if name != "packing":
            assert docs.columns == table(spark, SF, "documents").columns
    rows = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    scores = quality.quality_scores(kept["quality"], table(spark, SF, "labels"), space)
    assert {i for i, _ in rows(kept["exact_dedup"])} == {r.doc_id for r in scores.filter("predicted = 1").collect()}
    assert Counter(i for i, *_ in exact_brute(rows(kept["exact_dedup"])) if _[2]) == Counter(i for i, _ in rows(kept["near_dedup"]))
    assert Counter(i for i, *_ in near_brute(rows(kept["near_dedup"])) if _[2]) == Counter(i for i, _ in rows(kept["source_mix"]))
    mixed = Counter(rows(kept["packing"]))
    assert set(mixed) <= set(rows(kept["source_mix"])) and max(mixed.values()) <= 3
    first = Counter(r.doc_id for r in docs.filter("piece = 0").collect())
    assert first == Counter(i for (i, _), n in mixed.items() for _ in range(n))
    fills = Counter()
    for r in docs.collect():
        fills[r.sequence_id] += r.length
    assert max(fills.values()) <= pipeline.SEQUENCE
    assert pipeline.run(spark, SF).count() == docs.count()


def test_stages_on_odd_documents(edges, spark):
    docs = edges.withColumnRenamed("n", "n_chars")
    for _, stage in pipeline.STAGES[:-1]:
        docs = space_of(spark).keep(stage(spark, docs, SF), "s")
    assert docs.columns == edges.withColumnRenamed("n", "n_chars").columns


def test_near_copies_of_repeated_and_missing_ids(make_docs, spark):
    words = lambda name, n=40: " ".join(f"{name}{i}" for i in range(n))
    rows = [
        (1, words("a")),
        (1, words("b")),
        (1, words("a") + " more"),
        (2, words("c")),
        (1, words("c") + " more"),
        (3, words("d")),
        (3, words("D").upper()),
        (None, words("e")),
        (None, words("f")),
        (None, words("f") + " more"),
        (None, words("g")),
        (4, words("g") + " more"),
        (None, None),
        (5, words("h")),
    ]
    left = pipeline.unlike_documents(spark, make_docs(rows), SF)
    left = [(r.doc_id, r.text) for r in left.collect()]
    assert set(left) <= set(rows)
    classes = {}
    for n, (_, text) in enumerate(rows):
        mate = next((c for c, members in classes.items() if any(jaccard(bag(text), bag(rows[m][1])) >= 0.8 for m in members)), n)
        classes.setdefault(mate, []).append(n)
    assert len(left) == len(classes)
    for members in classes.values():
        ids = [rows[m][0] for m in members]
        least = min((i for i in ids if i is not None), default=None)
        assert sum(row in left for row in {rows[m] for m in members if rows[m][0] == least}) == 1
