import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from verbalis.llm import linededup

WHITE = " \t\n\x0b\x0c\r"
A, B = "a line of more than forty characters, that is", "another LINE of more than forty characters, \x0bé"


def brute(rows, min_chars=40, min_docs=5):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    key = lambda line: line.strip(WHITE).translate(lower)
    docs = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            docs[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= min_chars and len(docs[key(x)]) >= min_docs and max(docs[key(x)]) != i)]
        text = "\n".join(kept)
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out)


def digest(docs, space):
    out = linededup.dedup_lines(docs, space)
    kept = linededup.kept_text(F.col("text"), F.col("keep_runs"))
    rows = out.select("doc_id", "n_lines", "n_dropped", F.sha2(kept, 256).alias("sha")).collect()
    return sorted(tuple(r) for r in rows)


def test_against_brute_force(make_docs, space):
    rows = [(i, "\n".join([f"own {i}", A if i % 2 else f"  {A.upper()} \r", "short", A, B if i < 4 else "", "end"])) for i in range(9)]
    rows += [(20, None), (21, ""), (22, "\n\n"), (23, A), (3, rows[3][1]), (24, "\n".join(["x" * 50] * 300))]
    assert digest(make_docs(rows), space) == brute(rows)


def test_repeated_lines_of_few_documents_stay(make_docs, space):
    rows = [(i, f"{A}\n{A}\n{A}") for i in range(4)]
    assert digest(make_docs(rows), space) == brute(rows)
    assert all(n == 0 for _, _, n, _ in brute(rows))


def test_runs_and_columns(make_docs, space):
    rows = [(i, f"one\n{A}\ntwo\n{A}") for i in range(5)]
    docs = make_docs(rows).withColumn("n_lines", F.lit("mine"))
    out = linededup.dedup_lines(docs, space)
    assert set(out.columns) == set(docs.columns) | {"n_dropped", "keep_runs"}
    runs = {r.doc_id: [tuple(x) for x in r.keep_runs] for r in out.collect()}
    assert runs[0] == [(0, 1), (2, 1)] and runs[4] == [(0, 4)]


def test_null_ids_and_empty(make_docs, none, space):
    rows = [(None, A + f"\n{i}") for i in range(5)] + [(1, A)]
    out = linededup.dedup_lines(make_docs(rows), space)
    assert sorted(r.n_dropped for r in out.collect()) == [0, 1, 1, 1, 1, 1]
    assert linededup.dedup_lines(none, space).count() == 0
