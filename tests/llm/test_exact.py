import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from verbalis.llm import exact


def brute(rows):
    """(id, keep_id, size, kept, sha) per row, sorted."""
    norm = [re.sub(r"[\x20\x09-\x0d]+", " ", t or "") for _, t in rows]
    groups = defaultdict(list)
    for (i, _), t in zip(rows, norm):
        groups[t].append(i)
    out = []
    for (i, _), t in zip(rows, norm):
        known = [x for x in groups[t] if x is not None]
        keep = min(known) if known else None
        out.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_edges(edges, space):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    assert found(exact.exact_copies(edges, space)) == brute(rows)


def test_collisions_are_resolved_by_bytes(edges, space):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    weak = exact.exact_copies(edges, space, key=lambda sha: F.substring(sha, 1, 0))
    assert found(weak) == brute(rows)


def test_empty(none, space):
    assert exact.exact_copies(none, space).count() == 0
    assert exact.without_copies(none, space).count() == 0


def test_one_row_of_each_group_stays(edges, space):
    out = exact.without_copies(edges, space)
    assert out.columns == edges.columns
    stay = sorted((r.doc_id for r in out.collect()), key=str)
    assert stay == sorted([1, 3, 4, 6, 7, 8, 9, None], key=str)
    assert out.filter("doc_id = 4").first().asDict() == edges.filter("doc_id = 4").first().asDict()
