"""Every query with oracle SQL against the other engine on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for name in os.listdir(sf):
        connection.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{sf}/{name}'")
    return connection


def _key(row):
    return tuple("" if v is None else f"{v:.6f}" if isinstance(v, float) else str(v) for v in row)


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-9, abs_tol=2e-6)
    return a == b


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, duck, name):
    table = entry.queries()[name](spark, sf)
    columns = sorted(table.columns)
    ours = sorted((tuple(r[c] for c in columns) for r in table.toArrow().to_pylist()), key=_key)
    cursor = duck.execute(ORACLES[name])
    theirs = cursor.fetchall()
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    theirs = sorted((tuple(r[names.index(c)] for c in columns) for r in theirs), key=_key)
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs):
        assert all(_same(x, y) for x, y in zip(a, b)), (a, b)


def test_every_oracle_has_a_query():
    assert not set(ORACLES) - set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["name", "score", "feature"]
