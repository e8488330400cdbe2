"""Every query against its SQL, over the smallest tables."""

import math
import os

import duckdb
import pytest

from strataline.plans import queries as q


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if hasattr(v, "is_finite"):
        return repr(round(float(v), 9))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    return repr(v)


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    for t in os.listdir(data):
        c.execute(f"create view {t[:-8]} as select * from '{data}/{t}'")
    return c


@pytest.mark.parametrize("name", sorted(q.ORACLES))
def test_query_equals_sql(spark, data, con, name):
    df = q.QUERIES[name](spark, data)
    columns = sorted(df.columns)
    ours = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    rel = con.sql(q.ORACLES[name])
    names = rel.columns
    assert sorted(names) == columns
    theirs = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in rel.fetchall())
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(set(q.QUERIES) - set(q.ORACLES)))
def test_query_runs(spark, data, name):
    df = q.QUERIES[name](spark, data)
    assert df.columns and df.count() >= 0
