"""Registered queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

from millrace.plans.queries import ORACLES, QUERIES


def plain(v):
    if isinstance(v, float):
        return round(v, 5)
    return tuple(plain(x) for x in v) if isinstance(v, list) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, small, name):
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for f in os.listdir(small):
        con.sql(f"create view {f[:-8]} as select * from '{small}/{f}'")
    df, want = QUERIES[name](spark, small), con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    order = sorted(df.columns)
    got = sorted(repr(tuple(plain(r[c]) for c in order)) for r in df.collect())
    at = [want.columns.index(c) for c in order]
    assert got == sorted(repr(tuple(plain(r[i]) for i in at)) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0
