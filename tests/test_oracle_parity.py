"""Every query with a SQL oracle must equal DuckDB's answer exactly (sf0.001)."""

import math

import pytest

import __spark_entry__ as E
from servicelens.plans.oracle import SQL
from tests.conftest import SF0001

ORACLES = SQL


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    return v


def _rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF0001)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[name])
    want = res.fetchall()
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert len(got) == len(want)
    assert _rows(df.columns, got) == _rows(dcols, want)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(E.queries())


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "alert_tier" in df.columns
