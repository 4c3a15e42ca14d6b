"""Queries that SQL can express equal DuckDB's answer."""

import pytest

from servicelens.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, llm_duck, name, sf):
    df = QUERIES[name](spark, f"/root/testdata/{sf}")
    res = llm_duck(sf).execute(SQL[name])
    names = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(names)
    got = sorted(tuple(r) for r in df.select(*names).collect())
    assert got == sorted(res.fetchall()) and got
