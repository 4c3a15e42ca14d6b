import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))


@pytest.fixture(scope="session")
def llm_duck():
    """DuckDB over the tables that the SQL of these queries reads."""
    import duckdb

    def at(sf: str):
        con = duckdb.connect()
        for t in ("documents", "embeddings", "benchmark", "labels", "conversations"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/{sf}/{t}.parquet')")
        return con

    return at
