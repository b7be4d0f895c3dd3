"""Queries that SQL can express against DuckDB on the smallest tables."""

import duckdb
import pytest
from formspark.llm.queries import QUERIES
from formspark.llm.sql import ORACLES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(llm, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](llm, SF)
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(got.columns)
    at = [names.index(c) for c in got.columns]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((tuple(r[i] for i in at) for r in cur.fetchall()), key=str)
