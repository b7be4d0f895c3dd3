"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from formspark.plans.table_queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def canon(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "mood" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = sorted((tuple(canon(x) for x in r) for r in df.collect()), key=key)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == sorted(df.columns)
    order = [ocols.index(c) for c in df.columns]
    want = sorted((tuple(canon(r[i]) for i in order) for r in cur.fetchall()), key=key)
    assert len(got) == len(want)
    assert got == want
