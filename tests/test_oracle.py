"""Every registered query against its DuckDB statement on sf0.001 (the driver
runs the same check at sf0.01)."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as entry_mod
from starloom.catalog import spark_queries

from conftest import SF001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


# the training-data queries, where they are there, have tests of their own
QUERIES = spark_queries.queries()
SQL = {k: v for k, v in entry_mod.oracle_sql().items() if k in QUERIES}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL) and set(QUERIES) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.execute(SQL[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _canon(df.columns, rows) == _canon(dcols, drows)


def test_entry_smoke(spark):
    out = entry_mod.entry(spark)
    assert out.columns == ["genre_name", "book_count"]
    assert out.count() > 0
