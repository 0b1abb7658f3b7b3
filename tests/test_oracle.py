"""Every registered query against its DuckDB statement (sf0.001)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else "nan"
    if isinstance(v, list):
        return tuple(_norm(x) for x in v)
    return v


def _key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_equals_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _key(df.columns, rows) == _key(ocols, res.fetchall())


def test_every_query_has_an_oracle():
    from shardloom.plans.catalog import ORACLE, QUERIES

    assert set(QUERIES) == set(ORACLE)
    assert set(E.oracle_sql()) <= set(E.queries()) and set(QUERIES) <= set(E.queries())


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["index", "shard", "doc_count", "is_empty"]
    assert df.count() > 0
