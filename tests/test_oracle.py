"""Every registered query against its independent DuckDB SQL on sf0.001."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_catalogue_query_has_sql():
    from reviewlake.plans.catalog import Q

    assert sorted(set(Q) - set(E.oracle_sql())) == []


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = df.columns
    srows = [tuple(_norm(x) for x in r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols = [c[0] for c in cur.description]
    drows = [tuple(_norm(x) for x in r) for r in cur.fetchall()]
    assert sorted(cols) == sorted(dcols)
    order = sorted(cols)
    s = sorted((tuple(r[cols.index(c)] for c in order) for r in srows), key=_key)
    d = sorted((tuple(r[dcols.index(c)] for c in order) for r in drows), key=_key)
    assert len(s) == len(d)
    assert s == d


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["score", "review_count", "pct"] and len(rows) >= 1
