"""Every registered query with an oracle text agrees with DuckDB on the
smoke tables (row count, column names, order-insensitive values)."""

import math

import duckdb
import pytest

from conftest import SF_SMOKE
from provisio.queries import oracle_sql, queries
from provisio.sources.tables import TEST_TABLES

SQL = oracle_sql()


def _canon(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return repr([_canon(x) for x in v])
    return repr(v)


def _norm(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in rs)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TEST_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMOKE}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, duck, key):
    df = queries()[key](spark, SF_SMOKE)
    srows, scols = df.collect(), df.columns
    res = duck.execute(SQL[key])
    drows, dcols = res.fetchall(), [d[0] for d in res.description]
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _norm(scols, srows) == _norm(dcols, drows)


def test_every_query_has_an_oracle():
    assert set(queries()) == set(SQL)
