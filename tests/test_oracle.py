"""Every registered query against its DuckDB oracle (the driver's check,
run here on sf0.001)."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tideline.schema import TABLES

NAMES = sorted(E.catalog.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def test_every_query_has_an_oracle():
    assert set(E.catalog.oracle_sql()) == set(NAMES)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["id", "window_start", "window_end", "ts", "vc"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
    assert got == want
