"""Every registered query against its DuckDB oracle on the smallest test tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from souk.plans.queries import ORACLE, QUERIES
from souk.sources.fixture import TABLES


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        return str(v)[:19]
    return v


def _key(r):
    return tuple((x is None, str(type(x)), x) for x in r)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["label", "n", "share"] and sum(r.n for r in rows) > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, sf_small, name):
    sdf = E.queries()[name](spark, sf_small)
    cols = sdf.columns
    srows = sorted((tuple(_norm(v) for v in r) for r in sdf.collect()), key=_key)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == sorted(cols)
    idx = [rel.columns.index(c) for c in cols]
    drows = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=_key)
    assert len(srows) == len(drows)
    assert srows == drows


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) <= set(E.queries())


# rows that an empty result would not show to be right
@pytest.mark.parametrize("name", ["price_outliers", "rating_outliers", "ingest_quarantine", "stream_ingest_wm"])
def test_query_has_rows(spark, sf_small, name):
    assert QUERIES[name](spark, sf_small).count() > 0
