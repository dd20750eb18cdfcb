"""Every registered query against its DuckDB twin on the smallest scale."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as entry_mod
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
SQL = entry_mod.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 4)
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_callable():
    assert set(SQL) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = entry_mod.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(c.lower() for c in sdf.columns) == sorted(c.lower() for c in dcols)
    assert len(srows) == len(drows)
    assert _digest(sdf.columns, srows) == _digest(dcols, drows)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
