"""Driver contract: entry smoke, key parity, and every query against its DuckDB oracle."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as entry
from nestmart import fixtures, registry


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["genre", "budget", "popularity", "gross"]


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLES)
    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6))
    return str(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in fixtures.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(registry.ORACLES))
def test_query_matches_oracle(spark, sf_dir, duck, key):
    sdf = entry.queries()[key](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    rel = duck.execute(entry.oracle_sql()[key])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(srows, sdf.columns) == _digest(drows, dcols)
