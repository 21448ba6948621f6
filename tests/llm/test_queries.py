"""Registered queries: contract columns, and those that SQL can express against DuckDB."""

import duckdb
import pytest

from nestmart.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    found = QUERIES[name](spark, sf_dir)
    rel = con.execute(ORACLES[name])
    assert found.columns == [d[0] for d in rel.description]
    assert sorted(map(tuple, found.collect())) == sorted(rel.fetchall())


def test_one_query_for_each_operator():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
