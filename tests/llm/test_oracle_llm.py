"""Operators that SQL can express, against their DuckDB SQL on the smallest tables."""

import duckdb
import pytest
from conftest import SF_SMALL

from wideloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    res = con.execute(ORACLES[name])
    names = [c[0] for c in res.description]
    want = sorted(map(repr, res.fetchall()))
    got = sorted(repr(tuple(r[c] for c in names)) for r in QUERIES[name](spark, SF_SMALL).collect())
    assert got == want
