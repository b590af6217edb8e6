"""Registered queries against their DuckDB oracle SQL on the smallest tables."""

import math
import os
import subprocess
import sys

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as E

from wideloom.oracle import oracle_sql
from wideloom.plans.registry import QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v if v is None or isinstance(v, (int, bool, str)) else str(v)


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(oracle_sql()[name])
    cols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == _rows(cols, res.fetchall())


def test_entry_lists_queries_and_sql():
    names, sql = set(E.queries()), set(E.oracle_sql())
    assert set(QUERIES) <= names and sql <= names


def test_entry_without_the_optional_package():
    """With the training-data package gone the entry module loads and keeps the rest,
    whether or not the pipeline module is still there."""
    code = ("import importlib.util as u, sys\n"
            "find = u.find_spec\n"
            "u.find_spec = lambda n, *a: None if n == 'wideloom.llm' else find(n, *a)\n"
            "sys.modules['wideloom.llm'] = None\n"
            "import __spark_entry__ as E\n"
            "from wideloom.plans.registry import QUERIES\n"
            "assert set(E.queries()) == set(E.oracle_sql()) == set(QUERIES)\n")
    done = subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(E.__file__), capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "ROW_KEY" in df.columns
