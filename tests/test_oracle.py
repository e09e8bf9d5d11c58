"""Registered queries against DuckDB, on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(v):
    return None if isinstance(v, float) and math.isnan(v) else tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted((tuple(plain(r[columns.index(c)]) for c in sorted(columns)) for r in cur.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in sorted(columns)) for r in df.collect()), key=repr) == want


@pytest.mark.parametrize("name", sorted(n for n in set(entry.queries()) - set(entry.oracle_sql()) if not n.startswith("op") and n != "pipeline"))
def test_runs(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_files_are_small():
    root = os.path.dirname(os.path.abspath(entry.__file__))
    assert sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(root) if ".git" not in d for f in fs) < 5e6
