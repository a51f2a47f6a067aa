"""Every registered query against its checking SQL on the smallest data."""

import glob
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from dropgate.suite import base
from conftest import SF
from tools.check_oracle import norm


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def test_entry(spark):
    assert entry.entry(spark).count() == 20


@pytest.mark.parametrize("name", list(base.QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = Counter(tuple(norm(r[c]) for c in columns) for r in df.collect())
    cur = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    assert got == Counter(tuple(norm(r[names.index(c)]) for c in columns) for r in cur.fetchall())
