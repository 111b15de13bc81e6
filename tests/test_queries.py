"""Every registered query outside the optional subpackage against its SQL, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__
from tablewright import suite

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return f"{value:.6g}" if isinstance(value, float) else str(value)


def sorted_rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in found)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(suite.load()[0]))
def test_query(spark, duck, name):
    queries, sql = suite.load()
    df = queries[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    want = duck.execute(sql[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted_rows(df.columns, got) == sorted_rows(columns, want.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
