"""The registered queries against their SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from tablewright.llm import registry
from tests.test_queries import sorted_rows

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = registry.QUERIES[name](spark, SF)
    want = con.execute(registry.SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted_rows(df.columns, [tuple(r) for r in df.collect()]) == sorted_rows(columns, want.fetchall())


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))
