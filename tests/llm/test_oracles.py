"""Registered queries that SQL can express, against DuckDB at the smallest scale."""

import glob
import os

import duckdb
import pytest

from veilspark.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = con.execute(f"select {', '.join(columns)} from ({ORACLE[name]})").fetchall()
    assert sorted(map(tuple, df.select(columns).collect()), key=str) == sorted(want, key=str)
