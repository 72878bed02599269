"""Every query that SQL can express, against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from tools.check import compare

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for f in sorted(os.listdir(FOLDER)):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{FOLDER}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    status, _rows, _seconds, note = compare(spark, name, FOLDER, con)
    assert status == "ok", note


def test_entry(spark):
    assert contract.entry(spark).count() == 1


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
