"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from skeinwork.plans import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for p in glob.glob(f"{FOLDER}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p if os.path.isfile(p) else p + '/*.parquet'}'")
    return con


def shown(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if hasattr(v, "isoformat"):
        return str(v)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v


def rows(columns, found):
    order = sorted(columns)
    return sorted(([shown(r[columns.index(c)]) for c in order] for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    there = con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(there.columns)
    assert rows(df.columns, df.collect()) == rows(there.columns, there.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
