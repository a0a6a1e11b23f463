"""Every registered query against its SQL oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tablewright.sources.tables import TABLES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return c


def canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return round(v, 6)
    return v


def rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(canon(r[c]) for c in cols) for r in df[cols].to_dict("records")), key=repr)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, FOLDER).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert rows(got) == rows(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 10
    assert "type" in df.columns
