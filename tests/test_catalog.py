"""Every query with SQL gives what DuckDB gives on the smallest tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

from cytospark.plans.catalog import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def plain(v):
    if v is None or v is pd.NA or isinstance(v, float) and math.isnan(v):
        return None
    return round(float(v), 5) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def rows(df):
    names = sorted(df.columns)
    return names, sorted(repr([plain(v) for v in r]) for r in df[names].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, duck, name):
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(duck.sql(ORACLE_SQL[name]).df())
