"""Queries with SQL give what DuckDB gives on the smallest tables."""

import os

import duckdb
import pytest

from cytospark.llm.queries import ORACLE_SQL, QUERIES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    duck = duckdb.connect()
    for f in os.listdir(SF):
        duck.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    got, want = QUERIES[name](spark, SF), duck.sql(ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    plain = lambda rows: sorted(repr([None if v is None else str(v) for v in r]) for r in rows)
    assert plain(got.select(columns).collect()) == plain(want.select(*columns).fetchall())
