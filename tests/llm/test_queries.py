"""Registered queries with SQL give the same rows on the small tables."""

import os

import duckdb
import pytest

from orthoskein.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    sql = duckdb.connect()
    for t in ("documents", "pages"):
        sql.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    df, want = QUERIES[name](spark, DATA), sql.sql(ORACLES[name])
    order = sorted(df.columns)
    assert order == sorted(want.columns)
    rows = lambda names, values: sorted(([r[names.index(c)] for c in order] for r in values), key=str)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(want.columns, want.fetchall())
