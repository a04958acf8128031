import math
import os

import duckdb
import pytest

from orthoskein.oracles import ORACLES
from orthoskein.queries import QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    c = duckdb.connect()
    c.execute("set TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = lambda v: round(v, 6) if isinstance(v, float) and math.isfinite(v) else v
    return sorted(([plain(r[i]) for i in order] for r in values), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sql, name):
    df = QUERIES[name](spark, DATA)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    relation = sql.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(relation.columns)
    assert got == rows(relation.columns, relation.fetchall())
