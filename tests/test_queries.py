"""Every query against its SQL on an independent engine, over the smallest tables."""

import math

import duckdb
import pytest

from calltrail.jobs import all_queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = all_queries()
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(found, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda x: None if isinstance(x, float) and math.isnan(x) else round(x, 6) if isinstance(x, float) else x
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    want = duck.sql(ORACLES[name])
    assert rows([tuple(r) for r in df.collect()], df.columns) == rows(want.fetchall(), want.columns)
    assert {c: TYPES.get(t, t) for c, t in df.dtypes} == dict(zip(want.columns, map(str, want.types), strict=True))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
