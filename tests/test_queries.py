"""Every registered query of the engine against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from changeloom.plans.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.sql("SET TimeZone = 'UTC'")
    for name in os.listdir(DATA):
        connection.sql(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{DATA}/{name}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    assert got
    if name in SQL:
        rows = duck.sql(SQL[name])
        assert sorted(rows.columns) == columns
        order = [rows.columns.index(c) for c in columns]
        assert got == sorted((tuple(r[i] for i in order) for r in rows.fetchall()), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
