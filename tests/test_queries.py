"""Every query against its SQL on the smallest data folder."""

import os

import duckdb
import pytest

from tagloom.oracles import ORACLES
from tagloom.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("nation", "customer", "part", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def comparable(rows):
    return sorted(
        tuple("NULL" if value is None else repr(round(value, 9)) if isinstance(value, float) else repr(value) for value in row)
        for row in rows
    )


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    result = duck.execute(ORACLES[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == columns
    order = [names.index(column) for column in columns]
    expected = comparable([tuple(row[i] for i in order) for row in result.fetchall()])
    got = comparable(tuple(row) for row in df.select(*columns).collect())
    assert got == expected
    assert got
