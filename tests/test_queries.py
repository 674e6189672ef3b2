"""Every registered query against its SQL twin, at the smallest scale."""

import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry
from concordat.plans.inputs import TABLES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


def plain(value):
    return int(value) if isinstance(value, decimal.Decimal) and value == int(value) else value


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    frame = entry.queries()[name](spark, FOLDER)
    columns = sorted(frame.columns)
    got = sorted((tuple(plain(row[c]) for c in columns) for row in frame.collect()), key=repr)
    if name not in entry.oracle_sql():
        assert got
        return
    result = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = sorted((tuple(plain(row[names.index(c)]) for c in columns) for row in result.fetchall()), key=repr)
    assert got == expected


def test_entry(spark):
    assert entry.entry(spark).count() > 0
