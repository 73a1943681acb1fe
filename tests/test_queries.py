"""Every registered query against SQL run by an independent engine."""

import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as contract
from tallyspark.oracle import ORACLES
from tallyspark.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()
# Queries whose result is empty on purpose: everything agrees after the month end.
EMPTY = {"month_end_left_over"}


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return con


def text(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, Decimal):
        return format(value.normalize(), "f") if value else "0"
    return str(value)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, engine, name):
    result = contract.queries()[name](spark, FOLDER)
    cursor = engine.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    expected = sorted(tuple(text(v) for v in row) for row in cursor.fetchall())
    actual = sorted(tuple(text(row[c]) for c in columns) for row in result.collect())
    assert actual == expected
    assert bool(actual) != (name in EMPTY)
