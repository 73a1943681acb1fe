"""Every query of the subpackage against its SQL, as the library's own are."""

import math

import duckdb
import pytest

from tallyspark.llm.oracle import ORACLES
from tallyspark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
TABLES = ("documents", "embeddings", "pages", "conversations")


def text(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{FOLDER}/{name}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, engine, name):
    result = QUERIES[name](spark, FOLDER)
    cursor = engine.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    expected = sorted(tuple(text(v) for v in row) for row in cursor.fetchall())
    assert sorted(tuple(text(row[c]) for c in columns) for row in result.collect()) == expected
    assert expected
