"""Every registered query against its SQL in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from starmart.registry.oracle import all_oracles
from starmart.registry.queries import all_queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES = all_queries()
ORACLES = all_oracles()
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    ours = QUERIES[name](spark, SF_DIR)
    columns = sorted(ours.columns)
    theirs = duck.sql(ORACLES[name])
    types = {c: str(t) for c, t in zip(theirs.columns, theirs.types, strict=True)}
    assert {c: TYPES.get(t, t.upper()) for c, t in ours.dtypes} == types
    got = sorted(repr(tuple(row)) for row in ours.select(*columns).collect())
    want = duck.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert got == sorted(repr(row) for row in want)
    assert got


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
