"""Every registered query against its expected result in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as contract
from feedloom.plans.catalogue import ORACLES, QUERIES

from .conftest import SF

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_the_contract_lists_the_catalogue():
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLES.items() <= contract.oracle_sql().items()


def test_oracles_belong_to_queries():
    assert ORACLES.keys() <= QUERIES.keys()
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF)
    columns = sorted(result.columns)
    rows = [tuple(r[c] for c in columns) for r in result.collect()]
    if name not in ORACLES:
        assert rows
        return
    cursor = duck.execute(ORACLES[name])
    found = [d[0] for d in cursor.description]
    assert sorted(found) == columns
    order = [found.index(c) for c in columns]
    expected = [tuple(r[i] for i in order) for r in cursor.fetchall()]
    assert sorted(map(repr, rows)) == sorted(map(repr, expected))


def test_entry(spark):
    assert contract.entry(spark).count() > 0
