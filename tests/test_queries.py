"""Every registered query against its SQL counterpart on the smallest data set."""

from __future__ import annotations

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as contract
from catalog.oracles import ORACLES
from catalog.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys()


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, duck, key):
    df = contract.queries()[key](spark, SF_DIR)
    result = duck.execute(contract.oracle_sql()[key])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    rows = result.fetchall()
    assert rows
    assert comparable(df.columns, df.collect()) == comparable(columns, rows)
