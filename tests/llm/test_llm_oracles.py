"""Queries of the dealt operators that SQL can express against their SQL."""

from __future__ import annotations

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as contract
from namefold.llm.queries import ORACLES, QUERIES


def test_registered():
    assert QUERIES.keys() <= contract.queries().keys() and ORACLES.keys() <= QUERIES.keys()
    numbers = [int(k[2:].split("_")[0]) for k in QUERIES if k.startswith("op")]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in QUERIES


@pytest.mark.parametrize("key", list(ORACLES))
def test_query(spark, key):
    duck = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        duck.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    df = QUERIES[key](spark, SF_DIR)
    result = duck.execute(ORACLES[key])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    want = sorted(tuple(repr(r[columns.index(c)]) for c in order) for r in result.fetchall())
    assert sorted(tuple(repr(r[c]) for c in order) for r in df.collect()) == want
