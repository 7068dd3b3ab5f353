"""Every registered query against its SQL counterpart in DuckDB."""

from __future__ import annotations

import datetime
import math

import duckdb
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


# Queries of the training-data part have tests of their own and may be absent.
OWN = {n for m in contract._MODULES if m.__name__.startswith("workload.") for n in m.QUERIES}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def plain(value) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cursor = duck.execute(contract.oracle_sql()[name])
    found = [c[0] for c in cursor.description]
    assert sorted(found) == columns
    at = [found.index(c) for c in columns]
    expected = sorted(tuple(plain(r[i]) for i in at) for r in cursor.fetchall())
    assert got == expected
    assert got, "a query without rows checks nothing"


def test_every_query_has_an_oracle():
    assert set(contract.oracle_sql()) >= OWN


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "load_id" and df.count() > 0
