"""Every registered query against DuckDB on the same tables."""

import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.01"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")
QUERIES, ORACLE = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        return None if math.isnan(number) else number
    if isinstance(value, (datetime.date, datetime.datetime, str)):
        return value
    raise TypeError(f"unexpected type {type(value)}")


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, duck, name):
    made = QUERIES[name](spark, FOLDER)
    found = _table(made.columns, [tuple(r) for r in made.collect()])
    told = duck.execute(ORACLE[name])
    wanted = _table([c[0] for c in told.description], told.fetchall())
    assert found[0] == wanted[0]
    assert len(found[1]) == len(wanted[1]) > 0
    assert found[1] == wanted[1]


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
