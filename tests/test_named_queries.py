"""Every named query against its SQL on the same tables."""

import datetime

import duckdb
import pytest
from conftest import DATA

import __spark_entry__ as entry
from sheetflow.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, CHECKS = registry.QUERIES, registry.CHECKS


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def table(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(t[i]) for i in order) for t in tuples), key=repr)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    expected = duck.sql(CHECKS[name])
    assert sorted(df.columns) == sorted(expected.columns)
    assert table(df.columns, df.collect()) == table(expected.columns, expected.fetchall())


def test_entry_offers_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).columns == ["o_orderkey", "_col", "变化的列", "旧值", "新值"]
