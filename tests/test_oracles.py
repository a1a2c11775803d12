"""Every query against its SQL in another engine, on the smallest test data."""

from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as contract
from starmart.oracles import ORACLES
from starmart.plans.wide import TABLES
from starmart.queries import QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return connection


def _cell(value):
    if value is None:
        return (0, 0.0, "")
    if isinstance(value, (int, float, Decimal)):
        return (1, round(float(value), 6), "")
    return (2, 0.0, str(value))


def _table(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(columns), sorted(tuple(_cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, engine, name):
    df = QUERIES[name](spark, DATA)
    expected = engine.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    assert _table(df.columns, df.collect()) == _table(columns, expected.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 10
