"""Every registered query against its SQL counterpart on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, rows
from scoutline.plans import catalog, oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_a_counterpart():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(catalog.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, con, name):
    df = catalog.queries()[name](spark, SF)
    cursor = con.execute(oracle.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "rank"
