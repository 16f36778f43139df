import duckdb
import pytest

from check import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tables():
    """The smallest test tables as lists of dictionaries, read on first use."""
    connection, kept = duckdb.connect(), {}

    def read(name):
        if name not in kept:
            cursor = connection.execute(f"select * from '{SF}/{name}.parquet'")
            names = [d[0] for d in cursor.description]
            kept[name] = [dict(zip(names, r)) for r in cursor.fetchall()]
        return kept[name]

    return read


@pytest.fixture(scope="session")
def connection():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con
