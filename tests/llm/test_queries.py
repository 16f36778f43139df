"""Every query with SQL against that SQL, and the names that have to be there."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check import rows
from scoutline.llm import registry
from tests.llm.conftest import SF


def test_one_query_per_operator():
    names = sorted(int(n[2:].split("_")[0]) for n in registry.queries())
    assert names == list(range(1, 14))
    assert set(registry.queries()) | {"pipeline"} <= set(entry.queries())
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, connection, name):
    df = registry.queries()[name](spark, SF)
    cursor = connection.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, cursor.fetchall())


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier",
        "SimHash near-dedup",
        "substring dedup",
        "benchmark decontamination",
        "best-fit packing",
    ]
