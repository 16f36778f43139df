"""Names of the queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scoutline.llm import oracle
from scoutline.llm import queries as _queries

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {name: build for name, build in vars(_queries).items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
