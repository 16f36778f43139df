"""Claims: the addresses that open live runs hold, one partition per run.

A run writes what it wants before it looks at the others, and yields every address that another run wants
or holds. Of two runs planned at the same moment the one that looks later sees the other, so no two hold
one address; if both see each other, both yield. What a run holds is written before its wants are dropped, so
there is no moment at which its addresses look free.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoutline.operators.contact import PLANNED, yield_addresses
from scoutline.schemas import TEXT, table_schema
from scoutline.session import drop_dir
from scoutline.sources.tables import read_optional

_CLAIMS = table_schema(email_key=TEXT, run=TEXT, stage=TEXT)


def claimed(spark: SparkSession, path: str, without: str | None = None) -> DataFrame:
    """(email_key, run) of all claims, but those of one run."""
    rows = read_optional(spark, path, _CLAIMS)
    if without is not None:
        rows = rows.where(F.col("run") != without)
    return rows.select("email_key", "run").distinct()


def want(plan: DataFrame, path: str, run: str) -> DataFrame:
    """Claim the planned addresses of a stored live plan; returns the plan without those of other runs."""
    _write(plan, path, run, "wanted")
    return yield_addresses(plan, claimed(plan.sparkSession, path, without=run))


def hold(plan: DataFrame, path: str, run: str) -> None:
    """Keep the addresses that the final plan still has, and only those."""
    _write(plan, path, run, "held")
    drop_dir(plan.sparkSession, f"{path}/run={run}/stage=wanted")


def release(spark: SparkSession, path: str, run: str) -> None:
    """Drop the claims of a run; its log partition must be written by then."""
    drop_dir(spark, f"{path}/run={run}")


def _write(plan: DataFrame, path: str, run: str, stage: str) -> None:
    keys = plan.where(F.col("status") == PLANNED).select("email_key")
    keys.write.mode("overwrite").parquet(f"{path}/run={run}/stage={stage}")
