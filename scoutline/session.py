"""Session settings and the shared scratch location."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

# Skew handling is left to AQE for joins: with forceOptimizeSkewedJoin a hot join key is split
# even where the split costs one more exchange for a later aggregate.
_SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Text rules are heavy per byte, so small shuffles keep their parallelism.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128KB",
    # Streaming state may outgrow the executor heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the run-time SQL options that every operator relies on; partition counts stay the session's."""
    for key, value in _SQL_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that all executors share: below ``spark.checkpoint.dir``, else below the warehouse.

    On a cluster a warehouse in a local folder is none that executors share, so it is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        local = re.match(r"local(\[.*)?$", spark.conf.get("spark.master", "local"))
        if not local and re.match(r"file:|/|[^:]*$", base):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows as a written table in a fresh shared folder, so that later plans start from it."""
    path = shared_dir(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def drop_dir(spark: SparkSession, path: str) -> bool:
    """Delete a folder made by :func:`shared_dir` once nothing reads it any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def discard(rows: DataFrame) -> None:
    """Delete the folder of a table made by :func:`stored` once nothing reads it any more."""
    files = rows.inputFiles()
    if files:
        drop_dir(rows.sparkSession, files[0].rpartition("/")[0])
