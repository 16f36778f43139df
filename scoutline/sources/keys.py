"""Key tables: which keys were seen before, answered from the hash buckets of the keys that are asked for.

A table is a handful of runs, folders of (key, first, last) in hash buckets of about equal size; ``first`` and
``last`` are the least and greatest names under which a key was added. A run of many keys has many buckets, so
a question reads some buckets of each run, whatever their number. Adding writes one small run; when a level
has FANOUT runs, they are merged into one of the next level, so a key is rewritten a logarithmic number
of times. Merged runs are written before their parts are dropped, and a key that is there twice is there, so
a job that dies in between does no harm. One job at a time may add.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoutline.schemas import TEXT, table_schema
from scoutline.session import discard, drop_dir, stored

#: Runs of one level that are merged, keys of a bucket, and the most buckets of a run as a power of two.
FANOUT = 8
BUCKET_KEYS = 50_000
MOST_BITS = 16

_ROWS, _KEY = table_schema(key=TEXT, first=TEXT, last=TEXT), table_schema(key=TEXT)
_NAME = re.compile(r"level(\d+)-bits(\d+)-([0-9a-f]+)")


@dataclass(frozen=True)
class Run:
    path: str
    level: int
    bits: int


def runs(spark: SparkSession, path: str) -> list[Run]:
    """The runs of a table; none if it does not exist."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    found = []
    for status in files.listStatus(folder):
        name = _NAME.fullmatch(status.getPath().getName())
        if name:
            found.append(Run(f"{path}/{name[0]}", int(name[1]), int(name[2])))
    return sorted(found, key=lambda r: r.path)


def bucket(key: Column, bits: int) -> Column:
    """The leading bits of the key's hash."""
    return F.shiftrightunsigned(F.xxhash64(key), 64 - bits).cast("int") if bits else F.lit(0)


def _read(spark: SparkSession, run: Run, buckets: list[int] | None = None) -> DataFrame | None:
    """Rows of a run, of some buckets only where that leaves any out."""
    whole = buckets is None or len(buckets) * 2 > 1 << run.bits
    part = "bucket=*" if whole else "bucket={" + ",".join(map(str, sorted(buckets))) + "}"
    try:
        return spark.read.schema(_ROWS).parquet(f"{run.path}/{part}")
    except AnalysisException as error:  # none of the buckets has a key
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def find(spark: SparkSession, path: str, keys: DataFrame, *, without: str | None = None) -> DataFrame:
    """The distinct ones of ``keys`` (a column ``key``) that the table holds under another name than ``without``.

    Only the numbers of the buckets that are asked for pass through the driver, at most 2^MOST_BITS. ``keys`` is read
    twice, so give a stored or cheap one.
    """
    there = runs(spark, path)
    wanted = keys.select("key").where(F.col("key").isNotNull()).distinct()
    if not there:
        return spark.createDataFrame([], _KEY)
    most = max(r.bits for r in there)
    numbers = [r[0] for r in wanted.select(bucket(F.col("key"), most)).distinct().collect()]
    parts = [_read(spark, r, sorted({n >> (most - r.bits) for n in numbers})) for r in there]
    parts = [p for p in parts if p is not None]
    if not parts:
        return spark.createDataFrame([], _KEY)
    rows = reduce(DataFrame.unionByName, parts)
    if without is not None:
        rows = rows.where((F.col("first") != without) | (F.col("last") != without))
    return wanted.join(rows.select("key"), "key", "left_semi")


def _write(rows: DataFrame, path: str, level: int) -> None:
    """Write rows, one for each key, as one run."""
    rows = stored(rows, "keys")
    count = rows.count()
    if count:
        bits = min(MOST_BITS, (count // BUCKET_KEYS).bit_length())
        numbered = rows.withColumn("bucket", bucket(F.col("key"), bits))
        target = f"{path}/level{level}-bits{bits}-{uuid.uuid4().hex}"
        numbered.repartition("bucket").write.partitionBy("bucket").parquet(target)
    discard(rows)


def add(keys: DataFrame, path: str, name: str | None = None) -> None:
    """Add the keys (a column ``key``, NULLs are left out) under a name, or each under that in the column ``name``;
    adding them again changes nothing that :func:`find` tells. Levels that are full are merged."""
    spark = keys.sparkSession
    named = F.col("name") if name is None else F.lit(name)
    rows = keys.where(F.col("key").isNotNull()).groupBy("key").agg(F.min(named).alias("first"), F.max(named).alias("last"))
    _write(rows, path, 0)
    level = 0
    while True:
        full = [r for r in runs(spark, path) if r.level == level]
        if len(full) < FANOUT:
            return
        united = reduce(DataFrame.unionByName, [_read(spark, r) for r in full])
        merged = united.groupBy("key").agg(F.min("first").alias("first"), F.max("last").alias("last"))
        _write(merged, path, level + 1)
        for run in full:
            drop_dir(spark, run.path)
        level += 1
