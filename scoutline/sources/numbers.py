"""Dense numbers for keys: every key keeps the number that it got first, new keys get the next ones.

Numbers count from 0 inside each hash bucket of the keys, so new ones need no order over all keys: a key's number is
its bucket's base plus its place. Only the buckets of the keys that are asked for are read. One job at a time
may number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoutline.schemas import SMALL, TEXT, WHOLE, table_schema
from scoutline.session import stored
from scoutline.sources.keys import bucket
from scoutline.sources.tables import read_optional

#: Buckets as a power of two, and bits of a key's place in its bucket.
BUCKET_BITS, PLACE_BITS = 6, 40

_ROWS = T.StructType([*table_schema(key=TEXT, number=WHOLE).fields, *table_schema(name=TEXT, bucket=SMALL).fields])


def numbered(keys: DataFrame, path: str, name: str) -> DataFrame:
    """(key, number) of the distinct non-NULL ``keys`` (a column ``key``); new ones are numbered under a name.

    Asking again, under any name, gives the same numbers.
    """
    spark = keys.sparkSession
    asked = keys.select("key").where(F.col("key").isNotNull()).distinct().withColumn("bucket", bucket(F.col("key"), BUCKET_BITS))
    asked = stored(asked, "asked")
    buckets = [r[0] for r in asked.select("bucket").distinct().collect()]  # at most 2^BUCKET_BITS
    known = read_optional(spark, path, _ROWS).where(F.col("bucket").isin(buckets))
    high = known.groupBy("bucket").agg(F.max("number").alias("high"))
    new = asked.join(known.select("key"), "key", "left_anti").join(high, "bucket", "left")
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("key")).cast("bigint") - 1
    first = F.coalesce(F.col("high") + 1, F.shiftleft(F.col("bucket").cast("bigint"), PLACE_BITS))
    fresh = stored(new.select("key", "bucket", (first + place).alias("number")), "numbers")
    fresh.select("key", "number", "bucket").write.partitionBy("bucket").mode("append").parquet(f"{path}/name={name}")
    told = known.select("key", "number").unionByName(fresh.select("key", "number"))
    return asked.select("key").join(told, "key")
