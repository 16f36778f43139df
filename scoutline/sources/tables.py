"""Stage tables: Parquet inside, flat CSV files at the edges."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoutline.fixed import NOT_FOUND
from scoutline.functions.values import json_list, missing_to_null, to_count, to_flag, to_number
from scoutline.functions.values import to_timestamp
from scoutline.operators.contact import log_rows, new_dms
from scoutline.operators.ordering import position
from scoutline.schemas import DM_QUEUE, MESSAGE_COLUMNS, RAW_CHANNEL_COLUMNS

# Python-style text: quotes doubled, blanks kept, line breaks inside quotes allowed.
_CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "emptyValue": "",
}


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table that may not exist yet; absent means empty."""
    try:
        return read_table(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def store(df: DataFrame, path: str) -> DataFrame:
    """Write a stage result and read it back, so that later stages start from the table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Import a flat file by column name; empty and sentinel values become NULL.

    Line breaks inside quotes keep a file from being split: each file is one task, so flat files are
    for the edges. Where the schema has a ``pos`` that the files lack, it is made from the order of
    files by name and of rows in them.
    """
    raw = spark.read.options(**_CSV).csv(path)
    present = set(raw.columns)
    if "pos" in schema.fieldNames() and "pos" not in present:
        named = raw.withColumn("_file", F.col("_metadata.file_path"))
        ordered = named.withColumn("_row", F.monotonically_increasing_id())
        raw = position(ordered, "_file", ["_row"], name="pos").drop("_file", "_row")
        raw = raw.withColumn("pos", F.col("pos").cast("string"))
        present.add("pos")
    return raw.select(
        *[
            (_typed(F.col(f"`{f.name}`"), f.dataType) if f.name in present else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def _typed(text: Column, data_type: T.DataType) -> Column:
    value = missing_to_null(text)
    if isinstance(data_type, T.ArrayType):
        # Text that is no list is kept as the only entry.
        return F.coalesce(F.from_json(value, data_type), F.when(value.isNotNull(), F.array(value)))
    if isinstance(data_type, (T.LongType, T.IntegerType)):
        return to_count(value)
    if isinstance(data_type, T.DoubleType):
        return to_number(value)
    if isinstance(data_type, T.BooleanType):
        return to_flag(value)
    if isinstance(data_type, T.TimestampType):
        return to_timestamp(value)
    return value


def flat(df: DataFrame, sentinel: tuple[str, ...] = ()) -> DataFrame:
    """Flat-file form: lists as JSON text, NULL text of ``sentinel`` columns as the sentinel."""
    out = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            column = json_list(column)
        elif isinstance(f.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        elif f.name in sentinel:
            column = F.coalesce(column.cast("string"), F.lit(NOT_FOUND))
        out.append(column.alias(f.name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str, sentinel: tuple[str, ...] = ()) -> None:
    """Export in parallel, one file per partition, each with the header."""
    flat(df, sentinel).write.mode("overwrite").options(**_CSV).csv(path)


def write_raw_channels(raw_channels: DataFrame, path: str) -> None:
    raw_channels.select(*RAW_CHANNEL_COLUMNS, "pos").write.mode("overwrite").parquet(path)


def write_creators(creators: DataFrame, path: str) -> None:
    """Write enriched or evaluated creators; each has its own path, since none may replace its
    own input while reading it."""
    creators.write.mode("overwrite").parquet(path)


def write_shortlist(ranked: DataFrame, path: str) -> None:
    """The rank is a column, so the order does not depend on files."""
    ranked.write.mode("overwrite").parquet(path)


def write_messages(drafts: DataFrame, summary: DataFrame, path: str) -> str:
    """Write drafts as the one-row run summary allows; returns what was done."""
    outcome = summary.select("outcome").first()["outcome"]
    if outcome == "fail without writing":
        raise RuntimeError("no eligible creator got a valid draft; nothing was written")
    drafts.select(*MESSAGE_COLUMNS, "pos").write.mode("overwrite").parquet(path)
    return outcome


def append_log(plan: DataFrame, run_at, path: str) -> None:
    """Append this run's attempts; earlier rows are never rewritten."""
    log_rows(plan, run_at).write.mode("append").parquet(path)


def append_dms(messages: DataFrame, queue: DataFrame, path: str) -> None:
    columns = [f.name for f in DM_QUEUE.fields]
    new_dms(messages, queue).select(*columns).write.mode("append").parquet(path)
