"""Data-quality checks; each gives one row (check_name, failed_rows, total_rows, ok)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoutline.config import Brand, DraftLimits
from scoutline.fixed import FAIL, SENT, UNFILTERED
from scoutline.functions.text import EMAIL_SEARCH, present, within_words, word_count
from scoutline.operators.contact import email_key

MIN_RECORDS = 50
MIN_RAW_RECORDS = 80


def _report(counted: DataFrame, checks: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One row per named pair of (failed, total) columns of a one-row DataFrame."""
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("check_name"),
                failed.cast("bigint").alias("failed_rows"),
                total.cast("bigint").alias("total_rows"),
                (failed == 0).alias("ok"),
            )
            for name, (failed, total) in checks.items()
        ]
    )
    return counted.select(F.inline(rows))


def landing_checks(torn_lines: DataFrame) -> DataFrame:
    """Whether every landed line is a whole JSON value; of the rows that ``landing.torn_lines`` gives, by path."""
    counted = torn_lines.agg(F.sum("torn").alias("torn"), F.sum("lines").alias("lines"))
    return _report(counted, {"landed lines whole": (F.coalesce("torn", F.lit(0)), F.coalesce("lines", F.lit(0)))})


def record_checks(raw_channels: DataFrame, creators: DataFrame) -> DataFrame:
    """Volume, provenance and verdict checks over the evaluated creators, in one pass each."""
    raw = raw_channels.agg(F.count("*").alias("raw_total"))
    raw_report = _report(
        raw,
        {
            "enough raw records": (
                F.greatest(F.lit(0), MIN_RAW_RECORDS - F.col("raw_total")), F.col("raw_total")
            )
        },
    )
    unexplained = (F.col("status") == FAIL) & (F.size("fail_reasons") == 0)
    counted = creators.agg(
        F.count("*").alias("total"),
        F.count_if(present(F.col("source")).isNull() | F.col("fetched_at").isNull()).alias("q2"),
        F.count_if(
            F.col("status").isNull() | (F.col("status") == UNFILTERED) | unexplained
        ).alias("q3"),
    )
    return raw_report.unionByName(
        _report(
            counted,
            {
                "enough records": (
                    F.greatest(F.lit(0), MIN_RECORDS - F.col("total")), F.col("total")
                ),
                "source and time present": (F.col("q2"), F.col("total")),
                "status with reason": (F.col("q3"), F.col("total")),
            },
        )
    )


def message_checks(messages: DataFrame, limits: DraftLimits, brand: Brand) -> DataFrame:
    """Word limits and leftover placeholder values."""
    texts = [F.coalesce(F.col(c), F.lit("")) for c in ("subject", "email_message", "dm")]
    subject, body, dm = texts
    fits = (
        (subject != "")
        & (word_count(subject) <= limits.subject_max_words)
        & within_words(body, limits.email_words)
        & within_words(dm, limits.dm_words)
    )
    leftover = reduce(
        Column.__or__, [F.contains(t, F.lit(p)) for t in texts for p in brand.placeholders]
    )
    counted = messages.agg(
        F.count("*").alias("total"),
        F.count_if(~fits).alias("q4"),
        F.count_if(leftover).alias("q8"),
    )
    return _report(
        counted,
        {
            "messages within word limits": (F.col("q4"), F.col("total")),
            "no placeholder in messages": (F.col("q8"), F.col("total")),
        },
    )


def log_checks(log: DataFrame) -> DataFrame:
    """No address was sent to twice."""
    per_key = (
        log.where(F.col("status") == SENT)
        .groupBy(email_key(F.col("email")).alias("key"))
        .agg(F.count("*").alias("n"))
    )
    counted = per_key.agg(
        F.count("*").alias("total"), F.count_if(F.col("n") > 1).alias("q5")
    )
    return _report(counted, {"no duplicate send": (F.col("q5"), F.col("total"))})


def email_checks(creators: DataFrame, channels: DataFrame) -> DataFrame:
    """Every stored address occurs in a stored description of its channel.

    Descriptions are reduced to the addresses in them before the shuffle.
    """
    stored = creators.where(F.col("email").isNotNull()).select("id", "email")
    texts = channels.where(F.contains("description", F.lit("@"))).select(
        F.col("channel_id").alias("id"),
        F.array_distinct(F.regexp_extract_all(F.lower("description"), F.lit(EMAIL_SEARCH), 0)).alias("written"),
    )
    found = F.coalesce(F.exists("written", lambda a: F.contains(a, F.col("email"))), F.lit(False))
    per_creator = stored.join(texts, "id", "left").groupBy("id").agg(F.max(found).alias("found"))
    counted = per_creator.agg(
        F.count("*").alias("total"), F.count_if(~F.col("found")).alias("q6")
    )
    return _report(counted, {"no invented address": (F.col("q6"), F.col("total"))})


def completeness_check(
    before: DataFrame, after: DataFrame, before_id: str, after_id: str, name: str
) -> DataFrame:
    """Both steps hold the same ids."""
    left = before.select(F.col(before_id).alias("id"), F.lit(1).alias("was"))
    right = after.select(F.col(after_id).alias("id"), F.lit(1).alias("now"))
    counted = left.join(right, "id", "full").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("was").isNull() | F.col("now").isNull()).alias("q7"),
    )
    return _report(counted, {name: (F.col("q7"), F.col("total"))})


def quality_report(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
