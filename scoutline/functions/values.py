"""Numbers, times and JSON text."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from scoutline.fixed import APPROVAL_WORDS, NOT_FOUND

_NUMBER = r"(?i)\A[+-]?(\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?\z|\A[+-]?inf(inity)?\z"
_ISO = r"\A\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?\z"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it.

    A one-element list names the value; plain nesting would repeat the whole expression.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def to_count(text: Column) -> Column:
    """Whole number, or NULL for anything else."""
    return F.trim(text).try_cast("bigint")


def to_number(text: Column) -> Column:
    """Decimal number, or NULL for missing, sentinel or malformed text."""
    trimmed = F.trim(text.cast("string"))
    return F.when(trimmed.rlike(_NUMBER), trimmed.try_cast("double"))


def to_flag(text: Column) -> Column:
    """Approval text: only these three words count."""
    return F.coalesce(F.lower(F.trim(text.cast("string"))).isin(*APPROVAL_WORDS), F.lit(False))


def to_timestamp(text: Column) -> Column:
    """ISO-8601 date or date-time; without a zone it is UTC (the session zone)."""
    return F.when(text.rlike(_ISO), text.try_cast("timestamp"))


def moment_literal(moment: datetime) -> Column:
    """A fixed time; without a zone it is UTC."""
    aware = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    return F.lit(aware).cast("timestamp")


def days_since(moment: Column, as_of: datetime) -> Column:
    """Whole elapsed days, never negative; NULL stays NULL."""
    days = F.timestamp_diff("DAY", moment, moment_literal(as_of))
    return F.when(moment.isNotNull(), F.greatest(F.lit(0).cast("bigint"), days))


def or_sentinel(text: Column) -> Column:
    return F.coalesce(F.nullif(text.cast("string"), F.lit("")), F.lit(NOT_FOUND))


def missing_to_null(text: Column) -> Column:
    """Empty text and the sentinel become NULL."""
    return F.when(~text.isin("", NOT_FOUND), text)


def json_string(text: Column) -> Column:
    """Quoted ASCII-only JSON text, with \\uXXXX (UTF-16 units) for everything else."""
    out = text
    for raw, escaped in (
        ("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"),
        ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f"),
    ):
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    units = lambda run: F.regexp_replace(
        F.lower(F.hex(F.encode(run, "UTF-16BE"))), "(.{4})", r"\\u$1"
    )
    runs = F.regexp_extract_all(out, F.lit("[ -~]+|[^ -~]+"), 0)
    rewritten = F.array_join(
        F.transform(runs, lambda run: F.when(run.rlike("[^ -~]"), units(run)).otherwise(run)), ""
    )
    return F.concat(F.lit('"'), F.when(out.rlike("[^ -~]"), rewritten).otherwise(out), F.lit('"'))


def json_list(values: Column) -> Column:
    """Array of text as JSON text in the flat-file format."""
    quoted = F.transform(F.coalesce(values, F.array().cast("array<string>")), json_string)
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
