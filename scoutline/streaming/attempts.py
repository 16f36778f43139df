"""Contacts as keyed state: one attempt per address, open until its outcome or its deadline comes.

Messages and outcomes arrive as two streams and meet in the state of their address. Every change is a row of
the attempts table with a version; the newest version of a message counts. So an outcome that comes late,
after the deadline, still replaces the failure that the deadline wrote, and one that is told again changes
nothing.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import timedelta

import pyarrow as pa
from pyspark.cloudpickle import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from scoutline.fixed import DUPLICATE, FAILED, SENT
from scoutline.functions.text import present
from scoutline.operators.contact import PLANNED, approved, email_key, known_contacts, placed
from scoutline.schemas import TEXT, WHOLE, table_schema
from scoutline.sources.tables import read_optional

# The state machine travels to the workers whole, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Our own: an error text for attempts whose outcome did not come in time.
NO_OUTCOME = "no outcome before the deadline"
#: Parts over which the repeats of one address are dealt, and addresses that a task remembers.
PARTS, REMEMBERED = 64, 1_000_000

ATTEMPTS = table_schema(email_key=TEXT, pos=WHOLE, status=TEXT, error=TEXT, version=WHOLE)
_STATE = "pos bigint, status string, error string, told_us bigint, version bigint"
_BLOCKED = "blocked"


class Attempt(StatefulProcessor):
    """State of an address: its attempt with the outcome told last, or that the old log blocks it."""

    def __init__(self, deadline_ms: int):
        self.deadline_ms = deadline_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.attempt = handle.getValueState("attempt", _STATE)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.attempt.update((None, _BLOCKED, None, None, 0))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        address, part = key
        if part:  # repeats of an address, for which no state is needed
            for row in rows:
                yield self._row(address, row.pos, DUPLICATE, "", 0)
            return
        messages, outcomes = [], []
        for row in rows:
            (outcomes if row.is_outcome else messages).append(row)
        now = before = self.attempt.get()
        for row in sorted(messages, key=lambda r: r.pos):
            if now is not None:
                if now[0] != row.pos:  # the same message again is no other attempt
                    yield self._row(address, row.pos, DUPLICATE, "", 0)
                continue
            now = (row.pos, PLANNED, "", None, 1)
            self.handle.registerTimer(row.landed_ms + self.deadline_ms)
            yield self._row(address, *now[:3], 1)
        mine = [r for r in outcomes if now is not None and r.pos == now[0]]
        last = max(mine, key=self._rank, default=None)
        if last is not None and (now[3] is None or self._rank(last) > (now[3], now[1] == FAILED, now[2])):
            status, error = (SENT, "") if last.error is None else (FAILED, last.error)
            changed = (status, error) != (now[1], now[2])
            now = (last.pos, status, error, self._rank(last)[0], now[4] + changed)
            if changed:
                yield self._row(address, *now[:3], now[4])
        if now != before:
            self.attempt.update(now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = self.attempt.get()
        if now is not None and now[1] == PLANNED:
            self.attempt.update((now[0], FAILED, NO_OUTCOME, None, now[4] + 1))
            yield self._row(key[0], now[0], FAILED, NO_OUTCOME, now[4] + 1)

    def close(self) -> None:
        pass

    @staticmethod
    def _rank(row) -> tuple[int, bool, str]:
        """Outcomes in order: by time, of equal ones failures last, of these by their text."""
        return -(2**62) if row.told_us is None else row.told_us, row.error is not None, row.error or ""

    @staticmethod
    def _row(address: str, pos: int, status: str, error: str, version: int) -> Row:
        return Row(email_key=address, pos=pos, status=status, error=error, version=version)


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Deal out messages that follow a smaller ``pos`` of their address in this task: they can't be first."""
    first: dict[str, int] = {}
    for batch in batches:
        parts = []
        for address, pos, told in zip(*(batch.column(c).to_pylist() for c in ("email_key", "pos", "is_outcome"))):
            if not told and first.get(address, pos) < pos:
                parts.append(1 + pos % PARTS)
                continue
            if not told:
                first[address] = pos
            parts.append(0)
        if len(first) > REMEMBERED:
            first = {}
        columns = [*batch.columns, pa.array(parts, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "part"])


def attempt_changes(
    messages: DataFrame,
    outcomes: DataFrame,
    old_log: DataFrame,
    deadline: timedelta,
    lateness: timedelta = timedelta(hours=1),
) -> DataFrame:
    """Stream of (email_key, pos, status, error, version) for streams of messages and of outcomes.

    Messages are as in contact planning, with ``landed_at``; outcomes are (email, pos, error, told_at, landed_at).
    ``landed_at`` is the time of arrival and drives the deadlines: it must not go back by more than
    ``lateness``, else rows are left out (:func:`left_out` counts them). When an outcome was *told* is of no
    concern to that. An attempt has the smallest ``pos`` of its address in the first batch that holds the address;
    all others are duplicates, whatever becomes of it. Outcomes of other rows are ignored.
    """
    ready = approved(messages).select(
        "email_key", placed().alias("pos"), F.lit(False).alias("is_outcome"), F.lit(None).cast("string").alias("error"),
        F.lit(None).cast("bigint").alias("told_us"), "landed_at",
    )
    told = outcomes.select(
        email_key(F.col("email")).alias("email_key"), "pos", F.lit(True).alias("is_outcome"),
        present(F.col("error")).alias("error"), F.unix_micros("told_at").alias("told_us"), "landed_at",
    ).where(F.col("email_key").isNotNull() & F.col("pos").isNotNull())
    rows = ready.unionByName(told)
    dealt = rows.mapInArrow(_dealt, T.StructType([*rows.schema.fields, T.StructField("part", T.IntegerType())]))
    timed = dealt.withColumn("landed_ms", F.unix_millis("landed_at")).withWatermark(
        "landed_at", f"{int(lateness.total_seconds())} seconds"
    )
    blocked = known_contacts(old_log, live=True).select("email_key", F.lit(0).alias("part"), F.lit(True).alias("blocked"))
    return timed.groupBy("email_key", "part").transformWithState(
        Attempt(int(deadline.total_seconds() * 1000)), ATTEMPTS, "Update", "EventTime", blocked.groupBy("email_key", "part")
    )


def run_attempts(changes: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Write all changes that are there; a replayed batch replaces its own rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")

    return (
        changes.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def left_out(query: StreamingQuery) -> int:
    """Rows of a query's recent batches that landed too late for its watermark."""
    return sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)


def attempts(spark: SparkSession, table: str) -> DataFrame:
    """The newest status of every message: (email_key, pos, status, error)."""
    changes = read_optional(spark, table, ATTEMPTS)
    newest = F.max_by(F.struct("email_key", "status", "error"), F.col("version"))
    return changes.groupBy("pos").agg(newest.alias("last")).select("last.email_key", "pos", "last.status", "last.error")
