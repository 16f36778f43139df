"""Structured Streaming jobs. Each batch owns one folder of its table, so a replay replaces its
own rows and nothing is written twice."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.cloudpickle import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from scoutline.fixed import DAILY_QUOTA
from scoutline.operators.contact import approved, known_contacts, log_rows, new_dms, plan_against
from scoutline.operators.discover import hit_position, request_cost
from scoutline.schemas import CONTACT_LOG, DM_QUEUE, FLAG, RAW_CHANNELS, TIME, WHOLE, table_schema
from scoutline.session import discard, stored
from scoutline.sources import keys
from scoutline.sources.tables import read_optional

# Functions for Python workers travel whole, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Creators that a task remembers as passed on; beyond that it starts anew.
REMEMBERED = 1_000_000


def _run(
    stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str = "append"
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _first_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leave out hits of a creator that this task has passed on with a smaller ``pos``."""
    first: dict[str, int] = {}
    for batch in batches:
        kept = []
        for channel, pos in zip(batch.column("channel_id").to_pylist(), batch.column("pos").to_pylist()):
            kept.append(pos < first.get(channel, pos + 1))
            if kept[-1]:
                first[channel] = pos
        if len(first) > REMEMBERED:
            first = {}
        yield batch.filter(pa.array(kept, pa.bool_()))


def new_channels(
    hits: DataFrame, table: str, checkpoint: str, remember: timedelta = timedelta(days=1)
) -> StreamingQuery:
    """Append creators that arriving hits show for the first time.

    Repeats that arrive within ``remember`` of a creator's first hit end in the state of the stream. What passes
    is looked up in a key table of all creators, of which only the hash buckets of the batch are read, and
    then added to it. Time is the time of arrival, so no hit is ever too late, however old it is. A task
    passes on one hit per creator, however often a creator occurs. Which hit is credited depends on
    arrival, the set of ids does not.
    """
    columns = [f.name for f in RAW_CHANNELS.fields]
    seen = f"{table}_keys"
    placed = hits.select(
        "channel_id", "title", F.col("keyword").alias("source_keyword"), "fetched_at", hit_position().alias("pos")
    )
    arrived = (
        placed.mapInArrow(_first_of_task, placed.schema)
        .withColumn("arrived_at", F.current_timestamp())
        .withWatermark("arrived_at", f"{int(remember.total_seconds())} seconds")
        .dropDuplicatesWithinWatermark(["channel_id"])
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, f"{batch_id:020d}"
        shown = stored(batch.drop("arrived_at"), "shown")
        ids = shown.select(F.col("channel_id").alias("key"))
        known = keys.find(spark, seen, ids, without=name).withColumnRenamed("key", "channel_id")
        new = shown.groupBy("channel_id").agg(
            F.min_by(F.struct("title", "source_keyword", "fetched_at"), "pos").alias("first"), F.min("pos").alias("pos")
        )
        rows = new.join(known, "channel_id", "left_anti").select("channel_id", "first.*", "pos").select(*columns)
        rows.write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")
        keys.add(ids, seen, name)
        discard(shown)

    return _run(arrived, checkpoint, write)


def _base_keys(rows: DataFrame, path: str) -> None:
    """Start a key table with the keys (a column ``key``) of what was there before the stream."""
    if not keys.runs(rows.sparkSession, path):
        keys.add(rows, path, "base")


def contact_log(
    messages: DataFrame,
    base_log: DataFrame,
    table: str,
    checkpoint: str,
    run_at: datetime,
    live: bool = False,
) -> StreamingQuery:
    """Plan contacts for arriving messages against the old log and all earlier batches.

    The addresses of both are in a key table beside the log, of which only the buckets of the batch are read.
    """
    columns, seen = [f.name for f in CONTACT_LOG.fields], f"{table}_keys"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, f"{batch_id:020d}"
        _base_keys(known_contacts(base_log, live).withColumnRenamed("email_key", "key"), seen)
        arrived = stored(batch, "messages")
        asked = stored(approved(arrived).select(F.col("email_key").alias("key")).distinct(), "addresses")
        known = keys.find(spark, seen, asked, without=name).withColumnRenamed("key", "email_key")
        plan = plan_against(arrived, known, live)
        log_rows(plan, run_at).select(*columns).write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")
        # Whatever is approved is in the log by now, under this batch or an earlier one.
        keys.add(asked, seen, name)
        discard(arrived)
        discard(asked)

    return _run(messages, checkpoint, write)


def dm_queue(
    messages: DataFrame, base_queue: DataFrame, table: str, checkpoint: str
) -> StreamingQuery:
    """Queue the first direct message of creators that neither the old queue nor an earlier batch has."""
    columns, seen = [f.name for f in DM_QUEUE.fields], f"{table}_keys"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, f"{batch_id:020d}"
        _base_keys(base_queue.select(F.col("influencer_id").alias("key")), seen)
        none = base_queue.select(*columns).limit(0)
        first = stored(new_dms(batch, none).select(*columns), "first-dms")
        ids = first.select(F.col("influencer_id").alias("key"))
        known = keys.find(spark, seen, ids, without=name).withColumnRenamed("key", "influencer_id")
        rows = first.join(known, "influencer_id", "left_anti").select(*columns)
        rows.write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")
        keys.add(ids, seen, name)
        discard(first)

    return _run(messages, checkpoint, write)


QUOTA_DAYS = table_schema(day=TIME, requests=WHOLE, units=WHOLE, closed=FLAG, version=WHOLE)


def _sums_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Requests and units by day and arrival of all rows of a task."""
    sums = None
    for batch in batches:
        # By name alone: the sums may be null where the columns they come from are not.
        part = pa.table(batch.columns, names=batch.schema.names)
        part = part if sums is None else pa.concat_tables([sums, part])
        added = part.group_by(["day", "landed_at"]).aggregate([("requests", "sum"), ("units", "sum")])
        sums = added.rename_columns([c.removesuffix("_sum") for c in added.column_names]).select(batch.schema.names)
    if sums is not None:
        yield from sums.to_batches()


class QuotaDay(StatefulProcessor):
    """State of a day: its sums so far, and whether it was closed."""

    def __init__(self, lateness_ms: int):
        self.lateness_ms = lateness_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.day = handle.getValueState("day", "requests bigint, units bigint, closed boolean, version bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = self.day.get()
        if now is None:
            now = (0, 0, False, 0)
            end = int(key[0].replace(tzinfo=timezone.utc).timestamp() * 1000) + 86_400_000
            self.handle.registerTimer(end + self.lateness_ms)
        requests, units = now[0], now[1]
        for row in rows:
            requests, units = requests + row.requests, units + row.units
        yield self._changed(key, requests, units, now[2], now[3] + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = self.day.get()
        yield self._changed(key, now[0], now[1], True, now[3] + 1)

    def _changed(self, key, *now) -> Row:
        self.day.update(now)
        return Row(day=key[0], requests=now[0], units=now[1], closed=now[2], version=now[3])

    def close(self) -> None:
        pass


def daily_quota(
    requests: DataFrame, table: str, checkpoint: str, lateness: timedelta = timedelta(days=1)
) -> StreamingQuery:
    """Units used per UTC day of (endpoint, requested_at, landed_at) rows, kept as one state a day.

    ``landed_at`` is the time of arrival: a day is closed when the arrivals are ``lateness`` past its end. Rows that
    land later still count: they make a new version of the closed day. A task sends one sum per day, so no day is
    gathered, however busy. Arrivals may go back by up to an hour.
    """
    day = F.date_trunc("day", "requested_at")
    one = F.lit(1).cast("bigint")
    costs = requests.where(F.col("requested_at").isNotNull()).select(
        day.alias("day"), "landed_at", one.alias("requests"), request_cost().cast("bigint").alias("units")
    )
    timed = costs.mapInArrow(_sums_of_task, costs.schema).withWatermark("landed_at", "1 hour")
    changes = timed.groupBy("day").transformWithState(
        QuotaDay(int(lateness.total_seconds() * 1000)), QUOTA_DAYS, "Update", "EventTime"
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")

    return _run(changes, checkpoint, write, "update")


def quota_totals(spark: SparkSession, table: str, daily_budget: int = DAILY_QUOTA) -> DataFrame:
    """The newest sums of every day against the daily budget: (day, requests, units, over_quota, closed)."""
    days = read_optional(spark, table, QUOTA_DAYS)
    newest = F.max_by(F.struct("requests", "units", "closed"), F.col("version"))
    return days.groupBy("day").agg(newest.alias("last")).select(
        "day", "last.requests", "last.units", (F.col("last.units") > daily_budget).alias("over_quota"), "last.closed"
    )
