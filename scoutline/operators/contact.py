"""Contact planning: approved messages, each address once, against an append-only log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoutline.fixed import (
    DUPLICATE,
    FAILED,
    PENDING_APPROVAL,
    PENDING_MANUAL,
    SENT,
    SIMULATED,
)
from scoutline.functions.text import is_valid_email, present, strip
from scoutline.functions.values import moment_literal, to_flag
from scoutline.schemas import DM_QUEUE, CONTACT_LOG

# Our own: a live attempt whose delivery outcome is not known yet.
PLANNED = "PLANNED"


def email_key(email: Column) -> Column:
    return F.lower(strip(email))


def approved(messages: DataFrame) -> DataFrame:
    """Explicitly approved drafts with a valid address, with their contact key."""
    return messages.where(
        to_flag(F.col("approved"))
        & (F.col("message_status") == PENDING_APPROVAL)
        & is_valid_email(F.col("email"))
    ).withColumn("email_key", email_key(F.col("email")))


def blocks(status: Column) -> Column:
    """Whether a log row blocks its address for live runs; one without a status does, it may have been sent."""
    return ~F.coalesce(status, F.lit("")).isin(SIMULATED, DUPLICATE)


def known_contacts(log: DataFrame, live: bool) -> DataFrame:
    """Distinct keys that block a contact; a live run ignores simulated and skipped rows."""
    counted = log.where(blocks(F.col("status"))) if live else log
    keys = counted.select(present(email_key(F.col("email"))).alias("email_key"))
    return keys.where(F.col("email_key").isNotNull()).distinct()


def placed() -> Column:
    """The message order; a message without one would silently lose its place, so it ends the job."""
    return F.coalesce("pos", F.raise_error(F.lit("a message has no pos")).cast("bigint"))


def plan_contacts(messages: DataFrame, log: DataFrame, live: bool = False) -> DataFrame:
    """Status of every approved message against a log; see :func:`plan_against`."""
    return plan_against(messages, known_contacts(log, live), live)


def plan_against(messages: DataFrame, known: DataFrame, live: bool = False) -> DataFrame:
    """Status of every approved message; ``pos`` must be unique and give the message order.

    ``known`` has the keys (email_key) of the addresses that may not be contacted. The first message of an address is attempted unless its key is known; all others
    are duplicates. One address may own a large share of the messages: it is reduced to its first
    ``pos`` before the shuffle, the log check runs on one row per address, and the verdict
    returns by ``pos``. No task ever gathers the messages of one address.
    """
    ready = approved(messages).withColumn("pos", placed())
    firsts = ready.groupBy("email_key").agg(F.min("pos").alias("pos"))
    fresh = firsts.join(known, "email_key", "left_anti").select(
        "pos", F.lit(True).alias("attempted")
    )
    attempt = F.lit(PLANNED if live else SIMULATED)
    return (
        ready.join(fresh, "pos", "left")
        .withColumn("status", F.when(F.col("attempted"), attempt).otherwise(F.lit(DUPLICATE)))
        .drop("attempted")
    )


def yield_addresses(plan: DataFrame, claims: DataFrame) -> DataFrame:
    """A plan in which planned rows whose address others have claimed count as duplicates.

    A plan has one planned row per address, so only those meet the claims; the verdict returns by ``pos``.
    """
    planned = F.col("status") == PLANNED
    taken = plan.where(planned).join(claims, "email_key", "left_semi").select("pos", F.lit(True).alias("taken"))
    return (
        plan.join(taken, "pos", "left")
        .withColumn("status", F.when(F.col("taken"), F.lit(DUPLICATE)).otherwise(F.col("status")))
        .drop("taken")
    )


def merge_outcomes(plan: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Settle planned rows with delivery outcomes (pos, error, told_at); an error fails that row only.

    Of several outcomes for one row the newest counts, and of equally new ones a failure. Rows without
    an outcome stay planned; outcomes of other rows are ignored.
    """
    when = F.col("told_at") if "told_at" in outcomes.columns else F.lit(None).cast("timestamp")
    rank = F.struct(when.alias("told_at"), present(F.col("error")).isNotNull(), "error")
    told = outcomes.groupBy("pos").agg(F.max_by("error", rank).alias("error"), F.lit(True).alias("told"))
    planned = F.col("status") == PLANNED
    return (
        plan.join(told, "pos", "left")
        .withColumn(
            "settled",
            F.when(planned & F.col("told") & present(F.col("error")).isNull(), F.lit(SENT))
            .when(planned & F.col("told"), F.lit(FAILED))
            .otherwise(F.col("status")),
        )
        .withColumn(
            "error", F.when(F.col("settled") == FAILED, F.col("error")).otherwise(F.lit(""))
        )
        .drop("status", "told")
        .withColumnRenamed("settled", "status")
    )


def log_rows(plan: DataFrame, run_at: datetime) -> DataFrame:
    """Rows to append to the log, in its layout, with the address as it was written."""
    error = F.col("error") if "error" in plan.columns else F.lit("")
    values = {
        "influencer_id": F.col("influencer_id"),
        "influencer": F.col("influencer"),
        "email": F.col("email"),
        "message_generated": F.col("email_message"),
        "email_subject": F.col("subject"),
        "sent": F.col("status") == SENT,
        "date": moment_literal(run_at),
        "status": F.col("status"),
        "error": error,
    }
    return plan.select(*[values[f.name].alias(f.name) for f in CONTACT_LOG.fields])


def new_dms(messages: DataFrame, queue: DataFrame) -> DataFrame:
    """Queue rows to add: the first non-blank DM of each creator that is not queued yet."""
    named = messages.select(
        placed().alias("pos"), "influencer_id", "influencer", strip(F.col("dm")).alias("dm")
    ).where(
        present(F.col("influencer_id")).isNotNull() & present(F.col("dm")).isNotNull()
    )
    return (
        named.groupBy("influencer_id")
        .agg(F.min_by(F.struct("influencer", "dm"), "pos").alias("first"))
        .join(queue.select("influencer_id"), "influencer_id", "left_anti")
        .select("influencer_id", "first.*", F.lit(PENDING_MANUAL).alias("status"))
    )


def dm_queue(messages: DataFrame, queue: DataFrame) -> DataFrame:
    """The old queue unchanged, followed by the new rows."""
    columns = [f.name for f in DM_QUEUE.fields]
    return queue.select(*columns).unionByName(new_dms(messages, queue).select(*columns))


def partial_counts(log: DataFrame) -> DataFrame:
    """Attempts by day and status of some log rows; partials of any logs add up."""
    return log.groupBy(F.to_date("date").alias("day"), "status").agg(F.count("*").alias("attempts"))


def partial_sets(log: DataFrame, numbers: DataFrame) -> DataFrame:
    """The addresses of log rows by day and status, as bitmaps over their dense numbers (key, number).

    A bitmap holds the addresses of one chunk of numbers; partials of any logs are united bit by bit.
    """
    rows = log.select(F.to_date("date").alias("day"), "status", email_key(F.col("email")).alias("key")).distinct()
    return (
        rows.join(numbers, "key")
        .groupBy("day", "status", F.bitmap_bucket_number("number").alias("chunk"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
    )


def tracking_of_partials(counts: DataFrame, sets: DataFrame) -> DataFrame:
    """The report of :func:`tracking` from partial counts and sets, which may be those of any runs or days."""
    level = F.element_at(F.array(F.lit("status"), F.lit("day"), F.lit("all")), F.col("depth") + 1)
    attempts = counts.rollup("day", "status").agg(
        F.sum("attempts").alias("attempts"), F.bit_count(F.grouping_id()).cast("int").alias("depth")
    )
    day, status, chunk = (F.col(c) for c in ("day", "status", "chunk"))
    united = sets.groupingSets([[day, status, chunk], [day, chunk], [chunk]], day, status, chunk).agg(
        F.bitmap_or_agg("bits").alias("bits"), F.bit_count(F.grouping_id()).cast("int").alias("depth")
    )
    contacts = united.groupBy("depth", "day", "status").agg(F.sum(F.bitmap_count("bits")).alias("contacts"))
    contacts = contacts.select(*[F.col(c).alias(f"_{c}") for c in ("depth", "day", "status")], "contacts")
    same = (
        (F.col("depth") == F.col("_depth")) & F.col("day").eqNullSafe(F.col("_day")) & F.col("status").eqNullSafe(F.col("_status"))
    )
    return attempts.join(contacts, same, "left").select(
        "day", "status", level.alias("level"), "attempts", F.coalesce("contacts", F.lit(0).cast("bigint")).alias("contacts")
    )


def tracking(log: DataFrame) -> DataFrame:
    """Attempts and distinct addresses by day and status, with subtotals.

    ``level`` tells them apart: status, day or all. A status may be NULL in the log.
    """
    level = F.element_at(F.array(F.lit("status"), F.lit("day"), F.lit("all"), F.lit("all")), F.grouping_id().cast("int") + 1)
    return (
        log.select(F.to_date("date").alias("day"), "status", email_key(F.col("email")).alias("key"))
        .rollup("day", "status")
        .agg(level.alias("level"), F.count("*").alias("attempts"), F.countDistinct("key").alias("contacts"))
    )
