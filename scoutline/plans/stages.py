"""The five stages as table jobs: each reads tables below one folder, runs operators, and writes.

    landing/{search_pages,channels,playlist_items,videos}   landed API responses (JSON)
    raw_channels  creators_enriched  creators  shortlist    written by discover, enrich, judge
    draft_attempts                                          responses of the text generator
    messages  approvals                                     drafts, and the ids a person approved
    contact_runs/<run>  contact_log/run=<run>  dm_queue     the plans, what came of them, and DMs
    contact_claims/run=<run>                                addresses that open live runs hold
    contact_keys/{any,live}  request_keys                   key tables of the log and of answered requests
    contact_counts/run=<run>  contact_sets/run=<run>  address_numbers
                                                            partials of the tracking report, and its numbers

Every stage may run again: its tables are replaced, a contact run replaces its own plan and log
partition, and the queue takes only creators that it does not hold yet. Any number of live runs may be
open: each holds its addresses until it is settled.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoutline.config import Settings
from scoutline.functions.text import present
from scoutline.operators import contact, discover, drafts, enrich, score
from scoutline.schemas import (
    CONTACT_LOG,
    CREATORS,
    DM_QUEUE,
    DRAFT_ATTEMPTS,
    MESSAGES,
    RAW_CHANNELS,
    TEXT,
    WHOLE,
    table_schema,
)
from scoutline.session import discard, drop_dir, stored
from scoutline.sources import claims, keys, landing, tables
from scoutline.sources import numbers as numbering

APPROVALS = table_schema(draft_key=TEXT)
_COUNTS = table_schema(day=T.DateType(), status=TEXT, attempts=WHOLE)
_SETS = table_schema(day=T.DateType(), status=TEXT, chunk=WHOLE, bits=T.BinaryType())


def find(spark: SparkSession, base: str, settings: Settings) -> DataFrame:
    """Landed search pages to raw channels; with a target, up to the page that reaches it."""
    # The landed pages are parsed once; all that follows reads the stored ones.
    pages = stored(landing.search_pages(spark, f"{base}/landing/search_pages"), "search-pages")
    hits = discover.explode_hits(discover.readable_pages(pages))
    found = stored(discover.first_seen(hits), "first-seen")
    if settings.discovery.target is not None:
        found = discover.cap_pages(found, settings.discovery.target)
    tables.write_raw_channels(found, f"{base}/raw_channels")
    return tables.read_table(spark, f"{base}/raw_channels", RAW_CHANNELS)


def enriched(spark: SparkSession, base: str, settings: Settings) -> DataFrame:
    """Raw channels and landed records to creators; one row in, one row out."""
    records = enrich.creators(
        tables.read_table(spark, f"{base}/raw_channels", RAW_CHANNELS),
        landing.channels(spark, f"{base}/landing/channels"),
        landing.playlist_items(spark, f"{base}/landing/playlist_items"),
        landing.videos(spark, f"{base}/landing/videos"),
        settings,
    )
    tables.write_creators(records, f"{base}/creators_enriched")
    return tables.read_table(spark, f"{base}/creators_enriched", CREATORS)


def judged(spark: SparkSession, base: str, settings: Settings, as_of: datetime) -> DataFrame:
    """Creators with status, reasons and score, and the ranked shortlist; returns the shortlist."""
    records = tables.read_table(spark, f"{base}/creators_enriched", CREATORS)
    results = score.evaluate(records, settings, as_of).select(*CREATORS.fieldNames())
    tables.write_creators(results, f"{base}/creators")
    ranked = score.shortlist(tables.read_table(spark, f"{base}/creators", CREATORS))
    tables.write_shortlist(ranked, f"{base}/shortlist")
    return spark.read.schema(ranked.schema).parquet(f"{base}/shortlist")


def prompts(spark: SparkSession, base: str, settings: Settings, template: str) -> DataFrame:
    """First prompts of the shortlist, for the text generator."""
    ranked = tables.read_table(spark, f"{base}/shortlist", CREATORS)
    return drafts.prompts(ranked, template, settings.angles, settings.brand)


def drafted(spark: SparkSession, base: str, settings: Settings) -> DataFrame:
    """Valid drafts as messages. A fatal error in the attempt log stops the run unwritten."""
    attempts = tables.read_optional(spark, f"{base}/draft_attempts", DRAFT_ATTEMPTS)
    if not drafts.failure_classes(attempts).where("abort").isEmpty():
        raise RuntimeError("the attempt log holds a fatal error; nothing was written")
    ready = drafts.eligible(tables.read_table(spark, f"{base}/shortlist", CREATORS)).withColumn(
        "collab_angle", drafts.collaboration_angle(settings.angles)
    )
    found = stored(drafts.first_valid(drafts.check_attempts(attempts, settings.drafts)), "drafts")
    written = drafts.messages(ready, found)
    tables.write_messages(written, drafts.run_summary(ready, found), f"{base}/messages")
    return tables.read_table(spark, f"{base}/messages", MESSAGES)


def draft_key() -> Column:
    """Identity of a draft's text; approvals name it, so a new draft needs a new approval."""
    return F.sha2(
        F.to_json(F.struct("influencer_id", "email", "subject", "email_message", "dm")), 256
    )


def approvable(messages: DataFrame) -> DataFrame:
    return messages.withColumn("draft_key", draft_key())


def _approved_messages(spark: SparkSession, base: str) -> DataFrame:
    approvals = tables.read_optional(spark, f"{base}/approvals", APPROVALS)
    known = approvals.distinct().withColumn("given", F.lit(True))
    return (
        approvable(tables.read_table(spark, f"{base}/messages", MESSAGES))
        .join(known, "draft_key", "left")
        .withColumn("approved", F.coalesce(F.col("approved") | F.col("given"), F.lit(False)))
        .drop("given")
    )


def _log(spark: SparkSession, base: str, without: str | None = None) -> DataFrame:
    """The contact log of all runs, each in a partition of its own."""
    with_run = T.StructType([*CONTACT_LOG.fields, T.StructField("run", T.StringType())])
    log = tables.read_optional(spark, f"{base}/contact_log", with_run)
    return log.where(F.col("run") != without) if without else log


def land_answers(landed: DataFrame, base: str, name: str) -> None:
    """Add the answered requests of one landing (request_key, response) to the key table."""
    answers = discover.answered(landed).withColumnRenamed("request_key", "key")
    keys.add(answers, f"{base}/request_keys", name)


def pending_requests(plan: DataFrame, base: str) -> DataFrame:
    """Requests of a stored plan that no landing has answered; reads the key buckets of the plan only."""
    asked = plan.select(F.col("request_key").alias("key"))
    done = keys.find(plan.sparkSession, f"{base}/request_keys", asked)
    return plan.join(done.withColumnRenamed("key", "request_key"), "request_key", "left_anti")


def _key_table(base: str, live: bool) -> str:
    return f"{base}/contact_keys/{'live' if live else 'any'}"


def _add_to_keys(log: DataFrame, base: str) -> None:
    """Add log rows (email, status, run) to the key tables of dry and of live planning."""
    for live in (False, True):
        counted = log.where(contact.blocks(F.col("status"))) if live else log
        named = counted.select(present(contact.email_key(F.col("email"))).alias("key"), F.col("run").alias("name"))
        keys.add(named, _key_table(base, live))


def index_log(spark: SparkSession, base: str) -> None:
    """Make the key tables anew from the whole log."""
    drop_dir(spark, f"{base}/contact_keys")
    _add_to_keys(_log(spark, base).select("email", "status", "run"), base)


def plan_run(
    spark: SparkSession, base: str, run: str, messages: DataFrame, live: bool = False
) -> DataFrame:
    """Plan messages against the log of all other runs and the addresses that open runs hold.

    Of the log only the key buckets of the messages' addresses are read; a log without key tables is indexed first.
    The plan is stored under the run id and logged nowhere; a repeat replaces it. A live plan holds its
    addresses until the run is settled.
    """
    if not keys.runs(spark, _key_table(base, False)):
        index_log(spark, base)
    claim_path = f"{base}/contact_claims"
    held = claims.claimed(spark, claim_path, without=run).select("email_key").distinct()
    asked = stored(contact.approved(messages).select(F.col("email_key").alias("key")).distinct(), "addresses")
    known = keys.find(spark, _key_table(base, live), asked, without=run)
    blocked = known.withColumnRenamed("key", "email_key").unionByName(held)
    plan = contact.plan_against(messages, blocked, live)
    if live:
        plan = claims.want(stored(plan, "plan"), claim_path, run)
    plan = tables.store(plan, f"{base}/contact_runs/{run}")
    if live:
        claims.hold(plan, claim_path, run)
    discard(asked)
    return plan


def planned(spark: SparkSession, base: str, run: str, live: bool = False) -> DataFrame:
    """Plan the approved messages as :func:`plan_run` does, and queue DMs; returns the plan.

    Approvals are a table of draft keys.
    """
    messages = _approved_messages(spark, base)
    plan = plan_run(spark, base, run, messages, live)
    queue = tables.read_optional(spark, f"{base}/dm_queue", DM_QUEUE)
    tables.append_dms(messages, queue, f"{base}/dm_queue")
    return plan


def count_run(log: DataFrame, base: str, run: str) -> None:
    """Write the partials of one run's log rows; a repeat replaces them."""
    addresses = log.select(present(contact.email_key(F.col("email"))).alias("key"))
    numbers = numbering.numbered(addresses, f"{base}/address_numbers", run)
    contact.partial_counts(log).write.mode("overwrite").parquet(f"{base}/contact_counts/run={run}")
    contact.partial_sets(log, numbers).write.mode("overwrite").parquet(f"{base}/contact_sets/run={run}")


def tracked(spark: SparkSession, base: str, days: Column | None = None) -> DataFrame:
    """The tracking report over all settled runs, or over the days of a condition on ``day``; no log is read."""
    counts = tables.read_optional(spark, f"{base}/contact_counts", _COUNTS)
    sets = tables.read_optional(spark, f"{base}/contact_sets", _SETS)
    if days is not None:
        counts, sets = counts.where(days), sets.where(days)
    return contact.tracking_of_partials(counts, sets)


def settled(
    spark: SparkSession, base: str, run: str, run_at: datetime, outcomes: DataFrame | None = None
) -> DataFrame:
    """The run's log rows: its stored plan with the newest outcome of each row, written as the log
    partition of the run, which then blocks its addresses in place of the claims. A repeat, with more
    outcomes or the same, replaces that partition."""
    plan = spark.read.parquet(f"{base}/contact_runs/{run}")
    if outcomes is not None:
        plan = contact.merge_outcomes(plan, outcomes)
    rows = stored(contact.log_rows(plan, run_at), "log-rows")
    own = _log(spark, base).where(F.col("run") == run)
    # Addresses that an earlier version of the run logged and this one does not would stay in the key tables.
    gone = not own.select("email").join(rows.select("email"), "email", "left_anti").isEmpty()
    rows.write.mode("overwrite").parquet(f"{base}/contact_log/run={run}")
    if gone:
        index_log(spark, base)
    else:
        _add_to_keys(rows.select("email", "status", F.lit(run).alias("run")), base)
    claims.release(spark, f"{base}/contact_claims", run)
    count_run(rows, base, run)
    discard(rows)
    return _log(spark, base).where(F.col("run") == run)
