"""The engine's input tables as views over the TPC-H-like test tables.

Events are search hits, customers are channels, orders are uploads whose line items give the
counts, conversations are draft attempts. Every view covers its whole base table and needs no
window: positions and attempt numbers are computed from keys.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYWORDS = ("click", "error", "purchase", "signup", "view")
_PARTS = "th er an in re on at en nd ti es or te of ed is it al ar st".split()
SYLLABLES = (*_PARTS, *(a + b for a in _PARTS for b in _PARTS))
OLD_LANDING, NEW_LANDING = "2001-07-01 00:00:00", "2001-08-01 00:00:00"


@lru_cache(maxsize=None)
def _schema(spark: SparkSession, path: str) -> T.StructType:
    return spark.read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table; its footer is read once per session, not once per use."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def text_id(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


# Search hits and pages ----------------------------------------------------------------------


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def event_hits(events: DataFrame) -> DataFrame:
    """Search hits, 100 events to a page number, half of them per result type."""
    keyword_idx = F.array_position(F.array(*[F.lit(k) for k in KEYWORDS]), F.col("event_type")) - 1
    shifted = F.col("user_id") + 40 * F.col("keyword_idx")
    return (
        events.withColumn("keyword_idx", keyword_idx.cast("int"))
        .select(
            "keyword_idx",
            F.col("event_type").alias("keyword"),
            (F.col("event_id") % 2).cast("int").alias("type_idx"),
            F.when(F.col("event_id") % 2 == 0, "channel").otherwise("video").alias("result_type"),
            F.floor(F.col("event_id") / 100).cast("int").alias("page_idx"),
            F.floor((F.col("event_id") % 100) / 2).cast("int").alias("item_idx"),
            text_id("UC", shifted).alias("channel_id"),
            F.concat(F.lit("Channel "), shifted.cast("string")).alias("title"),
            F.col("ts").cast("timestamp").alias("fetched_at"),
            "value",
        )
    )


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_hits(events(spark, sf_dir))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed result pages; small values stand for hits without an id or a title. One chain lacks a page,
    one has stale pages after the page that names no next one."""
    is_channel = F.col("result_type") == "channel"
    id_or_null = F.when(F.col("value") >= 1, F.col("channel_id"))
    title_or_null = F.when(F.col("value") >= 2, F.col("title"))
    item = F.struct(
        "item_idx",
        F.when(is_channel, id_or_null).alias("channel_id"),
        F.when(~is_channel, id_or_null).alias("snippet_channel_id"),
        F.when(is_channel, title_or_null).alias("title"),
        F.when(~is_channel, title_or_null).alias("channel_title"),
    )
    failed = ((F.col("keyword_idx") == 1) & (F.col("type_idx") == 0) & (F.col("page_idx") == 7)) | (
        (F.col("keyword_idx") == 3) & (F.col("type_idx") == 1) & (F.col("page_idx") == 40)
    )
    chain = F.col("keyword_idx") * 2 + F.col("type_idx")
    return (
        hits(spark, sf_dir)
        .where(~((chain == 4) & (F.col("page_idx") == 20)))
        .groupBy("keyword_idx", "keyword", "type_idx", "result_type", "page_idx")
        .agg(
            F.min("fetched_at").alias("fetched_at"),
            F.array_sort(F.collect_list(item)).alias("found"),
        )
        .select(
            "keyword_idx", "keyword", "type_idx", "result_type", "page_idx",
            F.when(failed, "error").otherwise("ok").alias("status"),
            "fetched_at",
            F.transform(
                "found",
                lambda x: F.struct(
                    x["channel_id"].alias("channel_id"),
                    x["snippet_channel_id"].alias("snippet_channel_id"),
                    x["title"].alias("title"),
                    x["channel_title"].alias("channel_title"),
                ),
            ).alias("items"),
            F.when(
                ~((chain == 9) & (F.col("page_idx") == 60)),
                F.concat(F.lit("p"), (F.col("page_idx") + 1).cast("string")),
            ).alias("next_page_token"),
        )
    )


def requests(events: DataFrame) -> DataFrame:
    """One API request per event; even ones are searches. Other columns than those of events stay."""
    return events.select(
        *[c for c in events.columns if c not in ("event_id", "ts", "user_id", "event_type", "value")],
        F.when(F.col("event_id") % 2 == 0, "search").otherwise("list").alias("endpoint"),
        F.col("ts").cast("timestamp").alias("requested_at"),
    )


# Channels, uploads and videos ---------------------------------------------------------------


def contact_text() -> Column:
    key = F.col("c_custkey")
    number = key.cast("string")
    host = (
        F.when(key % 7 == 0, "example.com")
        .when(key % 5 == 0, "No_Host")
        .otherwise(F.concat("c_mktsegment", F.lit(".test")))
    )

    def part(condition: Column, *pieces: str | Column) -> Column:
        text = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])
        return F.when(condition, text).otherwise("")

    return F.concat(
        F.lit("Biz: "), F.replace("c_name", F.lit("#"), F.lit(".")), F.lit("@"), host, F.lit(". "),
        part(key % 3 == 0, "(https://www.Instagram.com/u", number, ") "),
        part(key % 6 == 0, "https://instagram.com/b", number, ". "),
        part(key % 4 == 0, "https://www.youtube.com/x, https://youtu.be/y "),
        part(key % 5 == 1, "http://shop", number, ".test:8080/a?b=1;"),
        part(key % 11 == 0, "alt@second.org"),
    )


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel records of all customers in the CHANNELS schema."""
    key = F.col("c_custkey")
    nations = table(spark, sf_dir, "nation")
    count = F.floor((F.col("c_acctbal") + 1000) * 10).cast("string")
    return (
        table(spark, sf_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            text_id("UC", key).alias("channel_id"),
            F.lit(0).cast("bigint").alias("resp_pos"),
            F.col("c_name").alias("title"),
            contact_text().alias("description"),
            F.col("n_name").alias("country"),
            F.when(key % 13 == 0, F.lit(None).cast("string"))
            .when(key % 9 == 0, "fr")
            .otherwise("en")
            .alias("default_language"),
            F.when(F.col("c_nationkey") % 2 == 0, "en").otherwise("").alias(
                "default_audio_language"
            ),
            F.when(key % 23 == 0, "n/a")
            .when(key % 29 == 0, "")
            .when(key % 31 == 0, "1.5")
            .otherwise(count)
            .alias("subscriber_count"),
            text_id("UU", key).alias("uploads_playlist"),
            F.when(key % 37 == 0, "country").alias("invalid_field"),
            F.lit(NEW_LANDING).cast("timestamp").alias("fetched_at"),
        )
    )


def channel_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel records as returned: none for overdrawn customers, a renamed repeat for builders, and an
    older landing of every thirteenth, which has other values and no place."""
    base = channels(spark, sf_dir)
    balances = table(spark, sf_dir, "customer").select(
        text_id("UC", F.col("c_custkey")).alias("channel_id"), "c_acctbal", "c_mktsegment"
    )
    returned = base.join(balances.where("c_acctbal >= 0"), "channel_id")
    versions = F.when(F.col("c_mktsegment") == "BUILDING", F.sequence(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    renamed = F.when(F.col("resp_pos") == 1, F.concat("title", F.lit(" v2"))).otherwise(
        F.col("title")
    )
    fresh = (
        returned.withColumn("resp_pos", F.explode(versions))
        .withColumn("resp_pos", F.col("resp_pos").cast("bigint"))
        .withColumn("title", renamed)
        .select(*base.columns)
    )
    number = F.substring("channel_id", 3, 20).cast("bigint")
    old = returned.where(number % 13 == 0).withColumns(
        {
            "title": F.lit("old name"),
            "subscriber_count": F.lit("1"),
            "resp_pos": F.lit(None).cast("bigint"),
            "fetched_at": F.lit(OLD_LANDING).cast("timestamp"),
        }
    )
    return fresh.unionByName(old.select(*base.columns))


def raw_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a discovered channel, found through its market segment."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        text_id("UC", key).alias("channel_id"),
        F.concat(F.lit("Raw "), key.cast("string")).alias("title"),
        F.col("c_mktsegment").alias("source_keyword"),
        F.lit("2001-08-01 00:00:00").cast("timestamp").alias("fetched_at"),
        key.alias("pos"),
    )


def newest_first() -> Column:
    """Sort key that puts the newest order first, and of one day the highest key."""
    days_left = F.date_diff(F.lit("2100-01-01").cast("date"), F.col("o_orderdate").cast("date"))
    return F.shiftleft(days_left.cast("bigint"), 40) - F.col("o_orderkey")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the creators that list them: their own, and of every fiftieth also the next one."""
    own = F.col("o_custkey")
    listed = F.when(F.col("o_orderkey") % 50 == 0, F.array(own, own + 1)).otherwise(F.array(own))
    return table(spark, sf_dir, "orders").withColumn("creator", F.explode(listed))


def playlist_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uploads playlists. Of every thirteenth an older landing exists, with other videos in front."""
    rows = listings(spark, sf_dir).select(
        "creator",
        text_id("UU", F.col("creator")).alias("playlist_id"),
        newest_first().alias("item_idx"),
        text_id("V", F.col("o_orderkey")).alias("video_id"),
        F.lit(NEW_LANDING).cast("timestamp").alias("fetched_at"),
    )
    old = rows.where(F.col("creator") % 13 == 0).withColumns(
        {
            "item_idx": F.col("item_idx") - 1000,
            "video_id": F.concat(F.lit("gone"), "video_id"),
            "fetched_at": F.lit(OLD_LANDING).cast("timestamp"),
        }
    )
    return rows.unionByName(old).drop("creator")


def videos(spark: SparkSession, sf_dir: str, resp_idx: Column | None = None) -> DataFrame:
    """One video per listed order with line items; counts are text and some are unusable. Every eleventh
    was landed before with other counts.

    Title and tags come from the part with the lowest key, the description from the highest. The
    aggregate holds only fixed-width values, so it can be a hash aggregate.
    """
    key = F.col("o_orderkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    first = parts.select(
        F.col("p_partkey").alias("first_part"), F.col("p_name").alias("first_name"),
        F.col("p_type").alias("kind"), F.col("p_brand").alias("brand"),
    )
    last = parts.select(
        F.col("p_partkey").alias("last_part"), F.col("p_name").alias("last_name")
    )
    counted = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum("l_quantity").alias("quantity"),
            F.count("*").alias("lines"),
            F.count_if(F.col("l_returnflag") == "R").alias("returns"),
            F.min("l_partkey").alias("first_part"),
            F.max("l_partkey").alias("last_part"),
        )
        .join(first, "first_part")
        .join(last, "last_part")
    )
    orders = listings(spark, sf_dir).select("creator", "o_orderkey", "o_orderdate")
    views = (F.col("quantity") * 10).cast("bigint").cast("string")
    new = counted.join(orders, F.col("l_orderkey") == key).select(
        text_id("UU", F.col("creator")).alias("playlist_id"),
        text_id("V", key).alias("video_id"),
        (newest_first() if resp_idx is None else resp_idx).alias("resp_idx"),
        F.col("first_name").alias("title"),
        F.col("last_name").alias("description"),
        F.array("kind", "brand").alias("tags"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_at"),
        F.when(key % 17 == 0, "0").when(key % 41 == 0, "n/a").otherwise(views).alias("view_count"),
        F.col("lines").cast("string").alias("like_count"),
        F.when(key % 19 != 0, F.col("returns").cast("string")).alias("comment_count"),
        F.lit(None).cast("string").alias("invalid_field"),
        F.lit(NEW_LANDING).cast("timestamp").alias("fetched_at"),
    )
    # Both landings come from one pass over the joins.
    landings = F.when(F.substring("video_id", 2, 20).cast("bigint") % 11 == 0, F.array(F.lit(False), F.lit(True)))
    both = new.withColumn("old", F.explode(F.coalesce(landings, F.array(F.lit(False)))))
    earlier = {"view_count": F.lit("7"), "title": F.lit("old title"), "fetched_at": F.lit(OLD_LANDING).cast("timestamp")}
    told = {name: F.when(F.col("old"), value).otherwise(F.col(name)) for name, value in earlier.items()}
    return both.withColumns(told).drop("old")


# Draft attempts -----------------------------------------------------------------------------


def draft_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns as attempts; the turn before is the DM, the first sentence the subject.

    Roles alternate, so the attempt number follows from the turn. Some responses are malformed.
    """
    turns = table(spark, sf_dir, "conversations")
    before = turns.select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("dm")
    )
    attempt = F.floor((F.col("turn") + 1) / 2).cast("int")
    response = F.to_json(
        F.struct(
            F.regexp_extract("text", r"\A[^.\n]*", 0).alias("subject"),
            F.col("text").alias("email"),
            "dm",
        ),
        {"ignoreNullFields": "false"},
    )
    shape = F.col("conv_id") % 20
    key = (F.col("conv_id") + F.col("attempt")) % 23
    return (
        turns.where(F.col("role") == "assistant")
        .join(before, ["conv_id", "turn"], "left")
        .select(
            "conv_id",
            attempt.alias("attempt"),
            F.when(shape == 0, F.concat(response, F.lit(" thanks")))
            .when(shape == 5, F.concat(F.lit("["), response, F.lit("]")))
            .when(shape == 10, F.concat(response, F.lit("}")))
            .when(shape == 15, F.replace(response, F.lit('"'), F.lit("'")))
            .otherwise(response)
            .alias("response"),
        )
        .select(
            F.col("conv_id").cast("string").alias("creator_id"),
            "attempt",
            # Failed calls answer nothing; one kind of error comes with a text all the same.
            F.when(~key.between(1, 9) | (key == 4), F.col("response")).alias("response"),
            F.when(key == 1, 429).when(key == 2, 500).when(key == 3, 400).when(key == 4, 401)
            .when(key == 5, 418).when(key == 6, 429).when(key == 7, 400).when(key == 8, 429)
            .alias("status_code"),
            F.when(key == 1, "RateLimitError").when(key == 2, "InternalServerError")
            .when(key == 3, "BadRequestError").when(key == 4, "AuthenticationError")
            .when(key == 9, "APITimeoutError")
            .alias("error_type"),
            F.when(key == 3, "json_validate_failed: bad output").when(key == 7, "bad model")
            .alias("error_message"),
            F.when(key == 1, "2.5")
            .when((key == 6) & (F.col("conv_id") % 2 == 0), "Mon, 01 Jan 2024 00:01:30 GMT")
            .when(key == 6, "Monday, 01-Jan-24 00:01:30 GMT")
            .when(key == 2, "9")
            .when((key == 8) & (F.col("conv_id") % 2 == 0), "inf")
            .when(key == 8, "1e30")
            .alias("retry_after"),
            F.lit("2024-01-01 00:00:00").cast("timestamp").alias("attempted_at"),
        )
    )


def draft_creators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as evaluated creators whose ids meet the conversations."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.when(key % 3 != 0, F.concat(F.lit("c"), key.cast("string"), F.lit("@mail.test"))).alias(
            "email"
        ),
        F.when(F.col("c_acctbal") < 0, "FAIL")
        .when(key % 3 == 0, "PASS_NO_EMAIL")
        .otherwise("PASS")
        .alias("status"),
        F.col("c_mktsegment").alias("niche"),
        key.alias("pos"),
    )


# Messages, log and queue --------------------------------------------------------------------


def customer_messages(customers: DataFrame) -> DataFrame:
    """Messages in key order; all builders share one agency address."""
    key = F.col("c_custkey")
    mailbox = (key % 700).cast("string")
    return customers.select(
        key.alias("pos"),
        (key % 1200).cast("string").alias("influencer_id"),
        F.col("c_name").alias("influencer"),
        F.when(key % 10 == 3, "Not Found")
        .when(key % 10 == 4, F.concat(F.lit("x"), key.cast("string"), F.lit("@example.com")))
        .when(F.col("c_mktsegment") == "BUILDING", " Agency@Mail.test")
        .when(key % 4 == 0, F.concat(F.lit(" U"), mailbox, F.lit("@Mail.test ")))
        .otherwise(F.concat(F.lit("u"), mailbox, F.lit("@mail.test")))
        .alias("email"),
        F.concat(F.lit("Hello "), "c_mktsegment").alias("subject"),
        F.concat(F.lit("Body "), "c_name").alias("email_message"),
        F.when(key % 6 == 0, "  ").otherwise(F.concat(F.lit(" dm "), key.cast("string"))).alias(
            "dm"
        ),
        F.when(key % 4 == 0, "True").when(key % 4 == 1, " yes").when(key % 4 == 2, "false")
        .otherwise("1")
        .alias("approved"),
        F.when(key % 9 == 0, "DRAFT").otherwise("PENDING_APPROVAL").alias("message_status"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_messages(table(spark, sf_dir, "customer"))


def contact_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old log: one row per supplier."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        key.cast("string").alias("influencer_id"),
        F.concat(F.lit("U"), key.cast("string"), F.lit("@mail.test")).alias("email"),
        F.when(key % 7 == 0, F.lit(None).cast("string"))
        .when(key % 4 == 0, "SIMULATED").when(key % 4 == 1, "SKIPPED_DUPLICATE")
        .when(key % 4 == 2, "SENT_TO_TEST_INBOX").otherwise("FAILED")
        .alias("status"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("date"),
    )


def old_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old DM queue: one row per supplier."""
    key = F.col("s_suppkey").cast("string")
    return table(spark, sf_dir, "supplier").select(
        key.alias("influencer_id"),
        F.col("s_name").alias("influencer"),
        F.concat(F.lit("old "), key).alias("dm"),
        F.lit("PENDING_MANUAL").alias("status"),
    )


def outcomes(plan: DataFrame) -> DataFrame:
    """Delivery outcomes of a live plan: every thirteenth position bounces, every eleventh is not known
    yet, and every fifth was told twice, first with another end."""
    known = plan.where((F.col("status") == "PLANNED") & (F.col("pos") % 11 != 0))
    final = F.when(F.col("pos") % 13 == 0, "mailbox full")
    at = lambda text: F.lit(text).cast("timestamp")
    told = F.array(
        F.struct(final.alias("error"), at("2024-02-01 10:00:00").alias("told_at")),
        F.when(
            F.col("pos") % 5 == 0,
            F.struct(
                F.when(F.col("pos") % 13 != 0, "busy").alias("error"), at("2024-02-01 09:00:00").alias("told_at")
            ),
        ),
    )
    return known.select("pos", F.inline(F.array_compact(told)))
