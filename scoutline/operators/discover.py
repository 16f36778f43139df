"""Discovery: what to request, what has been landed, and which creators it shows first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoutline.config import Discovery, Enrichment
from scoutline.fixed import (
    API_PAGE_LIMIT,
    DAILY_QUOTA,
    KEY_DIGITS,
    LIST_COST,
    RESULT_TYPES,
    SEARCH_COST,
)
from scoutline.functions.text import present
from scoutline.functions.values import json_string
from scoutline.operators import enrich
from scoutline.operators.ordering import running_before, unbroken

# A hit's place in discovery order is packed into one bigint, so that "first" is a plain min:
# chain (keyword, type) | page | item. A value that does not fit ends the job.
ITEM_BITS = 10
PAGE_BITS = 30
CHAIN_BITS = 63 - PAGE_BITS - ITEM_BITS
# Pages per block when looking for the page that reaches the target.
BLOCK_BITS = 14


def chain_key() -> Column:
    return F.col("keyword_idx").cast("bigint") * len(RESULT_TYPES) + F.col("type_idx")


def page_key() -> Column:
    return F.shiftleft(chain_key(), PAGE_BITS).bitwiseOR(F.col("page_idx").cast("bigint"))


def hit_position() -> Column:
    item = F.col("item_idx").cast("bigint")
    fits = (
        item.between(0, (1 << ITEM_BITS) - 1)
        & F.col("page_idx").between(0, (1 << PAGE_BITS) - 1)
        & F.col("type_idx").between(0, len(RESULT_TYPES) - 1)
        & F.col("keyword_idx").between(0, (1 << CHAIN_BITS) // len(RESULT_TYPES) - 1)
    )
    packed = F.shiftleft(page_key(), ITEM_BITS).bitwiseOR(item)
    return F.when(fits, packed).otherwise(F.raise_error(F.lit("hit position out of range")))


def request_key(**params: Column) -> Column:
    """Stable key: 24 hex digits of the SHA-256 of the key-sorted JSON text.

    Values are columns of JSON text; a NULL value leaves its parameter out.
    """
    parts = [
        F.concat(F.lit(f'"{name}": '), params[name]) for name in sorted(params)
    ]
    text = F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))
    return F.substring(F.sha2(text, 256), 1, KEY_DIGITS)


def search_requests(
    spark: SparkSession, discovery: Discovery, page_tokens: DataFrame | None = None
) -> DataFrame:
    """First-page searches for every keyword and result type, and follow-ups for known tokens.

    ``page_tokens`` (keyword_idx, type_idx, page_token) lists the next pages seen so far.
    """
    first = spark.range(1).select(
        F.posexplode(F.array(*[F.lit(k) for k in discovery.keywords])).alias(
            "keyword_idx", "keyword"
        )
    ).select(
        "*", F.posexplode(F.array(*[F.lit(t) for t in RESULT_TYPES])).alias("type_idx", "result_type")
    )
    plan = first.withColumn("page_token", F.lit(None).cast("string"))
    if page_tokens is not None:
        plan = plan.unionByName(
            page_tokens.join(first, ["keyword_idx", "type_idx"]).select(*plan.columns)
        )

    def text(value: str | None) -> Column:
        return json_string(F.lit(value)) if value else F.lit(None).cast("string")

    return plan.withColumn(
        "request_key",
        request_key(
            part=text("snippet"),
            q=json_string(F.col("keyword")),
            type=json_string(F.col("result_type")),
            maxResults=F.lit(str(min(discovery.page_size, API_PAGE_LIMIT))),
            regionCode=text(discovery.region_code),
            relevanceLanguage=text(discovery.language),
            pageToken=json_string(F.col("page_token")),
        ),
    )


def channel_requests(raw_channels: DataFrame, landed: DataFrame | None = None) -> DataFrame:
    """One request per batch of channel ids.

    Channels with a record in ``landed`` are left out before the rest is batched, so a new id never
    changes requests that were answered.
    """
    if landed is not None:
        raw_channels = raw_channels.join(landed.select("channel_id").distinct(), "channel_id", "left_anti")
    return enrich.id_batches(raw_channels).withColumn(
        "request_key",
        request_key(
            endpoint=F.lit('"channels"'),
            part=F.lit('"snippet,statistics,contentDetails"'),
            id=json_string(F.col("id_list")),
        ),
    )


def creator_requests(
    channels: DataFrame, playlist_items: DataFrame, enrichment: Enrichment, pages: DataFrame | None = None
) -> DataFrame:
    """The uploads requests of each creator, and the video requests once its uploads are known.

    A request names at most a page of videos. Where more are wanted, the next page of uploads is asked for by the
    token of the last one in ``pages`` (playlist pages as landed), and videos by several requests. Repeated
    channel records are one creator.
    """
    wanted = enrichment.recent_videos
    known = (
        enrich.recent_uploads(playlist_items, enrichment)
        .groupBy("playlist_id")
        .agg(F.array_sort(F.collect_list(F.struct("item_idx", "video_id"))).alias("items"))
        .select(
            "playlist_id",
            F.transform(
                F.sequence(F.lit(0), F.floor((F.size("items") - 1) / API_PAGE_LIMIT).cast("int")),
                lambda i: F.array_join(
                    F.transform(F.slice("items", i * API_PAGE_LIMIT + 1, API_PAGE_LIMIT), lambda x: x["video_id"]), ","
                ),
            ).alias("video_ids"),
        )
    )
    uploads = enrich.latest_records(channels).where(present(F.col("uploads_playlist")).isNotNull()).select(
        "channel_id", F.col("uploads_playlist").alias("playlist_id")
    )
    if pages is None:
        asked = uploads.withColumn("page_token", F.lit(None).cast("string"))
    else:
        asked = uploads.join(_next_pages(pages, wanted), "playlist_id", "left")

    def uploads_request(token: Column) -> Column:
        return F.struct(
            F.lit("playlistItems").alias("endpoint"),
            request_key(
                endpoint=F.lit('"playlistItems"'),
                part=F.lit('"contentDetails"'),
                playlistId=json_string(F.col("playlist_id")),
                maxResults=F.lit(str(min(wanted, API_PAGE_LIMIT))),
                pageToken=token,
            ).alias("request_key"),
        )

    of_videos = F.transform(
        F.coalesce("video_ids", F.array().cast("array<string>")),
        lambda ids: F.struct(
            F.lit("videos").alias("endpoint"),
            request_key(
                endpoint=F.lit('"videos"'), part=F.lit('"snippet,statistics"'), id=json_string(ids)
            ).alias("request_key"),
        ),
    )
    of_uploads = F.array_compact(
        F.array(
            uploads_request(F.lit(None).cast("string")),
            F.when(F.col("page_token").isNotNull(), uploads_request(json_string(F.col("page_token")))),
        )
    )
    plan = asked.join(known, "playlist_id", "left")
    return plan.select("channel_id", F.explode(F.concat(of_uploads, of_videos)).alias("request")).select(
        "channel_id", "request.*"
    )


def _next_pages(pages: DataFrame, wanted: int) -> DataFrame:
    """(playlist_id, page_token) of newest listings whose readable pages hold fewer entries than wanted and go on."""
    narrow = enrich.readable_listings(pages).select(
        "playlist_id", "fetched_at", "page_idx", present(F.col("next_page_token")).alias("token"), F.size("videos").alias("n")
    )
    listings = narrow.groupBy("playlist_id", "fetched_at").agg(
        F.max_by("token", "page_idx").alias("token"), F.sum("n").alias("n")
    )
    newest = listings.groupBy("playlist_id").agg(F.max_by(F.struct("token", "n"), F.struct("fetched_at")).alias("last"))
    return newest.where((F.col("last.n") < wanted) & F.col("last.token").isNotNull()).select(
        "playlist_id", F.col("last.token").alias("page_token")
    )


def answered(landed: DataFrame) -> DataFrame:
    """Keys of the landed requests (request_key, response); a landed JSON null counts as missing."""
    done = landed.where(F.col("response").isNotNull() & (F.trim("response") != "null"))
    return done.select("request_key")


def pending(plan: DataFrame, landed: DataFrame) -> DataFrame:
    """Requests not landed yet; a landed JSON null counts as missing.

    ``landed`` is (request_key, response). It grows without bound, so its size decides the join; a key table of
    the answers (``plans.stages.pending_requests``) spares reading it.
    """
    return plan.join(answered(landed), "request_key", "left_anti")


def readable_pages(pages: DataFrame) -> DataFrame:
    """Keep the pages of each chain up to its end; other chains go on.

    A chain ends before a failed page, before a page whose predecessor is missing, and after a page
    without a token for the next one. ``pages`` is read twice, so give a stored table.
    """
    no_next = present(F.col("next_page_token")).isNull()
    return unbroken(pages, ["keyword_idx", "type_idx"], "page_idx", F.col("status") == "error", no_next)


def explode_hits(pages: DataFrame) -> DataFrame:
    """One row per hit with the creator it names; hits without an id are dropped."""
    hits = pages.select(
        "keyword_idx", "keyword", "type_idx", "result_type", "page_idx", "fetched_at",
        F.posexplode("items").alias("item_idx", "item"),
    )
    by_channel = F.col("result_type") == "channel"
    return (
        hits.withColumn(
            "channel_id",
            present(
                F.when(by_channel, F.col("item.channel_id")).otherwise(
                    F.col("item.snippet_channel_id")
                )
            ),
        )
        .withColumn(
            "title",
            F.when(by_channel, F.coalesce("item.title", F.lit(""))).otherwise(
                F.col("item.channel_title")
            ),
        )
        .where(F.col("channel_id").isNotNull())
        .drop("item")
    )


def first_seen(hits: DataFrame) -> DataFrame:
    """One row per creator, from its first hit in discovery order."""
    first = F.struct("title", F.col("keyword").alias("source_keyword"), "fetched_at")
    return (
        hits.withColumn("pos", hit_position())
        .groupBy("channel_id")
        .agg(F.min_by(first, "pos").alias("first"), F.min("pos").alias("pos"))
        .select("channel_id", "first.*", "pos")
    )


def cap_pages(raw_channels: DataFrame, target: int) -> DataFrame:
    """Creators from the pages that are read until ``target`` creators are known.

    A page is read when fewer than ``target`` creators are known before it, and is then kept
    whole. So the last page read is the one that holds the target-th creator: find its block of
    pages, then the page, and filter.
    """
    page = F.shiftright("pos", ITEM_BITS)
    pages = raw_channels.groupBy(page.alias("page")).agg(F.count("*").alias("n"))
    blocks = (
        pages.groupBy(F.shiftright("page", BLOCK_BITS).alias("block"))
        .agg(F.sum("n").alias("n"))
    )
    last_block = (
        running_before(blocks, "block")
        .where(F.col("before") < target)
        .groupBy()
        .agg(F.max(F.struct("block", "before")).alias("last"))
        .scalar()
    )
    in_block = pages.where(F.shiftright("page", BLOCK_BITS) == last_block["block"])
    last_page = (
        running_before(in_block, "page")
        .where(F.col("before") + last_block["before"] < target)
        .groupBy()
        .agg(F.max("page").alias("last_page"))
        .scalar()
    )
    return raw_channels.where(page <= last_page)


def keyword_yield(hits: DataFrame) -> DataFrame:
    """Hits, distinct creators and newly seen creators by keyword and result type."""
    shown = hits.groupBy("keyword_idx", "type_idx", "keyword", "result_type").agg(
        F.count("*").alias("hits"), F.countDistinct("channel_id").alias("channels")
    )
    credited = (
        hits.groupBy("channel_id")
        .agg(F.min(hit_position()).alias("pos"))
        .groupBy(F.shiftright("pos", ITEM_BITS + PAGE_BITS).alias("chain"))
        .agg(F.count("*").alias("new"))
    )
    return (
        shown.withColumn("chain", chain_key())
        .join(credited, "chain", "left")
        .select(
            "keyword", "result_type", "hits", "channels",
            F.coalesce("new", F.lit(0).cast("bigint")).alias("new_channels"),
        )
    )


def request_cost() -> Column:
    return F.when(F.col("endpoint") == "search", F.lit(SEARCH_COST)).otherwise(F.lit(LIST_COST))


def quota_use(requests: DataFrame, daily_quota: int = DAILY_QUOTA) -> DataFrame:
    """Units used per UTC day by (endpoint, requested_at) rows, against the daily budget."""
    return (
        requests.groupBy(F.window("requested_at", "1 day"))
        .agg(F.count("*").alias("requests"), F.sum(request_cost()).alias("units"))
        .select(
            F.col("window.start").alias("day"),
            "requests",
            "units",
            (F.col("units") > daily_quota).alias("over_quota"),
        )
    )
