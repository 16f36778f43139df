"""Enrichment: join what was landed for each creator into one record with metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from scoutline.config import Enrichment, Settings
from scoutline.fixed import (
    API_BATCH_LIMIT,
    DEFAULT_SOURCE,
    EMAIL_SOURCE,
    PLATFORM,
    PROFILE_URL_PREFIX,
    UNFILTERED,
)
from scoutline.functions.text import (
    MASK_BITS,
    extract_email,
    keyword_hits,
    keyword_masks,
    keyword_names,
    mask_keywords,
    present,
    profile_links,
)
from scoutline.functions.values import bound, to_count, to_timestamp
from scoutline.operators.ordering import position, unbroken
from scoutline.schemas import CREATORS

HASH_DIGITS = 3
# A page of a listing holds less than 2^10 entries.
PAGE_ITEM_BITS = 10


def id_batches(
    raw_channels: DataFrame, size: int = API_BATCH_LIMIT, hash_digits: int = HASH_DIGITS
) -> DataFrame:
    """Comma-joined id batches of at most ``size``; every id once, every batch but the last full.

    Ids are laid out by hash prefix, so the numbering never passes through one task; there are
    16 ** ``hash_digits`` prefixes.
    """
    hashed = raw_channels.select(
        "channel_id", F.substring(F.sha2("channel_id", 256), 1, hash_digits).alias("prefix")
    )
    numbered = position(hashed, "prefix", ["channel_id"])
    return (
        numbered.groupBy(F.floor(F.col("position") / size).alias("batch"))
        .agg(
            F.count("*").alias("ids"),
            F.array_sort(F.collect_list("channel_id")).alias("members"),
        )
        .select("batch", "ids", F.array_join("members", ",").alias("id_list"))
    )


def channel_facts(channels: DataFrame, keywords: tuple[str, ...]) -> DataFrame:
    """What a record needs of each channel, without its long description.

    The text rules run in the scan stage, so descriptions are not shuffled by the joins that
    follow; only keywords with a blank still need the text.
    """
    description = F.col("description")
    masks = keyword_masks(F.coalesce(description, F.lit("")), keywords)
    return channels.select(
        "*", profile_links(description).alias("links"), extract_email(description).alias("email")
    ).select(
        "channel_id",
        "resp_pos",
        "fetched_at",
        F.coalesce("title", F.lit("")).alias("name"),
        to_count(F.col("subscriber_count")).alias("followers"),
        "email",
        F.when(F.col("email").isNotNull(), F.lit(EMAIL_SOURCE)).alias("email_source"),
        F.col("links.instagram").alias("instagram_url"),
        F.col("links.website").alias("website"),
        present(F.col("country")).alias("country"),
        spoken_language().alias("language"),
        "uploads_playlist",
        "invalid_field",
        *[mask.alias(f"own_mask_{i}") for i, mask in enumerate(masks)],
        *(["description"] if _seam_keywords(keywords) else []),
    )


def latest_records(channels: DataFrame) -> DataFrame:
    """One record per channel id: of the newest landing the last in response order.

    A missing time or place counts as the oldest; what is still equal is decided by the content.
    """
    order = ("fetched_at", "resp_pos")
    fields = [c for c in channels.columns if c not in ("channel_id", *order)]
    rank = F.struct(*order, F.xxhash64(*fields))
    return (
        channels.groupBy("channel_id")
        .agg(F.max_by(F.struct(*fields), rank).alias("record"))
        .select("channel_id", "record.*")
    )


def readable_listings(pages: DataFrame) -> DataFrame:
    """Pages of uploads playlists up to the end of each listing.

    A listing is (playlist_id, fetched_at): its pages carry the time at which it was begun. It ends as a chain of
    search pages does. ``pages`` is read twice, so give a stored table.
    """
    no_next = present(F.col("next_page_token")).isNull()
    return unbroken(pages, ["playlist_id", "fetched_at"], "page_idx", F.col("status") == "error", no_next)


def listed_videos(pages: DataFrame) -> DataFrame:
    """One row per entry of the readable pages; ``item_idx`` keeps the order over all pages of a listing."""
    first = F.shiftleft(F.col("page_idx").cast("bigint"), PAGE_ITEM_BITS)
    return (
        readable_listings(pages)
        .select("playlist_id", "fetched_at", first.alias("first"), F.posexplode("videos").alias("place", "video_id"))
        .select("playlist_id", (F.col("first") + F.col("place")).alias("item_idx"), "video_id", "fetched_at")
    )


def recent_uploads(playlist_items: DataFrame, enrichment: Enrichment) -> DataFrame:
    """The first N entries of each uploads playlist as it was landed last, in playlist order.

    The rank filter reaches below the shuffle as a partial group limit, so each input task
    passes on at most N places per playlist, however long it is. An entry landed twice at one time
    counts once.
    """
    newest = Window.partitionBy("playlist_id").orderBy(F.col("fetched_at").desc_nulls_last(), "item_idx")
    return (
        playlist_items.withColumn("place", F.dense_rank().over(newest))
        .where(F.col("place") <= enrichment.recent_videos)
        .withColumn("newest_at", F.max("fetched_at").over(Window.partitionBy("playlist_id")))
        .where(F.col("fetched_at").eqNullSafe(F.col("newest_at")))
        .groupBy("playlist_id", "item_idx")
        .agg(F.min("video_id").alias("video_id"))
        .where(present(F.col("video_id")).isNotNull())
        .select("playlist_id", "item_idx", "video_id")
    )


def uploaded_videos(uploads: DataFrame, videos: DataFrame) -> DataFrame:
    """Video records of the uploads, each as it was landed last for its playlist; ids without a record
    disappear, and a playlist that names a video twice counts it once."""
    keys = ["playlist_id", "video_id"]
    fields = [c for c in videos.columns if c not in (*keys, "fetched_at")]
    rank = F.struct("fetched_at", F.xxhash64(*fields))
    newest = videos.groupBy(*keys).agg(F.max_by(F.struct(*fields), rank).alias("record"))
    return uploads.select(*keys).distinct().join(newest, keys).select(*keys, "record.*")


def engagement() -> Column:
    """(likes + comments) / views of one video, or NULL where it does not count."""
    views, likes, comments = (
        to_count(F.col(f"{name}_count")).cast("double") for name in ("view", "like", "comment")
    )
    counts = (views != 0) & likes.isNotNull() & comments.isNotNull()
    return F.when(counts, (likes + comments) / views)


def video_text() -> Column:
    """Title, description and tags of one video."""
    blank = F.lit("")
    tags = F.coalesce(F.array_join("tags", " "), blank)
    return F.concat_ws(" ", F.coalesce("title", blank), F.coalesce("description", blank), tags)


def video_facts(videos: DataFrame, keywords: tuple[str, ...]) -> DataFrame:
    """What the metrics need of each video, computed in the scan stage.

    Descriptions and tags become keyword masks here, so the joins move only short rows.
    """
    masks = keyword_masks(F.col("text"), keywords)
    return videos.withColumn("text", video_text()).select(
        "playlist_id",
        "video_id",
        "fetched_at",
        "invalid_field",
        to_count(F.col("view_count")).alias("views"),
        F.struct(
            "resp_idx",
            F.coalesce("title", F.lit("")).alias("title"),
            engagement().alias("rate"),
            "published_at",
            *([F.col("text")] if _seam_keywords(keywords) else []),
        ).alias("video"),
        *[mask.alias(f"mask_{i}") for i, mask in enumerate(masks)],
    )


def reaction_averages(uploads: DataFrame, videos: DataFrame) -> DataFrame:
    """Average likes and comments of each playlist's recent uploads; counts that are no numbers are left out."""
    counted = videos.select(
        "playlist_id", "video_id", "fetched_at",
        to_count(F.col("like_count")).alias("likes"), to_count(F.col("comment_count")).alias("comments"),
    )
    return uploaded_videos(uploads, counted).groupBy("playlist_id").agg(
        F.avg("likes").alias("avg_likes"), F.avg("comments").alias("avg_comments")
    )


def video_metrics(
    uploads: DataFrame, videos: DataFrame, keywords: tuple[str, ...]
) -> DataFrame:
    """One row per playlist: average views, engagement, titles, latest upload, keyword masks.

    Of each playlist one small struct per recent upload is gathered. They are folded in response order, which
    keeps the mean of ratios the same on every run.
    """
    facts = uploaded_videos(uploads, video_facts(videos, keywords))
    mask_names = [c for c in facts.columns if c.startswith("mask_")]
    grouped = facts.groupBy("playlist_id").agg(
        F.avg("views").alias("avg_views"),
        F.array_sort(F.collect_list("video")).alias("videos"),
        F.max("invalid_field").alias("video_invalid"),
        *[F.bit_or(name).alias(name) for name in mask_names],
    )
    rates = F.filter(F.transform("videos", lambda v: v["rate"]), lambda r: r.isNotNull())
    mean_rate = bound(
        rates,
        lambda r: F.aggregate(r, F.lit(0.0), lambda total, x: total + x)
        / F.nullif(F.size(r), F.lit(0)),
    )
    return grouped.select(
        "playlist_id",
        "avg_views",
        mean_rate.alias("engagement_rate"),
        F.transform("videos", lambda v: v["title"]).alias("recent_titles"),
        F.element_at("videos", 1)["published_at"].alias("published_at"),
        "video_invalid",
        *mask_names,
        *(
            [F.array_join(F.transform("videos", lambda v: v["text"]), " ").alias("video_text")]
            if _seam_keywords(keywords)
            else []
        ),
    )


def _seam_keywords(keywords: tuple[str, ...]) -> list[str]:
    """Keywords with a blank can match across the blank between two texts."""
    return [k for k in keywords if " " in k]


def public_keywords(keywords: tuple[str, ...]) -> Column:
    """Keywords found in the channel description or any video text, in configured order.

    Works on ``channel_facts`` joined to ``video_metrics``. Masks combine per-text hits; only
    keywords with a blank need the joined text.
    """
    zero = F.lit(0).cast("bigint")
    words = range((len(keywords) + MASK_BITS - 1) // MASK_BITS)
    masks = [
        F.coalesce(F.col(f"own_mask_{i}"), zero).bitwiseOR(F.coalesce(F.col(f"mask_{i}"), zero))
        for i in words
    ]
    found = mask_keywords(masks, keywords)
    seam = _seam_keywords(keywords)
    if not seam:
        return found
    joined = F.concat_ws(" ", F.coalesce("description", F.lit("")), F.col("video_text"))
    return bound(
        F.array_union(found, keyword_hits(joined, seam)),
        lambda either: F.filter(keyword_names(keywords), lambda k: F.array_contains(either, k)),
    )


def creators(
    raw_channels: DataFrame,
    channels: DataFrame,
    playlist_items: DataFrame,
    videos: DataFrame,
    settings: Settings,
) -> DataFrame:
    """One record per discovered creator, in the CREATORS schema.

    A creator without a channel record, or with an invalid one, keeps its row with defaults and
    says why in ``enrich_error``.
    """
    keywords = settings.rules.niche_keywords
    uploads = recent_uploads(playlist_items, settings.enrichment)
    joined = with_channel_records(raw_channels, channel_facts(channels, keywords)).join(
        video_metrics(uploads, videos, keywords),
        F.col("uploads_playlist") == F.col("playlist_id"),
        "left",
    )
    video_error = F.concat(F.lit("invalid "), "video_invalid")
    return _record(
        joined.withColumn("enrich_error", F.coalesce("enrich_error", video_error)), keywords
    )


def with_channel_records(raw_channels: DataFrame, facts: DataFrame) -> DataFrame:
    """Discovered channels with their latest record, and why it cannot be used, if so."""
    records = latest_records(facts).withColumn("landed", F.lit(True))
    error = F.when(F.col("landed").isNull(), F.lit("no channel record")).otherwise(
        F.concat(F.lit("invalid "), "invalid_field")
    )
    return (
        raw_channels.join(records, "channel_id", "left")
        .withColumn("enrich_error", error)
        .drop("landed", "invalid_field")
    )


# Columns of a record that come from the channel or its videos as they are.
_MEASURED = (
    "followers", "avg_views", "engagement_rate", "email", "email_source", "instagram_url",
    "website", "country", "language",
)


def _record(joined: DataFrame, keywords: tuple[str, ...]) -> DataFrame:
    valid = F.col("enrich_error").isNull()
    no_text, no_list = F.lit(None).cast("string"), F.array().cast("array<string>")
    hits = present(F.array_join(public_keywords(keywords), ", "))
    themed = joined.withColumn("themes", F.when(valid, hits))
    values = {name: F.when(valid, F.col(name)) for name in _MEASURED} | {
        "id": F.col("channel_id"),
        "name": creator_name(),
        "platform": F.lit(PLATFORM),
        "profile_url": profile_url(F.col("channel_id")),
        "niche": F.col("themes"),
        "content_themes": F.col("themes"),
        "recent_titles": F.coalesce(F.when(valid, F.col("recent_titles")), no_list),
        "audience_age": no_text,
        "audience_gender": no_text,
        "audience_geo": no_text,
        "last_upload": F.when(valid, to_timestamp(F.col("published_at"))),
        "brand_fit_score": F.lit(None).cast("double"),
        "status": F.lit(UNFILTERED),
        "fail_reasons": no_list,
        "source": F.coalesce(present(F.col("source_keyword")), F.lit(DEFAULT_SOURCE)),
        "fetched_at": F.col("fetched_at"),
        "pos": F.col("pos"),
        "enrich_error": F.col("enrich_error"),
    }
    return themed.select(*[values[f.name].alias(f.name) for f in CREATORS.fields])


def creator_name() -> Column:
    """Name from the channel record, or the discovered title (or nothing) without one."""
    return F.when(F.col("enrich_error").isNull(), F.col("name")).otherwise(
        present(F.col("title"))
    )


def profile_url(channel_id: Column) -> Column:
    return F.concat(F.lit(PROFILE_URL_PREFIX), channel_id)


def spoken_language() -> Column:
    return F.coalesce(
        present(F.col("default_language")), present(F.col("default_audio_language"))
    )


def enrichment_summary(records: DataFrame) -> DataFrame:
    return records.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("enrich_error").isNull()).alias("enriched"),
        F.count_if(F.col("enrich_error") == "no channel record").alias("not_returned"),
        F.count_if(F.col("enrich_error").startswith("invalid")).alias("invalid"),
    )
