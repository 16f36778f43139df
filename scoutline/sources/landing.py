"""Landed API responses: JSON lines in, normalised tables out.

Nested parts are read as VARIANT where an absent field (takes its default) and an explicit null
or wrong type (makes the record invalid) must be told apart. A line that is no whole JSON value is
torn: among search pages it counts as a failed page, elsewhere it holds no record, and
:func:`torn_lines` counts it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoutline.functions.text import present
from scoutline.operators.enrich import listed_videos
from scoutline.session import stored

_PAGES = (
    "keyword_idx int, keyword string, type_idx int, result_type string, page_idx int, "
    "status string, fetched_at timestamp, response struct<items array<struct<"
    "id struct<channelId string, videoId string>, "
    "snippet struct<title string, channelId string, channelTitle string>>>, "
    "nextPageToken string>, _corrupt_record string"
)
_CHANNELS = (
    "resp_pos bigint, id string, fetched_at timestamp, snippet variant, "
    "statistics variant, contentDetails variant"
)
_PLAYLISTS = (
    "playlist_id string, fetched_at timestamp, page_idx int, status string, nextPageToken string, "
    "items array<struct<contentDetails struct<videoId string>>>"
)
_VIDEOS = (
    "resp_idx bigint, id string, playlist_id string, fetched_at timestamp, snippet variant, "
    "statistics variant"
)


def search_pages(spark: SparkSession, path: str) -> DataFrame:
    """Search result pages, one JSON object per page."""
    items = F.transform(
        F.coalesce("response.items", F.expr("array()")),
        lambda i: F.struct(
            i["id"]["channelId"].alias("channel_id"),
            i["snippet"]["channelId"].alias("snippet_channel_id"),
            i["snippet"]["title"].alias("title"),
            i["snippet"]["channelTitle"].alias("channel_title"),
        ),
    )
    return (
        spark.read.schema(_PAGES)
        .json(path)
        .select(
            "keyword_idx", "keyword", "type_idx", "result_type", "page_idx",
            F.when(F.col("_corrupt_record").isNotNull(), "error")
            .otherwise(F.coalesce("status", F.lit("ok")))
            .alias("status"),
            "fetched_at",
            items.alias("items"),
            F.col("response.nextPageToken").alias("next_page_token"),
        )
    )


def channels(spark: SparkSession, path: str) -> DataFrame:
    """Channel records; ``invalid_field`` names the first field that breaks the record."""
    return (
        spark.read.schema(_CHANNELS)
        .json(path)
        .select(
            F.col("id").alias("channel_id"),
            "resp_pos",
            _text("title").alias("title"),
            _text("description").alias("description"),
            _text("country").alias("country"),
            _text("defaultLanguage").alias("default_language"),
            _text("defaultAudioLanguage").alias("default_audio_language"),
            _text("subscriberCount", "statistics").alias("subscriber_count"),
            F.try_variant_get("contentDetails", "$.relatedPlaylists.uploads", "string").alias("uploads_playlist"),
            F.coalesce(
                _no_object("snippet"), _no_object("statistics"), _broken("title", "name"), _broken("description"), _broken("country"),
                _broken("defaultLanguage", "language", null_ok=True),
                F.when(
                    present(_text("defaultLanguage")).isNull(),
                    _broken("defaultAudioLanguage", "language", null_ok=True),
                ),
                _no_object("contentDetails"),
                _no_object("contentDetails", "relatedPlaylists"),
                _broken("relatedPlaylists.uploads", "uploads", null_ok=True, part="contentDetails"),
            ).alias("invalid_field"),
            "fetched_at",
        )
    )


def playlist_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of uploads playlists, one JSON object per page.

    ``fetched_at`` is the time at which the listing was begun, the same on all its pages. A record without
    ``page_idx`` is the first page.
    """
    videos = F.transform(
        F.coalesce("items", F.expr("array()")), lambda i: i["contentDetails"]["videoId"]
    )
    return (
        spark.read.schema(_PLAYLISTS)
        .json(path)
        .select(
            "playlist_id",
            "fetched_at",
            F.coalesce("page_idx", F.lit(0)).alias("page_idx"),
            F.coalesce("status", F.lit("ok")).alias("status"),
            F.col("nextPageToken").alias("next_page_token"),
            videos.alias("videos"),
        )
    )


def playlist_items(spark: SparkSession, path: str) -> DataFrame:
    """Uploads playlists, one row per entry of their readable pages. The landed pages are read once and stored."""
    return listed_videos(stored(playlist_pages(spark, path), "playlist-pages"))


def videos(spark: SparkSession, path: str) -> DataFrame:
    """Video records with counts as text, each under the playlist it was asked for. ``resp_idx`` counts over all
    requests for that playlist."""
    # Each part is taken apart once; an object gives a struct, whatever its fields are, and all else gives NULL.
    snippet = F.try_variant_get("snippet", "$", "struct<title variant, description variant, tags variant, publishedAt string>")
    counts = F.try_variant_get("statistics", "$", "struct<viewCount string, likeCount string, commentCount string>")
    title, description, tags = (F.col(f"_snippet.{name}") for name in ("title", "description", "tags"))
    return (
        spark.read.schema(_VIDEOS)
        .json(path)
        .select(
            "playlist_id", F.col("id").alias("video_id"), "resp_idx", "fetched_at",
            snippet.alias("_snippet"), F.col("snippet").isNotNull().alias("_has_snippet"),
            counts.alias("_counts"), F.col("statistics").isNotNull().alias("_has_counts"),
        )
        .select(
            "playlist_id",
            "video_id",
            "resp_idx",
            F.try_variant_get(title, "$", "string").alias("title"),
            F.try_variant_get(description, "$", "string").alias("description"),
            F.try_variant_get(tags, "$", "array<string>").alias("tags"),
            F.col("_snippet.publishedAt").alias("published_at"),
            F.col("_counts.viewCount").alias("view_count"),
            F.col("_counts.likeCount").alias("like_count"),
            F.col("_counts.commentCount").alias("comment_count"),
            F.coalesce(
                F.when(F.col("_has_snippet") & F.col("_snippet").isNull(), F.lit("snippet")),
                F.when(F.col("_has_counts") & F.col("_counts").isNull(), F.lit("statistics")),
                _other_than(title, "title", "STRING"),
                _other_than(description, "description", "STRING"),
                _other_than(tags, "tags", "ARRAY<STRING>", "ARRAY<VOID>"),
            ).alias("invalid_field"),
            "fetched_at",
        )
    )


def torn_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row: lines that are no whole JSON value, and all lines."""
    lines = spark.read.text(path)
    return lines.agg(
        F.count_if(F.try_parse_json("value").isNull()).alias("torn"), F.count("*").alias("lines")
    )


def _text(field: str, part: str = "snippet") -> Column:
    return F.try_variant_get(part, f"$.{field}", "string")


def _no_object(part: str, inside: str | None = None) -> Column:
    """Name of a part, or of a part inside it, that is present but an explicit null or no object."""
    value = F.try_variant_get(part, f"$.{inside}", "variant") if inside else F.col(part)
    wrong = ~F.startswith(F.schema_of_variant(value), F.lit("OBJECT"))
    return F.when(F.coalesce(wrong, F.lit(False)), F.lit(inside or part))


def _other_than(value: Column, name: str, *kinds: str) -> Column:
    """Name of a field that is present but of none of these kinds."""
    return F.when(value.isNotNull() & ~F.schema_of_variant(value).isin(*kinds), F.lit(name))


def _broken(field: str, name: str | None = None, *, null_ok: bool = False, part: str = "snippet") -> Column:
    """Name of a field that is present but not text."""
    value = F.try_variant_get(part, f"$.{field}", "variant")
    return _other_than(value, name or field, *(["STRING", "VOID"] if null_ok else ["STRING"]))
