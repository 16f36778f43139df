"""Explicit table schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, WHOLE, DECIMAL = T.StringType(), T.LongType(), T.DoubleType()
SMALL, FLAG, TIME = T.IntegerType(), T.BooleanType(), T.TimestampType()
TEXTS = T.ArrayType(TEXT)


def table_schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


HIT_ITEM = table_schema(channel_id=TEXT, snippet_channel_id=TEXT, title=TEXT, channel_title=TEXT)

SEARCH_PAGES = table_schema(
    keyword_idx=SMALL, keyword=TEXT, type_idx=SMALL, result_type=TEXT, page_idx=SMALL,
    status=TEXT, fetched_at=TIME, items=T.ArrayType(HIT_ITEM), next_page_token=TEXT,
)
RAW_CHANNELS = table_schema(
    channel_id=TEXT, title=TEXT, source_keyword=TEXT, fetched_at=TIME, pos=WHOLE
)
CHANNELS = table_schema(
    channel_id=TEXT, resp_pos=WHOLE, title=TEXT, description=TEXT, country=TEXT,
    default_language=TEXT, default_audio_language=TEXT, subscriber_count=TEXT,
    uploads_playlist=TEXT, invalid_field=TEXT, fetched_at=TIME,
)
PLAYLIST_ITEMS = table_schema(playlist_id=TEXT, item_idx=WHOLE, video_id=TEXT, fetched_at=TIME)
# A video is landed for a playlist: the same video asked for by two creators is two records.
VIDEOS = table_schema(
    playlist_id=TEXT, video_id=TEXT, resp_idx=WHOLE, title=TEXT, description=TEXT, tags=TEXTS,
    published_at=TEXT, view_count=TEXT, like_count=TEXT, comment_count=TEXT, invalid_field=TEXT,
    fetched_at=TIME,
)
# The 25 fields of a creator record, in order, then the two columns that only we keep.
CREATORS = table_schema(
    id=TEXT, name=TEXT, platform=TEXT, profile_url=TEXT, followers=WHOLE, avg_views=DECIMAL,
    engagement_rate=DECIMAL, niche=TEXT, content_themes=TEXT, recent_titles=TEXTS, email=TEXT,
    email_source=TEXT, instagram_url=TEXT, website=TEXT, audience_age=TEXT, audience_gender=TEXT,
    audience_geo=TEXT, country=TEXT, language=TEXT, last_upload=TIME, brand_fit_score=DECIMAL,
    status=TEXT, fail_reasons=TEXTS, source=TEXT, fetched_at=TIME,
    pos=WHOLE, enrich_error=TEXT,
)
DRAFT_ATTEMPTS = table_schema(
    creator_id=TEXT, attempt=SMALL, response=TEXT, status_code=SMALL, error_type=TEXT,
    error_message=TEXT, retry_after=TEXT, attempted_at=TIME,
)
MESSAGES = table_schema(
    influencer_id=TEXT, influencer=TEXT, email=TEXT, subject=TEXT, email_message=TEXT, dm=TEXT,
    collab_angle=TEXT, message_status=TEXT, approved=FLAG, pos=WHOLE,
)
CONTACT_LOG = table_schema(
    influencer_id=TEXT, influencer=TEXT, email=TEXT, message_generated=TEXT, email_subject=TEXT,
    sent=FLAG, date=TIME, status=TEXT, error=TEXT,
)
DM_QUEUE = table_schema(influencer_id=TEXT, influencer=TEXT, dm=TEXT, status=TEXT)

# Column order of the flat files.
RAW_CHANNEL_COLUMNS = ("channel_id", "title", "source_keyword", "fetched_at")
MESSAGE_COLUMNS = tuple(MESSAGES.fieldNames()[:-1])
