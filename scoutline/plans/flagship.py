"""The main plan: which creators pass, why the others fail, and who ranks first."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame

from scoutline.config import Angles, Discovery, DraftLimits, Rules, Settings
from scoutline.operators import enrich, score

# Thresholds that separate the rows of the test tables.
TEST_SETTINGS = Settings(
    discovery=Discovery(target=200, region_code=None, language="en"),
    rules=Rules(
        min_engagement_rate=0.005,
        max_upload_age_days=400,
        engagement_score_cap=0.02,
        niche_keywords=("red", "bolt", "gear"),
    ),
    angles=Angles(
        high_engagement_rate=0.010, mid_engagement_rate=0.006,
        high_reach_followers=50_000, high_reach_views=1_000,
    ),
    drafts=DraftLimits(email_words=(60, 200), dm_words=(15, 50)),
)
AS_OF = datetime(2001, 8, 1, 12, 0, 0, tzinfo=timezone.utc)


def evaluated(
    raw_channels: DataFrame,
    channels: DataFrame,
    playlist_items: DataFrame,
    videos: DataFrame,
    settings: Settings,
    as_of: datetime,
) -> DataFrame:
    """Enrich every discovered creator and judge it."""
    records = enrich.creators(raw_channels, channels, playlist_items, videos, settings)
    return score.evaluate(records, settings, as_of)
