"""Plans that must hold when one key owns a third of the rows."""

import pytest
from pyspark.sql import functions as F

from scoutline.config import Enrichment
from scoutline.operators import contact, discover, enrich, score
from scoutline.plans import catalog

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def strict_skew(spark):
    """Small thresholds, so that a test-size hot key counts as skew; no broadcast."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key in conf:
        spark.conf.unset(key)


def test_a_video_landed_very_often_is_combined_before_the_shuffle(spark, strict_skew):
    """A third of all landed records are one video of one playlist, and one video is in many playlists."""
    n = 90_000
    number = F.col("id").cast("string")
    uploads = spark.range(n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit("P")).otherwise(number).alias("playlist_id"), F.lit("hot").alias("video_id")
    )
    videos = uploads.select(
        "*", F.lit("t").alias("title"), F.timestamp_seconds(F.monotonically_increasing_id() % 1000).alias("fetched_at")
    )
    joined = enrich.uploaded_videos(uploads, videos)
    assert joined.count() == joined.select("playlist_id").distinct().count() == n - n // 3 + 1
    assert plan_of(joined).count("max_by") >= 2  # partial and final


def test_no_row_level_window_without_partition(spark):
    """Windows over all rows in one task may only see block totals."""
    hits = spark.createDataFrame(
        [(0, "k", 0, "channel", 0, 0, "UC", "t", None)],
        "keyword_idx int, keyword string, type_idx int, result_type string, page_idx int, "
        "item_idx int, channel_id string, title string, fetched_at timestamp",
    )
    found = discover.first_seen(hits)
    assert "Window" not in plan_of(found)
    capped = discover.cap_pages(found, 5)._jdf.queryExecution().optimizedPlan()
    text = capped.toString()
    for line in text.splitlines():
        if "Window [" in line:
            assert "sum(n" in line


def test_hot_score_is_ranked_in_blocks(spark):
    n = 30_000
    rows = spark.range(n).select(
        F.col("id").cast("string").alias("id"), (F.col("id") * 7).alias("pos"),
        F.lit("PASS").alias("status"),
        F.when(F.col("id") % 3 == 0, 50.0).otherwise((F.col("id") % 100) / 2).alias("brand_fit_score"),
    )
    ranked = score.shortlist(rows).agg(
        F.min("rank"), F.max("rank"), F.countDistinct("rank"), F.count("*")
    ).first()
    assert tuple(ranked) == (1, n, n, n)


def test_hot_playlist_leaves_the_scan_with_n_rows_per_task(spark):
    items = spark.range(100_000, numPartitions=4).select(
        F.floor(F.col("id") / 1_000_000).cast("string").alias("playlist_id"), F.col("id").alias("item_idx"),
        F.col("id").cast("string").alias("video_id"), F.lit("2026-10-01").cast("timestamp").alias("fetched_at"),
    )
    kept = enrich.recent_uploads(items, Enrichment(recent_videos=10))
    assert [r["item_idx"] for r in kept.orderBy("item_idx").collect()] == list(range(10))
    text = plan_of(kept)
    assert text.count("WindowGroupLimit") == 2, text
    assert "Partial" in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan_of(catalog.queries()["quota_daily"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text
    text = plan_of(catalog.queries()["page_cap"](spark, SF))
    assert "value" not in text.split("ReadSchema:")[1].splitlines()[0]


def test_known_contacts_combine_before_the_shuffle(spark):
    log = spark.range(10).select(F.lit("a@b.co").alias("email"), F.lit("FAILED").alias("status"))
    text = plan_of(contact.known_contacts(log, live=True))
    assert text.count("HashAggregate") == 2
