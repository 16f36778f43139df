"""From landed responses to the contact log, stage by stage, twice."""

import json
from dataclasses import replace
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from scoutline.config import Discovery, Rules, Settings
from scoutline.plans import stages
from scoutline.schemas import CONTACT_LOG, DM_QUEUE, DRAFT_ATTEMPTS
from scoutline.sources import tables

AS_OF = datetime(2026, 10, 1, tzinfo=timezone.utc)
SETTINGS = Settings(
    discovery=Discovery(keywords=("makeup", "hair"), target=500),
    rules=Rules(niche_keywords=("makeup", "hair"), min_keyword_hits=1),
)


def land(base, name, records):
    folder = base / "landing" / name
    folder.mkdir(parents=True)
    (folder / "part.json").write_text("\n".join(json.dumps(r) for r in records), encoding="utf-8")


def landed(base):
    land(base, "search_pages", [
        {"keyword_idx": 0, "keyword": "makeup", "type_idx": 0, "result_type": "channel", "page_idx": 0,
         "fetched_at": "2026-09-30T00:00:00Z",
         "response": {"items": [{"id": {"channelId": f"UC{i}"}, "snippet": {"title": f"T{i}"}} for i in range(4)]}},
        {"keyword_idx": 1, "keyword": "hair", "type_idx": 1, "result_type": "video", "page_idx": 0,
         "fetched_at": "2026-09-30T00:00:00Z",
         "response": {"items": [{"snippet": {"channelId": "UC1", "channelTitle": "again"}}]}},
    ])
    land(base, "channels", [
        {"resp_pos": 0, "id": f"UC{i}", "snippet": {
            "title": f"Name {i}", "description": "ask both@desk.test" if i < 2 else "makeup", "country": "IN"},
         "statistics": {"subscriberCount": "7300" if i < 3 else "12"},
         "contentDetails": {"relatedPlaylists": {"uploads": f"UU{i}"}}} for i in range(4)
    ])
    land(base, "playlist_items", [
        {"playlist_id": f"UU{i}", "items": [{"contentDetails": {"videoId": f"V{i}"}}]} for i in range(4)])
    land(base, "videos", [
        {"resp_idx": 0, "id": f"V{i}", "playlist_id": f"UU{i}", "snippet": {"title": "makeup and hair", "publishedAt": "2026-09-20T00:00:00Z"},
         "statistics": {"viewCount": "800", "likeCount": str(36 - 8 * i), "commentCount": "4"}} for i in range(4)])


def draft(words=60):
    return json.dumps({"subject": "Hello", "email": "w " * words, "dm": "w " * 15})


def test_all_stages(spark, tmp_path):
    base = str(tmp_path)
    landed(tmp_path)
    assert stages.find(spark, base, SETTINGS).count() == 4
    assert stages.enriched(spark, base, SETTINGS).count() == 4
    for _ in range(2):  # a repeated stage gives the same tables
        ranked = stages.judged(spark, base, SETTINGS, AS_OF).orderBy("rank").collect()
    assert [(r["rank"], r["id"], r["status"]) for r in ranked] == [
        (1, "UC0", "PASS"), (2, "UC1", "PASS"), (3, "UC2", "PASS_NO_EMAIL")]
    asked = {r["id"]: r["prompt"] for r in stages.prompts(spark, base, SETTINGS, "{name}: {collab_angle}").collect()}
    assert asked["UC0"] == "Name 0: user-generated content"

    attempts = [("UC0", 1, draft(3)), ("UC0", 2, draft()), ("UC1", 1, draft()), ("UC2", 1, draft(1))]
    rows = [(c, n, r, None, None, None, None, AS_OF) for c, n, r in attempts]
    spark.createDataFrame(rows, DRAFT_ATTEMPTS).write.parquet(f"{base}/draft_attempts")
    messages = stages.drafted(spark, base, SETTINGS)
    assert sorted(r["influencer_id"] for r in messages.collect()) == ["UC0", "UC1"]

    assert stages.planned(spark, base, "r0").count() == 0  # nothing is approved yet
    stages.approvable(messages).select("draft_key").write.parquet(f"{base}/approvals")
    runs = []
    for n, live in ((1, False), (2, False), (3, True), (3, True)):  # the last is the same run again
        plan = stages.planned(spark, base, f"r{n}", live)
        told = None
        if live:  # the outcomes come after the plan, for the rows that were sent
            told = plan.where(F.col("status") == "PLANNED").select("pos", F.lit(None).cast("string").alias("error"))
        for _ in range(2):  # settling twice gives the same log
            rows = stages.settled(spark, base, f"r{n}", AS_OF.replace(hour=n), told).collect()
        runs.append({r["influencer_id"]: r["status"] for r in rows})
    assert runs == [
        {"UC0": "SIMULATED", "UC1": "SKIPPED_DUPLICATE"},
        {"UC0": "SKIPPED_DUPLICATE", "UC1": "SKIPPED_DUPLICATE"},
        {"UC0": "SENT_TO_TEST_INBOX", "UC1": "SKIPPED_DUPLICATE"},
        {"UC0": "SENT_TO_TEST_INBOX", "UC1": "SKIPPED_DUPLICATE"},
    ]
    # A run that comes after knows the address as sent.
    assert {r["status"] for r in stages.planned(spark, base, "r4", live=True).collect()} == {"SKIPPED_DUPLICATE"}
    assert tables.read_table(spark, f"{base}/contact_log", CONTACT_LOG).count() == 6
    assert tables.read_table(spark, f"{base}/dm_queue", DM_QUEUE).count() == 2


def test_fatal_attempt_stops_the_stage(spark, tmp_path):
    base = str(tmp_path)
    rows = [("UC0", 1, None, 401, "AuthenticationError", None, None, AS_OF)]
    spark.createDataFrame(rows, DRAFT_ATTEMPTS).write.parquet(f"{base}/draft_attempts")
    with pytest.raises(RuntimeError, match="fatal"):
        stages.drafted(spark, base, SETTINGS)
    assert not (tmp_path / "messages").exists()


def test_target_is_a_setting(spark, tmp_path):
    landed(tmp_path)
    whole = replace(SETTINGS, discovery=replace(SETTINGS.discovery, target=None))
    assert Discovery().target is None
    assert stages.find(spark, str(tmp_path), whole).count() == 4
    small = replace(SETTINGS, discovery=replace(SETTINGS.discovery, target=1))
    assert stages.find(spark, str(tmp_path), small).count() == 4  # the page is kept whole
