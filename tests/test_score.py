from dataclasses import replace
from datetime import datetime, timedelta, timezone

import pytest

from scoutline.config import Discovery, Rules, Settings
from scoutline.fixed import REASONS
from scoutline.operators import score
from scoutline.schemas import CREATORS

AS_OF = datetime(2026, 10, 1, 12, tzinfo=timezone.utc)
SETTINGS = Settings(rules=Rules(niche_keywords=("origami", "pottery", "weaving")))
GOOD = dict(
    id="a", followers=64000, engagement_rate=0.017, niche="pottery", content_themes="slow craft",
    recent_titles=["Weaving a basket"], last_upload=AS_OF - timedelta(days=40), country="IN", language="en", pos=0,
)


def judge(spark, *rows, settings=SETTINGS):
    data = [tuple(r.get(f) for f in CREATORS.fieldNames()) for r in rows]
    out = score.evaluate(spark.createDataFrame(data, CREATORS), settings, AS_OF)
    assert set(out.columns) == set(CREATORS.fieldNames())
    return out


def reasons(spark, **changes):
    row = judge(spark, {**GOOD, **changes}).first()
    return [k for k, t in REASONS.items() if t in row["fail_reasons"]]


def test_passes_without_email(spark):
    row = judge(spark, GOOD).first()
    assert row["status"] == "PASS_NO_EMAIL" and row["fail_reasons"] == []
    assert 0 <= row["brand_fit_score"] <= 100


def test_poor_row_keeps_ordered_reasons(spark):
    row = judge(spark, {"id": "b", "followers": 4999, "engagement_rate": 0.0099, "niche": "origami"}).first()
    assert row["status"] == "FAIL"
    wanted = ("followers", "engagement", "niche", "upload_date")
    assert row["fail_reasons"] == [REASONS[k] for k in wanted]


@pytest.mark.parametrize(
    "changes, broken",
    [
        ({"followers": 5000}, []), ({"followers": 4999}, ["followers"]), ({"followers": 100000}, []),
        ({"followers": 100001}, ["followers"]), ({"engagement_rate": 0.01}, []),
        ({"engagement_rate": float("nan")}, ["engagement"]), ({"engagement_rate": None}, ["engagement"]),
        ({"last_upload": AS_OF - timedelta(days=91) + timedelta(seconds=1)}, []),
        ({"last_upload": AS_OF - timedelta(days=91)}, ["activity"]),
        ({"last_upload": None}, ["upload_date"]), ({"country": None, "language": ""}, []),
        ({"country": "in"}, ["country"]), ({"language": "en-US"}, ["language"]),
        ({"niche": "potterypottery", "recent_titles": []}, ["niche"]),
        ({"niche": None, "content_themes": None, "recent_titles": ["ORIGAMI", "on weaving"]}, []),
    ],
)
def test_each_rule_at_its_edge(spark, changes, broken):
    assert reasons(spark, **changes) == broken


def test_locale_rules_are_optional(spark):
    free = replace(SETTINGS, discovery=Discovery(region_code=None, language=None))
    row = judge(spark, {**GOOD, "country": "US", "language": "fr"}, settings=free).first()
    assert row["status"] == "PASS_NO_EMAIL"


def test_blank_email_is_missing(spark):
    rows = judge(spark, {**GOOD, "email": ""}, {**GOOD, "email": "a@b.co", "pos": 1}).orderBy("pos").collect()
    assert [r["status"] for r in rows] == ["PASS_NO_EMAIL", "PASS"]


def test_score_parts(spark):
    half = {**GOOD, "engagement_rate": 0.02, "last_upload": AS_OF - timedelta(days=18)}
    assert judge(spark, half).first()["brand_fit_score"] == 75.0  # 20 + 14 + 25 + 16
    nothing = {"id": "b", "recent_titles": []}
    assert judge(spark, nothing).first()["brand_fit_score"] == 0.0
    rich = {**GOOD, "engagement_rate": 9.0, "last_upload": AS_OF}
    assert judge(spark, rich).first()["brand_fit_score"] == 100.0


def test_shortlist_rank_with_one_common_score(spark, monkeypatch):
    monkeypatch.setattr(score, "RANK_BLOCK", 8)
    rows = [
        {**GOOD, "id": str(i), "pos": i * 3, "engagement_rate": 0.04 if i % 7 == 0 else 0.03,
         "followers": 1 if i % 11 == 0 else 20000}
        for i in range(100)
    ]
    judged = judge(spark, *rows).cache()
    ranked = score.shortlist(judged).collect()
    kept = [r for r in judged.collect() if r["status"] != "FAIL"]
    wanted = sorted(kept, key=lambda r: (-r["brand_fit_score"], r["pos"]))
    assert [r["id"] for r in ranked] == [r["id"] for r in wanted]
    assert [r["rank"] for r in ranked] == list(range(1, len(wanted) + 1))
    assert {r["status"]: r["creators"] for r in score.status_counts(judged).collect()}["FAIL"] == 10
    assert {r["reason"]: r["creators"] for r in score.reason_histogram(judged).collect()} == {
        REASONS["followers"]: 10}
    judged.unpersist()
