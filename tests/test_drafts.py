import json
from datetime import datetime, timezone

import pytest

from scoutline.config import Angles, Brand, DraftLimits
from scoutline.operators import drafts
from scoutline.schemas import DRAFT_ATTEMPTS, MESSAGE_COLUMNS
from scoutline.sources import tables

LIMITS = DraftLimits()
AT = datetime(2026, 10, 1, tzinfo=timezone.utc)


def words(n):
    return " ".join(["word"] * n)


def response(email=60, dm=15, subject="Hello there"):
    return json.dumps({"subject": subject, "email": words(email), "dm": words(dm)})


def attempts(spark, *rows):
    data = [(c, n, r, None, None, None, None, AT) for c, n, r in rows]
    return spark.createDataFrame(data, DRAFT_ATTEMPTS)


def ready(spark, *ids):
    schema = "id string, name string, email string, collab_angle string, pos bigint, prompt string"
    return spark.createDataFrame([(i, f"N {i}", None, "UGC", n, f"write {i}") for n, i in enumerate(ids)], schema)


def test_angles(spark):
    rows = [(0.04, 1, None), (0.02, 90000, None), (0.01, 50000, None), (None, 1, 10000.0), (None, None, None)]
    df = spark.createDataFrame(rows, "engagement_rate double, followers bigint, avg_views double")
    got = [r[0] for r in df.select(drafts.collaboration_angle(Angles())).collect()]
    assert got == ["user-generated content", "affiliate partnership", "paid placement", "paid placement",
                   "product seeding"]


def test_prompt_is_filled_once(spark):
    df = spark.createDataFrame(
        [("PASS", "{niche}", None, "", ["a {name}", "b"], None, None, None), ("FAIL", "x", "", "", [], None, None, None)],
        "status string, name string, platform string, niche string, recent_titles array<string>, "
        "engagement_rate double, followers bigint, avg_views double",
    ).withColumn("content_themes", drafts.F.lit("t"))
    template = "{name}|{platform}|{niche}|{content_themes}|{recent_titles}|{brand_name}|{collab_angle}|{{x}}"
    rows = drafts.prompts(df, template, Angles(), Brand(name="B")).collect()
    assert [r["prompt"] for r in rows] == [
        "{niche}|Not Found|Not Found|t|a {name}; b|B|product seeding|{x}"]


@pytest.mark.parametrize(
    "raw, wanted",
    [
        ('{"subject": " a ", "email": "b\\n", "dm": "c"}', ("a", "b", "c")),
        ('  {"subject": "a"}\n', ("a", "", "")),
        ('{"subject": 1.5, "email": 3, "dm": null}', ("1.5", "3", "")),
        ('{"subject": "a", "subject": "b"}', ("b", "", "")),
        ('{"subject": "a"} thanks', ("", "", "")),
        ('{"subject": "a"} {}', ("", "", "")),
        ('{"subject": "a"}, {"subject": "b"}', ("", "", "")),
        ('{"subject": "a"}, "end": {}', ("", "", "")),
        ('{"subject": "a"}] [{}', ("", "", "")),
        ('{"subject": "a"}}', ("", "", "")),
        ("{'subject': 'a'}", ("", "", "")),
        ('{"subject": "a"', ("", "", "")),
        ('[{"subject": "a"}]', ("", "", "")),
        ("[1]", ("", "", "")), ("null", ("", "", "")), ("", ("", "", "")), ("text", ("", "", "")),
        ('{"subject": "a\nb"}', ("", "", "")),
    ],
)
def test_parse(evaluate, raw, wanted):
    assert tuple(evaluate(drafts.parse_response, [raw])[0]) == wanted


def test_limits(spark):
    df = attempts(
        spark, ("a", 1, response()), ("b", 1, response(90, 30, words(8))), ("c", 1, response(91, 31, words(9))),
        ("d", 1, response(59, 14, "")), ("f", 1, None),
        *[("e", n, response() if n == 4 else "{}") for n in (1, 2, 3, 4)],
    )
    rows = drafts.check_attempts(df, LIMITS).collect()
    assert sorted(r["attempt"] for r in rows if r["creator_id"] == "e") == [1, 2, 3]
    got = {r["creator_id"]: (r["valid"], r["problems"]) for r in rows if r["creator_id"] != "e"}
    assert got == {
        "a": (True, []), "b": (True, []), "c": (False, ["subject too long", "email length", "dm length"]),
        "d": (False, ["subject missing", "email length", "dm length"]),
        "f": (False, ["subject missing", "email length", "dm length"]),
    }


def test_first_valid_attempt_becomes_the_message(spark):
    df = attempts(
        spark, ("a", 2, response(subject="second")), ("a", 1, response(5)), ("a", 3, response(subject="third")),
        ("b", 1, "{}"), *[("c", n, response() if n == 4 else "{}") for n in (1, 2, 3, 4)],
    )
    found = drafts.first_valid(drafts.check_attempts(df, LIMITS))
    base = ready(spark, "a", "b", "c")
    rows = drafts.messages(base, found).collect()
    assert [(r["influencer_id"], r["subject"], r["approved"], r["message_status"]) for r in rows] == [
        ("a", "second", False, "PENDING_APPROVAL")]
    assert rows[0].asDict().keys() == {*MESSAGE_COLUMNS, "pos"}
    assert sorted(r["id"] for r in drafts.without_draft(base, found).collect()) == ["b", "c"]
    assert tuple(drafts.run_summary(base, found).first()) == (3, 1, 2, "write drafts")


def test_run_guard(spark, tmp_path):
    none = drafts.first_valid(drafts.check_attempts(attempts(spark, ("a", 1, "{}")), LIMITS))
    failed = drafts.run_summary(ready(spark, "a"), none)
    with pytest.raises(RuntimeError):
        tables.write_messages(drafts.messages(ready(spark, "a"), none), failed, str(tmp_path / "m"))
    assert not (tmp_path / "m").exists()
    empty = ready(spark, "a").limit(0)
    outcome = tables.write_messages(
        drafts.messages(empty, none), drafts.run_summary(empty, none), str(tmp_path / "m"))
    assert outcome == "write empty table"
    assert spark.read.parquet(str(tmp_path / "m")).columns == [*MESSAGE_COLUMNS, "pos"]


def test_retry_prompt_collects_all_feedback(spark):
    df = attempts(
        spark, ("a", 2, response(3, 2)), ("a", 1, response(7, 1)), ("b", 1, response()),
        ("c", 1, "{}"), ("c", 2, "{}"), ("c", 3, "{}"),
    )
    checked = drafts.check_attempts(df, LIMITS)
    rows = drafts.retry_prompts(ready(spark, "a", "b", "c"), checked, "{email_words}/{dm_words}", LIMITS).collect()
    assert [tuple(r) for r in rows] == [("a", 3, "write a\n7/1\n3/2")]


def failures(spark):
    rows = [
        ("ok", 1, "{}", None, None, None, None), ("rate", 1, None, 429, "RateLimitError", None, "0.25"),
        ("date", 2, None, 429, None, None, "Thu, 01 Oct 2026 00:00:30 GMT"), ("past", 1, None, 429, None, None, "-5"),
        ("bare", 2, None, 429, None, None, None), ("server", 2, None, 500, "InternalServerError", None, "9"),
        ("slow", 1, None, None, "APITimeoutError", None, None), ("last", 3, None, 500, None, None, None),
        ("row", 1, None, 400, "BadRequestError", "json_validate_failed", None),
        ("bad", 1, None, 400, None, "model", None), ("key", 1, None, 401, "AuthenticationError", None, None),
        ("paid", 1, None, 402, None, None, None), ("odd", 1, None, 418, None, None, None),
        ("junk", 1, None, 429, None, None, "later"),
        ("zone", 1, None, 429, None, None, "1 Oct 2026 02:00:10 +0200"),
        ("short year", 1, None, 429, None, None, "Thursday, 01-Oct-26 00:00:30 GMT"),
        ("endless", 1, None, 429, None, None, "inf"), ("huge", 1, None, 429, None, None, "1e30"),
        ("nothing", 1, None, 429, None, None, "nan"),
    ]
    return spark.createDataFrame([(*r, AT) for r in rows], DRAFT_ATTEMPTS)


def test_failure_classes(spark):
    got = {r["failure"]: (r["attempts"], r["abort"]) for r in drafts.failure_classes(failures(spark)).collect()}
    assert got == {"transient": (13, False), "row": (1, False), "fatal": (3, True), "other": (1, False)}


def test_retry_schedule(spark):
    rows = drafts.retry_schedule(failures(spark), LIMITS).collect()
    assert {r["creator_id"]: r["delay_seconds"] for r in rows} == {
        "rate": 0.25, "date": 30.0, "past": 0.0, "bare": 1.0, "server": 1.0, "slow": 1.0, "last": 1.0, "row": 1.0, "junk": 1.0,
        "zone": 10.0, "short year": 30.0, "endless": 1.0, "huge": 1.0, "nothing": 1.0}
    quarter = next(r for r in rows if r["creator_id"] == "rate")
    assert quarter["next_try_at"].microsecond == 250_000


def test_failed_calls_are_no_drafts(spark):
    """Three failed calls and then an answer: the answer is the first draft. A text that came with an
    error is no draft either."""
    rows = [
        ("a", 1, None, 429), ("a", 2, None, 500), ("a", 3, None, 429), ("a", 4, response(), None),
        ("b", 1, response(), 401), ("b", 2, response(3, 2), None), ("b", 3, None, 500),
    ]
    df = spark.createDataFrame([(c, n, r, s, None, None, None, AT) for c, n, r, s in rows], DRAFT_ATTEMPTS)
    checked = drafts.check_attempts(df, LIMITS)
    assert [(r["creator_id"], r["attempt"]) for r in drafts.first_valid(checked).collect()] == [("a", 4)]
    again = drafts.retry_prompts(ready(spark, "a", "b"), checked, "{email_words}/{dm_words}", LIMITS).collect()
    assert [tuple(r) for r in again] == [("b", 2, "write b\n3/2")]
    waits = {(r["creator_id"], r["attempt"]): r["delay_seconds"] for r in drafts.retry_schedule(df, LIMITS).collect()}
    assert waits == {("a", 1): 1.0, ("a", 2): 2.0, ("b", 3): 1.0}


def test_formats_in_templates_are_refused():
    for template in ("{name!r}", "{name:>9}"):
        with pytest.raises(ValueError, match="not supported"):
            drafts.render(template, {})
