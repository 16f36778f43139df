from datetime import datetime

from scoutline.config import Brand, DraftLimits
from scoutline.operators import quality
from scoutline.schemas import CREATORS, MESSAGES, CONTACT_LOG, RAW_CHANNELS

AT = datetime(2026, 10, 1)


def creators(spark, *rows):
    base = dict(source="s", fetched_at=AT, status="PASS", fail_reasons=[])
    data = [tuple({**base, **r}.get(f) for f in CREATORS.fieldNames()) for r in rows]
    return spark.createDataFrame(data, CREATORS)


def failed(df):
    return {r["check_name"]: (r["failed_rows"], r["total_rows"], r["ok"]) for r in df.collect()}


def test_record_checks(spark):
    raw = spark.createDataFrame([(f"UC{i}", "t", "k", AT, i) for i in range(90)], RAW_CHANNELS)
    rows = [dict(id="a"), dict(id="b", source=""), dict(id="c", fetched_at=None),
            dict(id="d", status="FAIL"), dict(id="e", status="FAIL", fail_reasons=["x"]),
            dict(id="f", status="UNFILTERED")]
    assert failed(quality.record_checks(raw, creators(spark, *rows))) == {
        "enough raw records": (0, 90, True), "enough records": (44, 6, False),
        "source and time present": (2, 6, False), "status with reason": (2, 6, False)}


def test_message_checks(spark):
    def message(pos, subject="s", body=60, dm="w " * 15):
        return (str(pos), "n", None, subject, "w " * body, dm, "a", "PENDING_APPROVAL", False, pos)

    df = spark.createDataFrame(
        [message(0), message(1, subject=None), message(2, body=91), message(3, dm="YOUR_BRAND " * 15)], MESSAGES)
    assert failed(quality.message_checks(df, DraftLimits(), Brand())) == {
        "messages within word limits": (2, 4, False), "no placeholder in messages": (1, 4, False)}


def test_log_email_and_completeness(spark):
    rows = [(None, None, e, None, None, True, AT, s, "") for e, s in
            [("a@b.co", "SENT_TO_TEST_INBOX"), (" A@b.co", "SENT_TO_TEST_INBOX"), ("a@b.co", "FAILED"),
             ("c@b.co", "SENT_TO_TEST_INBOX")]]
    log = spark.createDataFrame(rows, CONTACT_LOG)
    people = creators(spark, dict(id="a", email="x@y.co"), dict(id="b", email="made@up.co"), dict(id="c"))
    channels = spark.createDataFrame(
        [("a", "write X@Y.co"), ("b", "nothing"), ("d", "")], "channel_id string, description string")
    report = quality.quality_report(
        quality.log_checks(log), quality.email_checks(people, channels),
        quality.completeness_check(people, channels, "id", "channel_id", "no creator lost"),
    )
    assert failed(report) == {
        "no duplicate send": (1, 2, False), "no invented address": (1, 2, False), "no creator lost": (2, 4, False)}


def test_empty_tables_are_fine(spark):
    log = spark.createDataFrame([], CONTACT_LOG)
    assert failed(quality.log_checks(log)) == {"no duplicate send": (0, 0, True)}
