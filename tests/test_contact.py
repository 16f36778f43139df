import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from scoutline.operators import contact
from scoutline.schemas import DM_QUEUE, MESSAGES, CONTACT_LOG
from scoutline.sources import tables

AT = datetime(2026, 10, 1, tzinfo=timezone.utc)


def message(pos, email="creator@example.org", **changes):
    base = dict(
        influencer_id=f"I{pos}", influencer=f"N{pos}", email=email, subject="s", email_message="m", dm=" hi ",
        collab_angle="a", message_status="PENDING_APPROVAL", approved=True, pos=pos,
    )
    base.update(changes)
    return tuple(base[f] for f in MESSAGES.fieldNames())


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), MESSAGES)


def log(spark, *pairs):
    data = [(None, None, e, None, None, False, AT, s, "") for e, s in pairs]
    return spark.createDataFrame(data, CONTACT_LOG)


def statuses(df):
    return {r["pos"]: r["status"] for r in df.collect()}


def test_dry_live_sequence(spark, tmp_path):
    path, sent = str(tmp_path / "log"), []
    messages = batch(spark, message(0))
    for live in (False, False, True, True):
        plan = contact.plan_contacts(messages, tables.read_optional(spark, path, CONTACT_LOG), live)
        told = plan.where(F.col("status") == "PLANNED").select("pos", F.lit("").alias("error"))
        settled = contact.merge_outcomes(plan, told)
        tables.append_log(settled, AT, path)
        sent.append(statuses(settled)[0])
    assert sent == ["SIMULATED", "SKIPPED_DUPLICATE", "SENT_TO_TEST_INBOX", "SKIPPED_DUPLICATE"]
    rows = tables.read_table(spark, path, CONTACT_LOG).collect()
    assert len(rows) == 4 and sum(r["sent"] for r in rows) == 1


def test_only_approved_valid_messages_count(spark):
    rows = [
        message(0, approved=False), message(1, message_status="DRAFT"), message(2, email=None),
        message(3, email="Not Found"), message(4, email="a@example.com"), message(5, email=" A@b.co "),
        message(6, email="a@B.co"),
    ]
    assert statuses(contact.plan_contacts(batch(spark, *rows), log(spark))) == {
        5: "SIMULATED", 6: "SKIPPED_DUPLICATE"}


@pytest.mark.parametrize("live, wanted", [(False, [True] * 4), (True, [False, False, True, True])])
def test_what_the_log_blocks(spark, live, wanted):
    kinds = ("SIMULATED", "SKIPPED_DUPLICATE", "SENT_TO_TEST_INBOX", "FAILED")
    rows = [message(i, email=f"u{i}@b.co") for i in range(4)]
    known = log(spark, *[(f" U{i}@B.co", s) for i, s in enumerate(kinds)], (None, "FAILED"), ("", "FAILED"))
    got = statuses(contact.plan_contacts(batch(spark, *rows), known, live))
    assert [got[i] == "SKIPPED_DUPLICATE" for i in range(4)] == wanted


def test_plan_equals_loop_with_a_hot_address(spark):
    rng = random.Random(11)
    rows = [
        message(i, email="hot@b.co" if rng.random() < 0.4 else f"u{rng.randint(0, 60)}@b.co",
                approved=rng.random() < 0.8)
        for i in range(400)
    ]
    old = [(f"u{i}@b.co", "FAILED") for i in range(0, 60, 9)]
    known, wanted = {e for e, _ in old}, {}
    for row in rows:
        fields = dict(zip(MESSAGES.fieldNames(), row))
        if fields["approved"]:
            wanted[fields["pos"]] = "SKIPPED_DUPLICATE" if fields["email"] in known else "SIMULATED"
            known.add(fields["email"])
    shuffled = batch(spark, *rng.sample(rows, len(rows))).repartition(7)
    assert statuses(contact.plan_contacts(shuffled, log(spark, *old))) == wanted


def test_no_window_gathers_an_address(spark):
    plan = contact.plan_contacts(batch(spark, message(0)), log(spark))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in text and "collect_list" not in text


def test_outcomes_touch_planned_rows_only(spark):
    rows = [message(0, email="a@b.co"), message(1, email="a@b.co"), message(2, email="c@b.co"),
            message(3, email="d@b.co")]
    plan = contact.plan_contacts(batch(spark, *rows), log(spark), live=True)
    told = spark.createDataFrame([(0, None), (1, "x"), (2, "mailbox full")], "pos bigint, error string")
    got = {r["pos"]: (r["status"], r["error"]) for r in contact.merge_outcomes(plan, told).collect()}
    assert got == {0: ("SENT_TO_TEST_INBOX", ""), 1: ("SKIPPED_DUPLICATE", ""),
                   2: ("FAILED", "mailbox full"), 3: ("PLANNED", "")}


def test_dm_queue_is_first_wins_and_keeps_old_rows(spark, tmp_path):
    rows = [
        message(2, influencer_id="A", dm="late"), message(1, influencer_id="A", dm=" first ", approved=False),
        message(3, influencer_id="B", dm=" 　"), message(4, influencer_id=None), message(5, influencer_id="C"),
    ]
    old = spark.createDataFrame([("C", "n", "old", "DONE")], DM_QUEUE)
    messages = batch(spark, *rows)
    queue = contact.dm_queue(messages, old)
    assert sorted(tuple(r) for r in queue.collect()) == [
        ("A", "N1", "first", "PENDING_MANUAL"), ("C", "n", "old", "DONE")]
    path = str(tmp_path / "queue")
    for _ in range(2):
        tables.append_dms(messages, tables.read_optional(spark, path, DM_QUEUE), path)
    assert tables.read_table(spark, path, DM_QUEUE).count() == 2


def test_a_row_without_a_status_blocks_a_live_send(spark):
    known = log(spark, ("u0@b.co", None), ("u1@b.co", ""))
    rows = [message(i, email=f"u{i}@b.co") for i in range(3)]
    got = statuses(contact.plan_contacts(batch(spark, *rows), known, live=True))
    assert got == {0: "SKIPPED_DUPLICATE", 1: "SKIPPED_DUPLICATE", 2: "PLANNED"}


def test_a_message_without_a_place_ends_the_job(spark):
    rows = batch(spark, message(None), message(1))
    for plan in (contact.plan_contacts(rows, log(spark)), contact.new_dms(rows, spark.createDataFrame([], DM_QUEUE))):
        with pytest.raises(Exception, match="no pos"):
            plan.collect()


def test_newest_outcome_counts_once(spark):
    plan = contact.plan_contacts(batch(spark, message(0, email="a@b.co"), message(1, email="c@b.co")), log(spark), live=True)
    rows = [(0, "busy", AT), (0, None, AT.replace(hour=2)), (1, None, AT), (1, "full", AT), (9, None, AT)]
    told = spark.createDataFrame(rows, "pos bigint, error string, told_at timestamp")
    got = [(r["pos"], r["status"], r["error"]) for r in contact.merge_outcomes(plan, told).collect()]
    assert sorted(got) == [(0, "SENT_TO_TEST_INBOX", ""), (1, "FAILED", "full")]


def test_tracking(spark):
    rows = contact.tracking(log(spark, ("a@b.co", "SIMULATED"), ("A@b.co", "SIMULATED"), ("c@b.co", "FAILED"), ("d@b.co", None)))
    got = {(r["level"], str(r["day"]), r["status"]): (r["attempts"], r["contacts"]) for r in rows.collect()}
    assert got == {
        ("status", "2026-10-01", "SIMULATED"): (2, 1), ("status", "2026-10-01", "FAILED"): (1, 1),
        ("status", "2026-10-01", None): (1, 1), ("day", "2026-10-01", None): (4, 3), ("all", "None", None): (4, 3),
    }
