"""Attempts as keyed state: outcomes late, repeated and missing, in several landings, against a plain loop."""

import random
import shutil
from datetime import datetime, timedelta, timezone

import pytest

from scoutline.operators import contact
from scoutline.schemas import CONTACT_LOG, MESSAGES
from scoutline.sources import tables
from scoutline.streaming import attempts as A
from tests.test_contact import batch, log, message, statuses

T0 = datetime(2026, 10, 1, tzinfo=timezone.utc)
DAY = timedelta(days=1)
OUTCOMES = "email string, pos long, error string, told_at timestamp, landed_at timestamp"
LANDED = "landed_at timestamp"


class Run:
    """Streams over two folders, landed into and worked off step by step."""

    def __init__(self, spark, base, old=()):
        self.spark, self.base = spark, base
        self.old = log(spark, *old) if old else spark.createDataFrame([], CONTACT_LOG)
        self.schema = batch(spark).withColumn("landed_at", A.F.lit(T0)).schema
        self.land([], [], T0)

    def land(self, messages, outcomes, at):
        rows = [(*m, at) for m in messages]
        self.spark.createDataFrame(rows, self.schema).coalesce(2).write.mode("append").parquet(f"{self.base}/messages")
        told = [(*o, at) for o in outcomes]
        self.spark.createDataFrame(told, OUTCOMES).coalesce(1).write.mode("append").parquet(f"{self.base}/outcomes")

    def work(self, checkpoint="state"):
        read = self.spark.readStream
        changes = A.attempt_changes(
            read.schema(self.schema).parquet(f"{self.base}/messages"),
            read.schema(OUTCOMES).parquet(f"{self.base}/outcomes"),
            self.old, 2 * DAY,
        )
        query = A.run_attempts(changes, f"{self.base}/out", f"{self.base}/{checkpoint}")
        query.awaitTermination()
        assert A.left_out(query) == 0
        return self.seen()

    def seen(self):
        return {r.pos: (r.status, r.error) for r in A.attempts(self.spark, f"{self.base}/out").collect()}


def test_late_repeated_and_missing_outcomes(spark, tmp_path):
    run = Run(spark, str(tmp_path), old=[("u9@b.co", "FAILED"), ("u5@b.co", "SIMULATED")])
    first = [message(i, email=f" U{i % 10}@b.co") for i in range(20)]
    run.land(first, [], T0)
    planned = run.work()
    assert {p for p, (s, _) in planned.items() if s == "PLANNED"} == set(range(9))
    assert {p for p, (s, _) in planned.items() if s == "SKIPPED_DUPLICATE"} == set(range(9, 20))
    told = [
        ("u0@b.co", 0, None, T0),
        ("u1@b.co", 1, "busy", T0), ("u1@b.co", 1, None, T0 + DAY),  # told twice, the newer one counts
        ("u2@b.co", 2, None, T0 + DAY), ("u2@b.co", 2, "busy", T0),
        ("u3@b.co", 3, "full", T0), ("u3@b.co", 3, None, T0),  # told at the same time, the failure counts
        ("u4@b.co", 14, None, T0), ("no@b.co", 77, None, T0), ("u9@b.co", 9, None, T0),  # of other rows
    ]
    run.land([message(30, email="u4@b.co"), message(31, email="new@b.co")], told, T0 + DAY)
    seen = run.work()
    sent, failed = ("SENT_TO_TEST_INBOX", ""), "FAILED"
    assert [seen[i] for i in range(5)] == [sent, sent, sent, (failed, "full"), ("PLANNED", "")]
    assert seen[30][0] == "SKIPPED_DUPLICATE" and seen[31][0] == "PLANNED"
    # Days later: the deadline of what was planned first has passed, not that of the second landing.
    late = [("u5@b.co", 5, None, T0 + DAY), ("u0@b.co", 0, "busy", T0 - DAY), ("u1@b.co", 1, None, T0 + DAY)]
    run.land([message(40, email="other@b.co")], [], T0 + 2 * DAY + timedelta(hours=3))
    seen = run.work()
    assert seen[4] == seen[5] == (failed, A.NO_OUTCOME) and seen[31][0] == "PLANNED"
    run.land([message(41, email="u4@b.co")], late, T0 + 4 * DAY)
    seen = run.work()
    assert seen[5] == sent and seen[0] == sent and seen[1] == sent  # late, older and repeated
    assert seen[4] == seen[31] == (failed, A.NO_OUTCOME) and seen[41][0] == "SKIPPED_DUPLICATE"
    changes = tables.read_table(spark, f"{tmp_path}/out", A.ATTEMPTS)
    assert changes.where("pos = 1").count() == 2  # planned and sent: the repeat wrote nothing


def test_replayed_batch_changes_nothing(spark, tmp_path):
    run = Run(spark, str(tmp_path))
    run.land([message(i, email=f"u{i % 3}@b.co") for i in range(6)], [], T0)
    run.work()
    run.land([], [("u0@b.co", 0, None, T0), ("u1@b.co", 1, "full", T0)], T0 + DAY)
    want = run.work()
    rows = sorted(map(tuple, tables.read_table(spark, f"{tmp_path}/out", A.ATTEMPTS).collect()))
    # The last batches lose their commit, as if the driver had died before it.
    commits = sorted((tmp_path / "state/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for lost in commits[-2:]:
        lost.unlink()
        (lost.parent / f".{lost.name}.crc").unlink(missing_ok=True)
    assert run.work() == want
    assert sorted(map(tuple, tables.read_table(spark, f"{tmp_path}/out", A.ATTEMPTS).collect())) == rows
    shutil.rmtree(tmp_path / "state")
    assert run.work() == want  # and so does a run from the very start


def test_random_landings_equal_the_batch_merge(spark, tmp_path):
    """Without missing outcomes the stream ends where the batch operators do."""
    rng = random.Random(4)
    run = Run(spark, str(tmp_path), old=[("u3@b.co", "SENT_TO_TEST_INBOX")])
    rows = [message(i, email=f"u{rng.randint(0, 12)}@b.co") for i in range(60)]
    run.land(rows, [], T0)
    run.work()
    plan = contact.plan_contacts(batch(spark, *rows), run.old, live=True)
    planned = {r["pos"]: r["email"] for r in plan.where("status = 'PLANNED'").collect()}
    told = []
    for pos, email in planned.items():
        for _ in range(rng.randint(1, 4)):
            told.append((email, pos, rng.choice([None, "busy", "full", " "]), T0 + timedelta(hours=rng.randint(0, 3))))
    rng.shuffle(told)
    for i in range(3):
        run.land([], told[i::3], T0 + timedelta(hours=i + 1))
        seen = run.work()
    outcomes = spark.createDataFrame([(p, e, t) for _, p, e, t in told], "pos long, error string, told_at timestamp")
    want = contact.merge_outcomes(plan, outcomes).collect()
    assert seen == {r["pos"]: (r["status"], r["error"]) for r in want}


def test_one_hot_address(spark, tmp_path):
    """Repeats of an address are dealt over many keys; only the first of each task meets the state."""
    run = Run(spark, str(tmp_path))
    run.land([message(i, email="agency@b.co") for i in range(400)], [], T0)
    assert {p for p, (s, _) in run.work().items() if s == "PLANNED"} == {0}
    assert len(run.seen()) == 400
    frame = batch(spark, *[message(i, email="a@b.co") for i in range(100)]).coalesce(1)
    rows = contact.approved(frame).selectExpr("email_key", "pos", "false as is_outcome")
    dealt = rows.mapInArrow(A._dealt, "email_key string, pos long, is_outcome boolean, part int").collect()
    assert [r.pos for r in dealt if r.part == 0] == [0] and len({r.part for r in dealt}) > 50


def test_rows_that_land_too_late_are_counted(spark, tmp_path):
    run = Run(spark, str(tmp_path))
    run.land([message(0)], [], T0 + 9 * DAY)
    run.work()
    run.land([message(1, email="x@b.co")], [], T0)
    with pytest.raises(AssertionError):
        run.work()
