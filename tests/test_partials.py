"""Tracking reports from partials of runs against the report over the whole log."""

import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from scoutline.operators import contact, score
from scoutline.plans import stages
from scoutline.schemas import CONTACT_LOG
from scoutline.session import stored
from scoutline.sources import numbers

AT = datetime(2026, 10, 1, tzinfo=timezone.utc)


def rows_of(df):
    return sorted((str(r["day"]), str(r["status"]), r["level"], r["attempts"], r["contacts"]) for r in df.collect())


def random_log(spark, rng, n):
    emails = [None, " ", "A@b.co", "a@b.co ", *[f"u{i}@b.co" for i in range(30)]]
    statuses = [None, "SIMULATED", "FAILED", "SENT_TO_TEST_INBOX"]
    rows = [
        (None, None, rng.choice(emails), None, None, False, rng.choice([None, *[AT + timedelta(days=d) for d in range(3)]]), rng.choice(statuses), "")
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, CONTACT_LOG)


def test_partials_equal_the_whole_log(spark, tmp_path):
    base, rng = str(tmp_path), random.Random(6)
    logs = {f"run-{i}": stored(random_log(spark, rng, n), "log") for i, n in enumerate((80, 1, 60))}
    for run, log in logs.items():
        stages.count_run(log, base, run)
    whole = logs["run-0"].unionByName(logs["run-1"]).unionByName(logs["run-2"])
    blank = F.when(F.trim("email") != "", F.col("email"))  # an empty address is none
    assert rows_of(stages.tracked(spark, base)) == rows_of(contact.tracking(whole.withColumn("email", blank)))
    # Any period, and a run that is counted again with other rows.
    some = F.col("day") > "2026-10-01"
    assert rows_of(stages.tracked(spark, base, some)) == rows_of(
        contact.tracking(whole.withColumn("email", blank).where(F.to_date("date") > "2026-10-01")))
    stages.count_run(logs["run-1"], base, "run-0")
    less = logs["run-1"].unionByName(logs["run-1"]).unionByName(logs["run-2"])
    assert rows_of(stages.tracked(spark, base)) == rows_of(contact.tracking(less.withColumn("email", blank)))


def test_nothing_counted_yet(spark, tmp_path):
    assert rows_of(stages.tracked(spark, str(tmp_path))) in ([], [("None", "None", "all", None, 0)])


def test_numbers_are_dense_and_kept(spark, tmp_path):
    path, known = str(tmp_path / "n"), {}
    rng = random.Random(2)
    for run in range(4):
        asked = {f"k{rng.randint(0, 400)}" for _ in range(150)}
        frame = spark.createDataFrame([(k,) for k in [*asked, *asked, None]], "key string")
        got = {r.key: r.number for r in numbers.numbered(frame, path, f"r{run}").collect()}
        assert set(got) == asked and all(known.setdefault(k, n) == n for k, n in got.items())
    assert len(set(known.values())) == len(known)
    places = {}
    for n in known.values():
        places.setdefault(n >> numbers.PLACE_BITS, []).append(n & (1 << numbers.PLACE_BITS) - 1)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_the_shortlist_reads_its_input_once(spark, tmp_path):
    path = str(tmp_path / "evaluated")
    spark.range(200).selectExpr("id as pos", "if(id % 3 = 0, 'FAIL', 'PASS') as status", "cast(id % 4 as double) as brand_fit_score").write.parquet(path)
    ranked = score.shortlist(spark.read.parquet(path))
    assert path not in " ".join(ranked.inputFiles())  # it was read when the numbered rows were written
    want = sorted(((-(p % 4), p) for p in range(200) if p % 3), key=lambda x: x)
    assert [(r["rank"], r["pos"]) for r in ranked.collect()] == [(i + 1, p) for i, (_, p) in enumerate(want)]
