import random
from datetime import datetime, timedelta, timezone

from scoutline.operators import contact, discover
from scoutline.schemas import CONTACT_LOG, DM_QUEUE, MESSAGES
from scoutline.sources import tables
from scoutline.streaming import jobs
from tests.test_contact import message

AT = datetime(2026, 10, 1, tzinfo=timezone.utc)
HITS = "keyword_idx int, keyword string, type_idx int, page_idx int, item_idx int, channel_id string, title string, fetched_at timestamp"


def land(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def hit(n, channel):
    return (0, "k", 0, n // 50, n % 50, channel, "t", AT + timedelta(hours=n))


def test_new_channels_over_two_landings(spark, tmp_path):
    source, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    rng = random.Random(2)
    hits = [hit(n, f"UC{rng.randint(0, 60)}") for n in range(300)]
    for part in (hits[:150], hits[150:]):
        land(spark.createDataFrame(part, HITS), source)
        stream = spark.readStream.schema(HITS).parquet(source)
        jobs.new_channels(stream, out, state).awaitTermination()
    rows = [r["channel_id"] for r in spark.read.parquet(out).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == {h[5] for h in hits}
    batch = discover.first_seen(spark.createDataFrame(hits, HITS))
    assert set(rows) == {r["channel_id"] for r in batch.collect()}


def test_contact_log_over_two_landings_equals_batch(spark, tmp_path):
    source, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    rng = random.Random(4)
    rows = [message(i, email=f"u{rng.randint(0, 25)}@b.co") for i in range(80)]
    base = spark.createDataFrame(
        [(None, None, "u3@b.co", None, None, False, AT, "FAILED", "")], CONTACT_LOG)
    for part in (rows[:40], rows[40:]):
        land(spark.createDataFrame(part, MESSAGES), source)
        stream = spark.readStream.schema(MESSAGES).parquet(source)
        jobs.contact_log(stream, base, out, state, AT).awaitTermination()
    logged = {r["influencer_id"]: r["status"] for r in tables.read_table(spark, out, CONTACT_LOG).collect()}
    batch = contact.plan_contacts(spark.createDataFrame(rows, MESSAGES), base)
    assert logged == {r["influencer_id"]: r["status"] for r in batch.collect()}


def test_replayed_batch_replaces_its_own_rows(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    land(spark.createDataFrame([message(0), message(1)], MESSAGES), source)
    empty = spark.createDataFrame([], CONTACT_LOG)
    for attempt in ("first", "again"):  # a lost checkpoint replays batch 0
        stream = spark.readStream.schema(MESSAGES).parquet(source)
        jobs.contact_log(stream, empty, out, str(tmp_path / attempt), AT).awaitTermination()
    rows = tables.read_table(spark, out, CONTACT_LOG).collect()
    assert sorted(r["status"] for r in rows) == ["SIMULATED", "SKIPPED_DUPLICATE"]


def test_dm_queue_over_two_landings(spark, tmp_path):
    source, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    rows = [message(i, influencer_id=f"I{i % 7}", dm=f"dm {i}") for i in range(30)]
    base = spark.createDataFrame([("I3", "n", "old", "DONE")], DM_QUEUE)
    for part in (rows[:12], rows[12:]):
        land(spark.createDataFrame(part, MESSAGES), source)
        stream = spark.readStream.schema(MESSAGES).parquet(source)
        jobs.dm_queue(stream, base, out, state).awaitTermination()
    got = {r["influencer_id"]: r["dm"] for r in tables.read_table(spark, out, DM_QUEUE).collect()}
    assert got == {f"I{i}": f"dm {i}" for i in (0, 1, 2, 4, 5, 6)}


def test_creators_that_the_state_has_forgotten(spark, tmp_path):
    """Repeats in landings long after the state forgot them, and a batch that is worked off again."""
    source, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    landings = [[hit(n, f"UC{n % 7}") for n in range(20)], [hit(n, f"UC{n % 9}") for n in range(20)], [hit(3, "UC1"), hit(4, "UC99")]]
    for part in landings:
        land(spark.createDataFrame(part, HITS), source)
        stream = spark.readStream.schema(HITS).parquet(source)
        jobs.new_channels(stream, out, state, timedelta(milliseconds=1)).awaitTermination()
    first = {(r["batch_id"], r["channel_id"]) for r in spark.read.parquet(out).collect()}
    assert sorted(c for _, c in first) == sorted([*(f"UC{i}" for i in range(9)), "UC99"])
    commits = sorted((tmp_path / "state/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink()
    stream = spark.readStream.schema(HITS).parquet(source)
    jobs.new_channels(stream, out, state, timedelta(milliseconds=1)).awaitTermination()
    assert {(r["batch_id"], r["channel_id"]) for r in spark.read.parquet(out).collect()} == first


def test_a_task_passes_on_one_hit_per_creator(spark):
    rows = spark.createDataFrame([("a", 5), ("a", 7), ("b", 1), ("a", 2), ("a", 2)], "channel_id string, pos long").coalesce(1)
    got = rows.mapInArrow(jobs._first_of_task, rows.schema).collect()
    assert [tuple(r) for r in got] == [("a", 5), ("b", 1), ("a", 2)]


QUOTA = "endpoint string, requested_at timestamp, landed_at timestamp"


def quota(spark, tmp_path, landings, checkpoint="state"):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in landings:
        land(spark.createDataFrame(rows, QUOTA), source)
        stream = spark.readStream.schema(QUOTA).parquet(source)
        jobs.daily_quota(stream, out, str(tmp_path / checkpoint)).awaitTermination()
    return {str(r["day"])[:10]: (r["requests"], r["units"], r["over_quota"], r["closed"]) for r in jobs.quota_totals(spark, out).collect()}


def test_quota_counts_late_rows(spark, tmp_path):
    day = timedelta(days=1)
    first = [("search", AT, AT), ("list", AT + timedelta(hours=1), AT), (None, None, AT)]
    assert quota(spark, tmp_path, [first]) == {"2026-10-01": (2, 101, False, False)}
    # Three days on the first day is closed; its last requests land after that.
    later = [("search", AT + 3 * day, AT + 3 * day)]
    assert quota(spark, tmp_path, [later]) == {"2026-10-01": (2, 101, False, True), "2026-10-04": (1, 100, False, False)}
    late = [("search", AT, AT + 4 * day)] * 100 + [("list", AT + 6 * day, AT + 4 * day)]
    assert quota(spark, tmp_path, [late]) == {
        "2026-10-01": (102, 10_101, True, True), "2026-10-04": (1, 100, False, False), "2026-10-07": (1, 1, False, False)}


def test_quota_of_random_landings_equals_the_batch(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice(["search", "list"]), AT + timedelta(hours=rng.randint(0, 90))) for _ in range(400)]
    landings = [[(*r, AT + timedelta(days=2 * i)) for r in rows[i::4]] for i in range(4)]
    got = quota(spark, tmp_path, landings)
    want = discover.quota_use(spark.createDataFrame(rows, "endpoint string, requested_at timestamp")).collect()
    assert {d: x[:3] for d, x in got.items()} == {str(r["day"])[:10]: (r["requests"], r["units"], r["over_quota"]) for r in want}
    changes = spark.read.parquet(str(tmp_path / "out")).count()
    commits = sorted((tmp_path / "state/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for lost in commits[-2:]:  # a driver that died before it could note these batches
        lost.unlink()
        (lost.parent / f".{lost.name}.crc").unlink()
    assert quota(spark, tmp_path, [[]]) == got
    assert spark.read.parquet(str(tmp_path / "out")).count() == changes


def test_a_task_sends_one_sum_per_day(spark):
    rows = [(AT, AT, 1, 100)] * 50 + [(AT + timedelta(days=1), AT, 1, 1)] * 20
    costs = spark.createDataFrame(rows, "day timestamp, landed_at timestamp, requests long, units long").coalesce(1)
    got = costs.mapInArrow(jobs._sums_of_task, costs.schema).collect()
    assert sorted((r.requests, r.units) for r in got) == [(20, 20), (50, 5000)]


def test_quota_of_a_task_with_several_batches(spark, tmp_path):
    rows = [("search" if n % 2 else "list", AT + timedelta(hours=n % 30), AT + timedelta(hours=40)) for n in range(200)]
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    spark.conf.set(size, "7")
    try:
        got = quota(spark, tmp_path, [rows])
    finally:
        spark.conf.set(size, before)
    want = discover.quota_use(spark.createDataFrame([r[:2] for r in rows], "endpoint string, requested_at timestamp")).collect()
    assert {d: x[:3] for d, x in got.items()} == {str(r["day"])[:10]: (r["requests"], r["units"], r["over_quota"]) for r in want}
