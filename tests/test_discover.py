import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from scoutline.config import Discovery, Enrichment
from scoutline.operators import discover, enrich, ordering
from scoutline.schemas import CHANNELS, PLAYLIST_ITEMS, SEARCH_PAGES
from scoutline.session import stored
from scoutline.sources import landing

HITS = (
    "keyword_idx int, keyword string, type_idx int, result_type string, page_idx int, "
    "item_idx int, channel_id string, title string, fetched_at timestamp"
)


def page(keyword, type_idx, number, items, status="ok", token="next"):
    kind = ("channel", "video")[type_idx]
    return (keyword, f"kw{keyword}", type_idx, kind, number, status, None, items, token)


def test_titles_and_first_hits_equal_a_loop(spark):
    """Random pages with repeated, missing and blank ids in both kinds of results."""
    rng = random.Random(21)
    rows = []
    for k in range(2):
        for y in range(2):
            for p in range(4):
                items = [
                    tuple(rng.choice([None, "", f"C{rng.randint(0, 9)}"]) for _ in range(2))
                    + (rng.choice([None, f"t{k}{y}{p}{i}"]), rng.choice([None, f"c{k}{y}{p}{i}"]))
                    for i in range(rng.randint(0, 5))
                ]
                rows.append(page(k, y, p, items))
    want = {}
    for row in rows:
        for own, of_snippet, title, channel_title in row[7]:
            key, name = (own, title or "") if row[2] == 0 else (of_snippet, channel_title)
            if key and key not in want:
                want[key] = (name, row[1])
    found = discover.first_seen(discover.explode_hits(spark.createDataFrame(rng.sample(rows, len(rows)), SEARCH_PAGES)))
    assert {r["channel_id"]: (r["title"], r["source_keyword"]) for r in found.collect()} == want


def test_ends_of_chains(spark):
    """An error, a missing page and a page without a token each end their own chain only."""
    some = [("C7", None, "t", None)]
    rows = [page(2, 1, n, some, "error" if n in (3, 6) else "ok") for n in range(8)]
    rows += [page(2, 0, n, some) for n in (0, 1, 3, 4)] + [page(1, 1, n, some, token=None if n == 2 else "t") for n in range(5)]
    rows += [page(1, 0, n, some) for n in (1, 2)] + [page(0, 0, 0, None, token="")] + [page(0, 1, 0, some)] * 2
    kept = discover.readable_pages(spark.createDataFrame(rows, SEARCH_PAGES)).collect()
    assert sorted((r["keyword_idx"], r["type_idx"], r["page_idx"]) for r in kept) == [
        (0, 0, 0), (0, 1, 0), (0, 1, 0), (1, 1, 0), (1, 1, 1), (1, 1, 2), (2, 0, 0), (2, 0, 1), (2, 1, 0), (2, 1, 1), (2, 1, 2)]


def loop_ends(rows):
    """First place of a chain that is not whole: rows are (place, broken, last)."""
    for place in range(max(r[0] for r in rows) + 2):
        here = [r for r in rows if r[0] == place]
        if not here or any(r[1] for r in here):
            return place
        if any(r[2] for r in here):
            return place + 1


@pytest.mark.parametrize("block_bits", [0, 2, 14])
def test_ends_of_random_chains(spark, block_bits):
    """Gaps and ends at any place of a block, repeated rows, NULL chains and rows without a place."""
    rng, rows = random.Random(block_bits), []
    for chain in [None, *range(60)]:
        places = [p for p in range(rng.randint(1, 25)) if rng.random() < 0.95] or [0]
        rows += [(chain, p, rng.random() < 0.03, rng.random() < 0.03) for p in places for _ in range(rng.choice([1, 1, 1, 2]))]
    df = spark.createDataFrame([*rows, (3, None, True, True)], "chain int, place int, broken boolean, last boolean")
    by_chain = {c: [r[1:] for r in rows if r[0] == c] for c in {r[0] for r in rows}}
    kept = ordering.unbroken(df, ["chain"], "place", F.col("broken"), F.col("last"), block_bits).collect()
    assert sorted(map(str, kept)) == sorted(str(r) for r in df.collect() if r.place is not None and r.place < loop_ends(by_chain[r.chain]))


def test_landed_pages_are_parsed_once(spark, tmp_path):
    """The plan of the hits reads no JSON: the stored pages twice, of which once only what decides the ends."""
    folder = tmp_path / "pages"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps({"keyword_idx": 0, "keyword": "k", "type_idx": 0, "result_type": "channel", "page_idx": 0,
                                               "response": {"items": [{"id": {"channelId": "UC1"}}]}}))
    pages = landing.search_pages(spark, str(folder))
    assert pages._jdf.queryExecution().executedPlan().toString().count("FileScan json") == 1
    hits = discover.explode_hits(discover.readable_pages(stored(pages, "pages")))
    assert hits.count() == 1
    plan = hits._jdf.queryExecution().sparkPlan().toString()
    assert "FileScan json" not in plan and plan.count("FileScan parquet") == 2
    assert sum("items" in line for line in plan.split("\n") if "FileScan" in line) == 1


def loop_cap(hits, target):
    known = set()
    for key in sorted({h[:3] for h in hits}):
        if len(known) >= target:
            break
        known |= {h[4] for h in hits if h[:3] == key}
    return known


def test_page_cap_equals_loop(spark, monkeypatch):
    monkeypatch.setattr(discover, "BLOCK_BITS", 2)
    rng = random.Random(7)
    hits = [
        (k, y, p, i, f"UC{rng.randint(0, 150)}")
        for k in range(3) for y in range(2) for p in range(9) for i in range(rng.randint(1, 6))
    ]
    df = spark.createDataFrame(
        [(k, f"kw{k}", y, "channel", p, i, c, "t", None) for k, y, p, i, c in hits], HITS
    )
    found = discover.first_seen(df).cache()
    for target in (0, 1, 5, 17, 40, 80, 120, 1000):
        kept = {r["channel_id"] for r in discover.cap_pages(found, target).collect()}
        assert kept == loop_cap(hits, target), target
    found.unpersist()


def test_position_out_of_range_fails_loudly(spark):
    df = spark.createDataFrame([(0, "k", 0, "channel", 0, 5000, "UC", "t", None)], HITS)
    with pytest.raises(Exception, match="out of range"):
        discover.first_seen(df).collect()


def test_search_keys_equal_python_json(spark):
    discovery = Discovery(keywords=("skin é", 'q"x'), page_size=80, region_code="IN", language=None)
    tokens = spark.createDataFrame([(1, 1, "tok")], "keyword_idx int, type_idx int, page_token string")
    rows = discover.search_requests(spark, discovery, tokens).collect()
    assert len(rows) == 5
    for r in rows:
        params = {"part": "snippet", "q": r["keyword"], "type": r["result_type"], "maxResults": 50,
                  "regionCode": "IN"}
        if r["page_token"]:
            params["pageToken"] = r["page_token"]
        text = json.dumps(params, sort_keys=True)
        assert r["request_key"] == hashlib.sha256(text.encode()).hexdigest()[:24]


def test_creator_requests_and_pending(spark):
    channels = spark.createDataFrame(
        [
            ("UC1", 0, *[None] * 6, "UU1", None, None), ("UC2", 0, *[None] * 6, "", None, None),
            ("UC1", 1, "renamed", *[None] * 5, "UU1", None, None),
        ],
        CHANNELS,
    )
    items = spark.createDataFrame([("UU1", i, v, None) for i, v in ((1, "V2"), (0, "V1"), (2, "V3"))], PLAYLIST_ITEMS)
    plan = discover.creator_requests(channels, items, Enrichment(recent_videos=2))
    assert plan.count() == 2  # a repeated record asks for nothing twice
    keys = {r["endpoint"]: r["request_key"] for r in plan.collect()}
    text = json.dumps({"endpoint": "videos", "part": "snippet,statistics", "id": "V1,V2"}, sort_keys=True)
    assert keys["videos"] == hashlib.sha256(text.encode()).hexdigest()[:24]
    landed = spark.createDataFrame(
        [(keys["videos"], "{}"), (keys["playlistItems"], " null")], "request_key string, response string"
    )
    left = discover.pending(plan, landed).collect()
    assert [r["endpoint"] for r in left] == ["playlistItems"]


def test_channel_requests(spark):
    raw = spark.createDataFrame([("b",), ("a",)], "channel_id string")
    row = discover.channel_requests(raw).first()
    params = {"endpoint": "channels", "part": "snippet,statistics,contentDetails", "id": "a,b"}
    text = json.dumps(params, sort_keys=True)
    assert row["request_key"] == hashlib.sha256(text.encode()).hexdigest()[:24]


def test_landed_channels_keep_their_requests(spark):
    """One new id that sorts first makes one new request and leaves what has landed alone."""
    raw = spark.createDataFrame([(f"UC{i:03d}",) for i in range(120)], "channel_id string")
    known = raw.where("channel_id <> 'UC000'")
    rows = discover.channel_requests(raw, known).collect()
    assert [(r["id_list"], r["ids"]) for r in rows] == [("UC000", 1)]
    assert discover.channel_requests(raw, raw).count() == 0


def pages_of(spark, *rows):
    schema = "playlist_id string, fetched_at timestamp, page_idx int, status string, next_page_token string, videos array<string>"
    return spark.createDataFrame(list(rows), schema)


def test_more_videos_than_a_request_returns(spark):
    """80 of 120 uploads: two pages of them are asked for, the second by its token, and two batches of videos."""
    ids = [f"V{i:03d}" for i in range(120)]
    key = lambda **p: hashlib.sha256(json.dumps(p, sort_keys=True).encode()).hexdigest()[:24]
    uploads = dict(endpoint="playlistItems", part="contentDetails", playlistId="UU1", maxResults=50)
    videos = lambda x: key(endpoint="videos", part="snippet,statistics", id=",".join(x))
    channels = spark.createDataFrame([("UC1", 0, *[None] * 6, "UU1", None, None)], CHANNELS)
    first = ("UU1", None, 0, "ok", "p1", ids[:50])
    second = ("UU1", None, 1, "ok", "p2", ids[50:100])
    steps = (
        ((), {key(**uploads)}),
        ((first,), {key(**uploads), key(**uploads, pageToken="p1"), videos(ids[:50])}),
        # 100 entries hold the 80 that are wanted, so the third page is not asked for.
        ((first, second), {key(**uploads), videos(ids[:50]), videos(ids[50:80])}),
    )
    for landed, want in steps:
        pages = pages_of(spark, *landed)
        plan = discover.creator_requests(channels, enrich.listed_videos(pages), Enrichment(recent_videos=80), pages)
        assert {r["request_key"] for r in plan.collect()} == want


def test_yield_credits_first_hit(spark):
    df = spark.createDataFrame(
        [
            (0, "a", 0, "channel", 0, 0, "UC1", "t", None),
            (0, "a", 0, "channel", 0, 1, "UC1", "t", None),
            (1, "b", 1, "video", 0, 0, "UC1", "t", None),
        ],
        HITS,
    )
    rows = {r["keyword"]: tuple(r)[2:] for r in discover.keyword_yield(df).collect()}
    assert rows == {"a": (2, 1, 1), "b": (1, 1, 0)}


def test_quota(spark):
    df = spark.createDataFrame(
        [("search", "2026-01-01 10:00:00")] * 3 + [("list", "2026-01-01 23:59:59"), ("list", "2026-01-02 00:00:00")],
        "endpoint string, t string",
    ).select("endpoint", F.to_timestamp("t").alias("requested_at"))
    rows = {str(r["day"])[:10]: (r["units"], r["over_quota"]) for r in discover.quota_use(df, 300).collect()}
    assert rows == {"2026-01-01": (301, True), "2026-01-02": (1, False)}
