import json
from datetime import datetime
from types import SimpleNamespace

import pytest

from scoutline.operators import discover, enrich, quality
from scoutline.config import Enrichment, Rules, Settings
from scoutline.plans import views
from scoutline.schemas import CREATORS, MESSAGES, PLAYLIST_ITEMS, RAW_CHANNELS, SEARCH_PAGES, VIDEOS
from scoutline.session import drop_dir, shared_dir, stored
from scoutline.sources import landing, tables
from tests.llm.conftest import SF


def lines(folder, *records):
    folder.mkdir()
    (folder / "part.json").write_text("\n".join(json.dumps(r) for r in records), encoding="utf-8")
    return str(folder)


def test_landed_search_pages(spark, tmp_path):
    path = lines(
        tmp_path / "pages",
        {"keyword_idx": 0, "keyword": "k", "type_idx": 0, "result_type": "channel", "page_idx": 0,
         "fetched_at": "2026-10-01T00:00:00Z", "response": {
             "items": [{"id": {"channelId": "UC1"}, "snippet": {}}, {"snippet": {"title": "lost"}}],
             "nextPageToken": "next"}},
        {"keyword_idx": 0, "keyword": "k", "type_idx": 1, "result_type": "video", "page_idx": 0,
         "response": {"items": [{"id": {"videoId": "V"}, "snippet": {"channelId": "UC2"}}]}},
        {"keyword_idx": 1, "keyword": "l", "type_idx": 0, "result_type": "channel", "page_idx": 0, "response": {}},
        {"keyword_idx": 1, "keyword": "l", "type_idx": 1, "result_type": "video", "page_idx": 0, "status": "error"},
    )
    pages = landing.search_pages(spark, path)
    assert {r["next_page_token"] for r in pages.collect()} == {"next", None}
    assert pages.columns == SEARCH_PAGES.fieldNames()
    hits = discover.explode_hits(discover.readable_pages(pages)).orderBy("channel_id").collect()
    assert [(r["channel_id"], r["title"]) for r in hits] == [("UC1", ""), ("UC2", None)]


def channel(key, **snippet):
    return {"resp_pos": 0, "id": key, "snippet": snippet, "statistics": {"subscriberCount": "5511"},
            "contentDetails": {"relatedPlaylists": {"uploads": f"UU-{key}"}}}


def test_torn_lines_are_failed_pages_and_counted(spark, tmp_path):
    base = {"keyword": "k", "type_idx": 0, "result_type": "channel", "keyword_idx": 0}
    path = lines(
        tmp_path / "pages",
        *[{**base, "page_idx": n, "response": {"items": [{"id": {"channelId": f"UC{n}"}}], "nextPageToken": "t"}} for n in range(4)],
    )
    file = tmp_path / "pages" / "part.json"
    text = file.read_text(encoding="utf-8").split("\n")
    file.write_text("\n".join([text[0], text[1], text[2][:40], text[3]]), encoding="utf-8")
    pages = landing.search_pages(spark, path)
    assert sorted(r["status"] for r in pages.collect()) == ["error", "ok", "ok", "ok"]
    kept = discover.readable_pages(pages.where("page_idx is not null")).collect()
    assert sorted(r["page_idx"] for r in kept) == [0, 1]
    assert sorted(r["channel_id"] for r in discover.explode_hits(discover.readable_pages(pages)).collect()) == ["UC0", "UC1"]
    assert tuple(landing.torn_lines(spark, path).first()) == (1, 4)
    report = quality.quality_report(quality.landing_checks(landing.torn_lines(spark, path))).first()
    assert tuple(report) == ("landed lines whole", 1, 4, False)
    both = landing.torn_lines(spark, path).unionByName(spark.createDataFrame([(0, 0)], "torn long, lines long"))
    assert quality.landing_checks(both).first()["total_rows"] == 4


def test_landed_videos_are_taken_apart_once(spark, tmp_path):
    """Each part is opened once for all its fields, whatever is asked of them, and values of any kind read as text."""
    kinds = {"text": "a", "whole": 5, "half": 1.5, "yes": True, "none": None, "list": ["a"], "object": {"a": 1}}
    path = lines(tmp_path / "v", *[{"id": k, "snippet": {"title": v}, "statistics": {"viewCount": v}} for k, v in kinds.items()])
    read = landing.videos(spark, path)
    plan = read._jdf.queryExecution().optimizedPlan().toString().replace("try_variant_get(snippet", "variant_get(snippet")
    assert plan.count("variant_get(snippet") == 1 and plan.count("variant_get(statistics") == 1
    want = {"text": "a", "whole": "5", "half": "1.5", "yes": "true", "none": None, "list": '["a"]', "object": '{"a":1}'}
    rows = read.collect()
    assert {r["video_id"]: (r["title"], r["view_count"]) for r in rows} == {k: (v, v) for k, v in want.items()}
    assert {r["video_id"] for r in rows if r["invalid_field"] == "title"} == set(kinds) - {"text"}


def test_both_landings_of_the_videos_come_from_one_read(spark):
    """Every eleventh video is landed twice; the joins that make it are done once."""
    made = views.videos(spark, SF)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "l_quantity" in plan and "Union" not in plan
    rows = [(r["playlist_id"], r["video_id"], r["title"], r["view_count"]) for r in made.collect()]
    old = {r[:2] for r in rows if r[2:] == ("old title", "7")}
    assert old == {r[:2] for r in rows if int(r[1][1:]) % 11 == 0} and len(rows) == len({r[:2] for r in rows}) + len(old)


def test_null_parts_and_wrong_types_break_a_record(spark, tmp_path):
    path = lines(
        tmp_path / "v",
        {"id": "ok", "snippet": {"tags": [], "title": "t"}, "statistics": {"viewCount": 5}}, {"id": "bare"},
        {"id": "tags", "snippet": {"tags": None}}, {"id": "mixed", "snippet": {"tags": ["a", 3]}}, {"id": "text", "snippet": {"tags": "a"}},
        {"id": "snippet", "snippet": None}, {"id": "list", "snippet": [1]}, {"id": "counts", "snippet": {}, "statistics": None},
    )
    rows = {r["video_id"]: r for r in landing.videos(spark, path).collect()}
    assert {k: r["invalid_field"] for k, r in rows.items()} == {
        "ok": None, "bare": None, "tags": "tags", "mixed": "tags", "text": "tags", "snippet": "snippet", "list": "snippet",
        "counts": "statistics"}
    assert rows["ok"]["view_count"] == "5"
    path = lines(
        tmp_path / "c", {"id": "none", "snippet": {}, "statistics": None}, channel("sound", defaultLanguage="", defaultAudioLanguage=3),
        channel("unused", defaultLanguage="en", defaultAudioLanguage=3),
    )
    rows = {r["channel_id"]: r["invalid_field"] for r in landing.channels(spark, path).collect()}
    assert rows == {"none": "statistics", "sound": "language", "unused": None}


def test_content_details_that_break_a_record(spark, tmp_path):
    """Wrong types where the uploads playlist should be found; absent parts and a null playlist are fine."""
    details = {
        "null": None, "text": "x", "list": [], "number": 3, "inner null": {"relatedPlaylists": None}, "inner list": {"relatedPlaylists": []},
        "uploads": {"relatedPlaylists": {"uploads": ["UU"]}}, "empty": {}, "inner empty": {"relatedPlaylists": {}},
        "none": {"relatedPlaylists": {"uploads": None}}, "ok": {"relatedPlaylists": {"uploads": "UU1"}},
    }
    path = lines(tmp_path / "c", {"id": "absent"}, *[{"id": k, "contentDetails": v} for k, v in details.items()])
    rows = {r["channel_id"]: r for r in landing.channels(spark, path).collect()}
    assert {k: r["invalid_field"] for k, r in rows.items() if r["invalid_field"]} == {
        "null": "contentDetails", "text": "contentDetails", "list": "contentDetails", "number": "contentDetails",
        "inner null": "relatedPlaylists", "inner list": "relatedPlaylists", "uploads": "uploads"}
    assert {k for k, r in rows.items() if r["uploads_playlist"] and not r["invalid_field"]} == {"ok"}
    raw = spark.createDataFrame([(k, f"raw {k}", "kw", datetime(2026, 10, 1), 0) for k in rows], RAW_CHANNELS)
    none = spark.createDataFrame([], PLAYLIST_ITEMS), spark.createDataFrame([], VIDEOS)
    made = enrich.creators(raw, landing.channels(spark, path), *none, Settings()).collect()
    assert {r["id"]: r["name"] for r in made if r["enrich_error"]} == {
        k: f"raw {k}" for k, r in rows.items() if r["invalid_field"]}


def test_playlists_of_several_pages(spark, tmp_path):
    entries = [{"contentDetails": {"videoId": f"V{i:03d}"}} for i in range(150)]
    old, new = "2026-09-01T00:00:00Z", "2026-10-01T00:00:00Z"

    def page(playlist, n, at=new, token="t", **more):
        return {"playlist_id": playlist, "fetched_at": at, "page_idx": n, "items": entries[50 * n : 50 * n + 50], "nextPageToken": token, **more}

    path = lines(
        tmp_path / "p",
        page("two", 1, token=None), page("two", 0), page("two", 0, at=old), page("two", 1, at=old), page("two", 2, at=old),
        page("ended", 0, token=""), page("ended", 1), page("gap", 0), page("gap", 2), page("failed", 0), page("failed", 1, status="error"),
        page("lost", 1), {"playlist_id": "plain", "fetched_at": new, "items": entries[:30]}, {"playlist_id": "bare", "items": entries[:2]},
    )
    items = landing.playlist_items(spark, path)
    assert items.columns == PLAYLIST_ITEMS.fieldNames()
    for wanted, most in ((80, 80), (10, 10), (200, 100)):
        got = {}
        for r in enrich.recent_uploads(items, Enrichment(recent_videos=wanted)).orderBy("playlist_id", "item_idx").collect():
            got.setdefault(r["playlist_id"], []).append(r["video_id"])
        assert {k: len(v) for k, v in got.items()} == {
            "two": most, "ended": min(50, wanted), "gap": min(50, wanted), "failed": min(50, wanted), "plain": min(30, wanted), "bare": 2}
        assert all(v == [f"V{i:03d}" for i in range(len(v))] for v in got.values())


def test_absent_fields_take_defaults_and_wrong_ones_break_the_record(spark, tmp_path):
    path = lines(
        tmp_path / "channels",
        channel("ok", title="T", description="d", country="IN", defaultLanguage=None, defaultAudioLanguage="en"),
        channel("bare"), channel("name", title=None), channel("number", title=7),
        channel("country", title="T", country=None), channel("text", title="T", description=None),
        channel("tongue", title="T", defaultLanguage=5),
    )
    rows = {r["channel_id"]: r for r in landing.channels(spark, path).collect()}
    assert {k: r["invalid_field"] for k, r in rows.items()} == {
        "ok": None, "bare": None, "name": "name", "number": "name", "country": "country",
        "text": "description", "tongue": "language"}
    assert rows["ok"]["subscriber_count"] == "5511" and rows["ok"]["uploads_playlist"] == "UU-ok"
    assert rows["bare"]["title"] is None


def test_landed_records_become_a_creator(spark, tmp_path):
    channels = lines(tmp_path / "c", channel("UC1", title="T", description="mail me: a@b.co"))
    playlists = lines(tmp_path / "p", {"playlist_id": "UU-UC1", "items": [
        {"contentDetails": {"videoId": "V1"}}, {"contentDetails": {}}, {"contentDetails": {"videoId": "V2"}}]})
    videos = lines(
        tmp_path / "v",
        {"resp_idx": 1, "id": "V2", "playlist_id": "UU-UC1", "snippet": {"title": "x", "tags": ["makeup", "b"], "publishedAt": "2026-09-02"},
         "statistics": {"viewCount": "10"}},
        {"resp_idx": 0, "id": "V1", "playlist_id": "UU-UC1", "snippet": {"title": "y", "publishedAt": "2026-09-01T00:00:00Z"},
         "statistics": {"viewCount": "600", "likeCount": "12", "commentCount": "3"}},
    )
    raw = spark.createDataFrame([("UC1", "raw", "kw", datetime(2026, 10, 1), 0)], RAW_CHANNELS)
    row = enrich.creators(
        raw, landing.channels(spark, channels), landing.playlist_items(spark, playlists),
        landing.videos(spark, videos), Settings(rules=Rules(niche_keywords=("makeup",))),
    ).first()
    assert (row["email"], row["engagement_rate"], row["avg_views"]) == ("a@b.co", 15 / 600, 305.0)
    assert row["recent_titles"] == ["y", "x"] and row["niche"] == "makeup"


def test_flat_files_keep_text_exactly(spark, tmp_path):
    texts = [' blank "both" ends ', "two\nlines", "comma, \\ back", "é", "NA", None]
    data = [(f"I{i}", t, None, "s", t, "d", "a", "PENDING_APPROVAL", i % 2 == 0, i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, MESSAGES)
    tables.write_csv(df.repartition(2), str(tmp_path / "m"), sentinel=("influencer", "email", "email_message"))
    files = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "m").glob("part*"))
    assert "Not Found" in files and '""both""' in files
    back = tables.read_csv(spark, str(tmp_path / "m"), MESSAGES).orderBy("pos").collect()
    assert [r["influencer"] for r in back] == texts and [r["email"] for r in back] == [None] * 6
    assert [r["approved"] for r in back] == [True, False] * 3


def test_file_and_row_order_become_the_message_order(spark, tmp_path):
    rows = [(f"I{i}", f"N{i}", f"a{i}@b.co", "s", "m", "d", "a", "PENDING_APPROVAL", True, i) for i in range(40)]
    df = spark.createDataFrame(rows, MESSAGES).repartitionByRange(4, "pos").sortWithinPartitions("pos")
    tables.write_csv(df.drop("pos"), str(tmp_path / "m"))
    back = tables.read_csv(spark, str(tmp_path / "m"), MESSAGES).orderBy("pos").collect()
    assert [(r["pos"], r["influencer_id"]) for r in back] == [(i, f"I{i}") for i in range(40)]


def test_flat_lists_are_ascii_json(spark):
    data = [("a",) + (None,) * 8 + (['é "x"'],) + (None,) * 17]
    flat = tables.flat(spark.createDataFrame(data, CREATORS), sentinel=("name",)).first()
    assert flat["recent_titles"] == json.dumps(['é "x"']) and flat["fail_reasons"] == "[]"
    assert flat["name"] == "Not Found" and flat["followers"] is None


def test_optional_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.read_optional(spark, path, RAW_CHANNELS).count() == 0
    rows = spark.createDataFrame([("UC1", "t", "k", datetime(2026, 1, 1), 5)], RAW_CHANNELS)
    tables.write_raw_channels(rows, path)
    assert tables.read_optional(spark, path, RAW_CHANNELS).first()["channel_id"] == "UC1"
    with pytest.raises(Exception):
        tables.read_table(spark, path + "x", RAW_CHANNELS)


def test_stage_tables(spark, tmp_path):
    rows = spark.createDataFrame([("UC1", "t", "k", datetime(2026, 1, 1), 5)], RAW_CHANNELS)
    stored = tables.store(rows, str(tmp_path / "a"))
    tables.write_creators(stored, str(tmp_path / "b"))
    tables.write_shortlist(stored.withColumnRenamed("pos", "rank"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c")).first()["rank"] == 5


class Session:
    """Only what shared_dir asks of a session."""

    def __init__(self, **conf):
        self.conf = SimpleNamespace(get=lambda key, *default: conf.get(key, *default))


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark, "x") != shared_dir(spark, "x")
    cluster = Session(**{"spark.checkpoint.dir": "hdfs://shared/tmp/", "spark.sql.warehouse.dir": "hdfs://w"})
    assert shared_dir(cluster, "x").startswith("hdfs://shared/tmp/x-")
    unset = Session(**{"spark.sql.warehouse.dir": "hdfs://shared/warehouse/"})
    assert shared_dir(unset, "x").startswith("hdfs://shared/warehouse/_scratch/x-")


def test_a_local_warehouse_is_no_shared_folder_on_a_cluster():
    for base in ("file:/home/me/spark-warehouse", "/home/me/spark-warehouse", "spark-warehouse"):
        for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
            with pytest.raises(RuntimeError, match="checkpoint.dir"):
                shared_dir(Session(**{"spark.sql.warehouse.dir": base, "spark.master": master}), "x")
        for master in ("local", "local[4]", "local[*]"):
            assert "/_scratch/x-" in shared_dir(Session(**{"spark.sql.warehouse.dir": base, "spark.master": master}), "x")
    given = Session(**{"spark.checkpoint.dir": "file:///mnt/all", "spark.sql.warehouse.dir": "w", "spark.master": "yarn"})
    assert shared_dir(given, "x").startswith("file:///mnt/all/x-")


def test_stored_rows_can_be_dropped(spark):
    kept = stored(spark.range(3), "kept")
    assert kept.count() == 3
    path = kept.inputFiles()[0].rsplit("/", 1)[0]
    assert drop_dir(spark, path) and not drop_dir(spark, path)
