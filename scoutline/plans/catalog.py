"""Every operator as a query over the test tables, by name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoutline.config import Settings
from scoutline.fixed import EMAIL_SOURCE
from scoutline.functions import text, values
from scoutline.operators import contact, discover, drafts, enrich, quality, score
from scoutline.plans import stages
from scoutline.plans import views as V
from scoutline.plans.flagship import AS_OF, TEST_SETTINGS, evaluated
from scoutline.schemas import CONTACT_LOG, CREATORS, DM_QUEUE, MESSAGES, RAW_CHANNELS
from scoutline.session import configure, shared_dir, stored
from scoutline.sources import landing, tables
from scoutline.streaming import attempts, jobs

Query = Callable[[SparkSession, str], DataFrame]

LOCAL_SETTINGS = replace(
    TEST_SETTINGS, discovery=replace(TEST_SETTINGS.discovery, region_code="NATION_3")
)
RUN_AT = datetime(2024, 2, 1, tzinfo=timezone.utc)
RERUN_AT = datetime(2024, 2, 2, tzinfo=timezone.utc)
TEMPLATE = (
    "Write to {name} on {platform}.\nNiche: {niche}. Themes: {content_themes}.\n"
    "Titles: {recent_titles}.\nBrand {brand_name}, {brand_product}: {collab_angle}. "
    "{value_prop}. Answer as {{json}}."
)
SUFFIX = "You wrote {email_words} words of email and {dm_words} words of DM."

_QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under its function name; the session is configured first."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(configure(spark), sf_dir)

    _QUERIES[build.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def clock(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def rounded(name: str) -> Column:
    return F.round(name, 6).alias(name)


def whole(name: str) -> Column:
    return F.col(name).cast("bigint").alias(name)


# Building blocks shared by several queries --------------------------------------------------


def _evaluated(spark: SparkSession, sf_dir: str, settings: Settings = TEST_SETTINGS) -> DataFrame:
    return evaluated(
        V.raw_channels(spark, sf_dir),
        V.channels(spark, sf_dir),
        V.playlist_items(spark, sf_dir),
        V.videos(spark, sf_dir),
        settings,
        AS_OF,
    )


def _creators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.creators(
        V.raw_channels(spark, sf_dir),
        V.channels(spark, sf_dir),
        V.playlist_items(spark, sf_dir),
        V.videos(spark, sf_dir),
        TEST_SETTINGS,
    )


def _uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.recent_uploads(V.playlist_items(spark, sf_dir), TEST_SETTINGS.enrichment)


def _metrics(
    spark: SparkSession,
    sf_dir: str,
    resp_idx: Column | None = None,
    keywords: tuple[str, ...] = TEST_SETTINGS.rules.niche_keywords,
) -> DataFrame:
    videos = V.videos(spark, sf_dir, resp_idx)
    return enrich.video_metrics(_uploads(spark, sf_dir), videos, keywords)


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drafts.check_attempts(V.draft_attempts(spark, sf_dir), TEST_SETTINGS.drafts)


def _stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    return tables.store(df, shared_dir(spark, name))


# Flagship -----------------------------------------------------------------------------------


@query
def flagship_shortlist(spark, sf_dir):
    return score.shortlist(_evaluated(spark, sf_dir)).select(
        whole("rank"), "id", "name", "followers", rounded("avg_views"), rounded("engagement_rate"),
        "niche", "email", clock(F.col("last_upload")).alias("last_upload"), "status",
        "brand_fit_score",
    )


# Discovery ----------------------------------------------------------------------------------


@query
def search_plan(spark, sf_dir):
    pages = V.pages(spark, sf_dir).where((F.col("status") == "ok") & F.col("next_page_token").isNotNull())
    tokens = pages.select("keyword_idx", "type_idx", F.col("next_page_token").alias("page_token"))
    discovery = replace(TEST_SETTINGS.discovery, keywords=V.KEYWORDS, region_code="IN")
    return discover.search_requests(spark, discovery, tokens).select(
        "keyword", "result_type", F.coalesce("page_token", F.lit("")).alias("page_token"),
        "request_key",
    )


@query
def request_plan(spark, sf_dir):
    return discover.creator_requests(
        V.channels(spark, sf_dir), V.playlist_items(spark, sf_dir), TEST_SETTINGS.enrichment
    )


@query
def request_pending(spark, sf_dir):
    return discover.pending(request_plan(spark, sf_dir), _landed_requests(spark, sf_dir))


def _landed_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = V.table(spark, sf_dir, "customer")
    playlist = V.text_id("UU", F.col("c_custkey"))
    return customers.where("c_acctbal >= 0").select(
        discover.request_key(
            endpoint=F.lit('"playlistItems"'),
            part=F.lit('"contentDetails"'),
            playlistId=values.json_string(playlist),
            maxResults=F.lit("10"),
        ).alias("request_key"),
        F.when(F.col("c_mktsegment") == "BUILDING", "null").otherwise("{}").alias("response"),
    )


@query
def request_pending_keys(spark, sf_dir):
    """The same requests, planned against a key table to which three landings were added."""
    base = shared_dir(spark, "request-keys")
    landed = _landed_requests(spark, sf_dir)
    for i in range(3):
        part = F.pmod(F.xxhash64("request_key"), F.lit(3)) == i
        stages.land_answers(landed.where(part), base, f"landing-{i}")
    return stages.pending_requests(_stored(spark, request_plan(spark, sf_dir), "request-plan"), base)


@query
def page_chain(spark, sf_dir):
    kept = discover.readable_pages(V.pages(spark, sf_dir))
    return kept.select(
        whole("keyword_idx"), whole("type_idx"), whole("page_idx"),
        F.size("items").cast("bigint").alias("items"),
    )


def _hit_columns(hits: DataFrame) -> DataFrame:
    return hits.select(
        whole("keyword_idx"), whole("type_idx"), whole("page_idx"), whole("item_idx"),
        "channel_id", "title",
    )


@query
def hits_exploded(spark, sf_dir):
    return _hit_columns(discover.explode_hits(V.pages(spark, sf_dir)))


def _line(torn: Column) -> Column:
    """The row as a line of JSON; of torn ones only the first half."""
    text = F.to_json(F.struct("*"))
    half = F.substring(text, F.lit(1), F.floor(F.length(text) / 2).cast("int"))
    return F.when(torn, half).otherwise(text).alias("value")


def _land_pages(spark: SparkSession, sf_dir: str) -> str:
    """Search pages landed as nested JSON responses, one of them torn; returns where."""
    path = shared_dir(spark, "search-pages")
    torn = (F.col("keyword_idx") == 0) & (F.col("type_idx") == 1) & (F.col("page_idx") == 30)
    item = F.transform(
        "items",
        lambda i: F.struct(
            F.struct(i["channel_id"].alias("channelId")).alias("id"),
            F.struct(
                i["title"].alias("title"),
                i["snippet_channel_id"].alias("channelId"),
                i["channel_title"].alias("channelTitle"),
            ).alias("snippet"),
        ),
    )
    V.pages(spark, sf_dir).select(
        "keyword_idx", "keyword", "type_idx", "result_type", "page_idx", "status", "fetched_at",
        F.struct(item.alias("items"), F.col("next_page_token").alias("nextPageToken")).alias("response"),
    ).select(_line(torn)).write.text(path)
    return path


@query
def landed_hits(spark, sf_dir):
    """Landed pages read back once, cut at errors and exploded."""
    pages = stored(landing.search_pages(spark, _land_pages(spark, sf_dir)), "pages")
    return _hit_columns(discover.explode_hits(discover.readable_pages(pages)))


@query
def first_seen(spark, sf_dir):
    return discover.first_seen(V.hits(spark, sf_dir)).select(
        "channel_id", "title", "source_keyword", clock(F.col("fetched_at")).alias("fetched_at"),
        "pos",
    )


@query
def page_cap(spark, sf_dir):
    found = discover.first_seen(V.hits(spark, sf_dir))
    return discover.cap_pages(found, TEST_SETTINGS.discovery.target).select(
        "channel_id", "source_keyword", "pos"
    )


@query
def page_cap_open(spark, sf_dir):
    """Discovery without a target keeps every creator."""
    found = discover.first_seen(V.hits(spark, sf_dir))
    target = Settings().discovery.target
    kept = found if target is None else discover.cap_pages(found, target)
    return kept.select("channel_id", "source_keyword", "pos")


@query
def keyword_yield(spark, sf_dir):
    return discover.keyword_yield(V.hits(spark, sf_dir))


@query
def quota_daily(spark, sf_dir):
    return discover.quota_use(V.requests(V.events(spark, sf_dir))).select(
        clock(F.col("day")).alias("day"), "requests", "units", "over_quota"
    )


# Enrichment ---------------------------------------------------------------------------------


@query
def id_batches(spark, sf_dir):
    return discover.channel_requests(V.raw_channels(spark, sf_dir))


@query
def channel_pending(spark, sf_dir):
    """Requests for the channels that have no landed record yet."""
    return discover.channel_requests(V.raw_channels(spark, sf_dir), V.channel_responses(spark, sf_dir))


@query
def channel_left_join(spark, sf_dir):
    facts = enrich.channel_facts(V.channel_responses(spark, sf_dir), ())
    joined = enrich.with_channel_records(V.raw_channels(spark, sf_dir), facts)
    valid = F.col("enrich_error").isNull()
    return joined.select(
        F.col("channel_id").alias("id"),
        enrich.creator_name().alias("name"),
        F.when(valid, F.col("followers")).alias("followers"),
        F.when(valid, F.col("country")).alias("country"),
        F.col("source_keyword").alias("source"),
        clock(F.col("fetched_at")).alias("fetched_at"),
        "enrich_error",
    )


@query
def enrichment_summary(spark, sf_dir):
    return enrich.enrichment_summary(
        enrich.creators(
            V.raw_channels(spark, sf_dir),
            V.channel_responses(spark, sf_dir),
            V.playlist_items(spark, sf_dir),
            V.videos(spark, sf_dir),
            TEST_SETTINGS,
        )
    )


@query
def recent_uploads(spark, sf_dir):
    return _uploads(spark, sf_dir)


@query
def uploaded_videos(spark, sf_dir):
    found = enrich.uploaded_videos(_uploads(spark, sf_dir), V.videos(spark, sf_dir))
    return found.select("playlist_id", "video_id", "title", "published_at")


@query
def recent_titles(spark, sf_dir):
    return _metrics(spark, sf_dir).select(
        "playlist_id", F.array_join("recent_titles", "|").alias("titles")
    )


@query
def last_upload(spark, sf_dir):
    """Responses in key order, so the first video is not the newest."""
    moment = values.to_timestamp(F.col("published_at"))
    return _metrics(spark, sf_dir, F.col("o_orderkey")).select(
        "playlist_id", clock(moment).alias("last_upload")
    )


@query
def avg_views(spark, sf_dir):
    return _metrics(spark, sf_dir).select("playlist_id", rounded("avg_views"))


@query
def avg_reactions(spark, sf_dir):
    found = enrich.reaction_averages(_uploads(spark, sf_dir), V.videos(spark, sf_dir))
    return found.select("playlist_id", rounded("avg_likes"), rounded("avg_comments"))


@query
def engagement(spark, sf_dir):
    return _metrics(spark, sf_dir).select("playlist_id", rounded("engagement_rate"))


@query
def counts_parsed(spark, sf_dir):
    count = F.col("subscriber_count")
    return V.channels(spark, sf_dir).select(
        "channel_id",
        values.to_count(count).alias("followers"),
        values.to_number(count).alias("number"),
    )


@query
def public_text_hits(spark, sf_dir):
    keywords = ("customer", "red", "bolt", "gear", "ECONOMY", "furniture")
    metrics = _metrics(spark, sf_dir, keywords=keywords)
    joined = enrich.channel_facts(V.channels(spark, sf_dir), keywords).join(
        metrics, F.col("uploads_playlist") == F.col("playlist_id"), "left"
    )
    return joined.select(
        "channel_id", F.array_join(enrich.public_keywords(keywords), ", ").alias("hits")
    )


@query
def emails_found(spark, sf_dir):
    found = V.channels(spark, sf_dir).select(
        "channel_id", text.extract_email(F.col("description")).alias("email")
    )
    source = F.when(F.col("email").isNotNull(), EMAIL_SOURCE)
    return found.withColumn("email_source", source)


@query
def emails_in_documents(spark, sf_dir):
    return V.table(spark, sf_dir, "documents").select(
        "doc_id", text.extract_email(F.col("text")).alias("email")
    )


@query
def email_validity(spark, sf_dir):
    return V.messages(spark, sf_dir).select(
        "pos", text.is_valid_email(F.col("email")).alias("valid")
    )


@query
def links(spark, sf_dir):
    return V.channels(spark, sf_dir).select(
        "channel_id", text.profile_links(F.col("description")).alias("links")
    ).select("channel_id", "links.instagram", "links.website")


@query
def page_links(spark, sf_dir):
    pages = V.table(spark, sf_dir, "pages")
    urls = text.extract_urls(F.concat_ws(" ", "url", "html"))
    return pages.select("page_id", urls.alias("urls")).select(
        "page_id",
        F.size("urls").cast("bigint").alias("urls"),
        F.get("urls", F.lit(0))["url"].alias("first_url"),
        F.get("urls", F.lit(0))["host"].alias("first_host"),
    )


@query
def locale_profile(spark, sf_dir):
    return V.channels(spark, sf_dir).select(
        "channel_id",
        enrich.profile_url(F.col("channel_id")).alias("profile_url"),
        enrich.spoken_language().alias("language"),
    )


@query
def titles_json(spark, sf_dir):
    """List column as flat-file JSON text, over titles with accents and quotes."""
    titled = V.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.array("text", F.concat(F.lit('"'), "lang", F.lit('" \\ ☃ \U0001f600'))).alias("titles"),
    )
    return tables.flat(titled).withColumnRenamed("titles", "titles_json")


@query
def flat_file_creators(spark, sf_dir):
    """Creators exported to flat files and imported again."""
    path = shared_dir(spark, "creators-csv")
    text_columns = tuple(
        f.name for f in CREATORS.fields if f.dataType == T.StringType()
    )
    tables.write_csv(_creators(spark, sf_dir), path, sentinel=text_columns)
    return _creator_columns(tables.read_csv(spark, path, CREATORS))


@query
def flat_file_contacts(spark, sf_dir):
    """Messages exported without a position, imported in file order, and planned."""
    path = shared_dir(spark, "messages-csv")
    tables.write_csv(V.messages(spark, sf_dir).orderBy("pos").drop("pos"), path)
    plan = contact.plan_contacts(tables.read_csv(spark, path, MESSAGES), V.contact_log(spark, sf_dir))
    return plan.select("pos", "influencer", "email_key", "status")


@query
def landed_creators(spark, sf_dir):
    """Channels, playlists and videos landed as nested JSON responses, read back and joined."""
    base = shared_dir(spark, "landing")
    channels = V.channels(spark, sf_dir)
    snippet = F.struct(
        "title", "description", "country",
        F.col("default_language").alias("defaultLanguage"),
        F.col("default_audio_language").alias("defaultAudioLanguage"),
    )
    number = F.substring("channel_id", 3, 20).cast("bigint")
    related = F.struct(F.col("uploads_playlist").alias("uploads"))
    # Of the records that break, half have a null country, half a null where the playlists should be.
    no_playlists = F.col("invalid_field").isNotNull() & (number % 2 == 0)
    whole_country = F.when(F.col("invalid_field").isNull() | no_playlists, F.col("country"))
    snippet = snippet.withField("country", whole_country)
    playlists = F.struct(F.when(~no_playlists, related).alias("relatedPlaylists"))
    landed = channels.select(
        "resp_pos", F.col("channel_id").alias("id"), snippet.alias("snippet"),
        F.struct(F.col("subscriber_count").alias("subscriberCount")).alias("statistics"),
        playlists.alias("contentDetails"),
    )
    # Nulls are written out, so an explicit null breaks its record.
    landed.write.option("ignoreNullFields", "false").json(f"{base}/channels")
    # Pages of four entries; every third listing has a stale page behind a gap, every seventh a failed one.
    listed = V.playlist_items(spark, sf_dir).groupBy("playlist_id", "fetched_at").agg(
        F.array_sort(F.collect_list(F.struct("item_idx", "video_id"))).alias("items")
    )
    number = F.substring("playlist_id", 3, 20).cast("bigint")
    last = F.floor((F.size("items") - 1) / 4).cast("int")
    entry = lambda i: F.struct(F.struct(i["video_id"].alias("videoId")).alias("contentDetails"))
    stale = F.array(F.struct(F.struct(F.lit("V0").alias("videoId")).alias("contentDetails")))

    def page(place: Column, items: Column, token: Column, status: str) -> Column:
        return F.struct(
            place.alias("page_idx"), F.lit(status).alias("status"), token.alias("nextPageToken"), items.alias("items")
        )

    none = F.lit(None).cast("string")
    whole_pages = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: page(i, F.transform(F.slice("items", i * 4 + 1, 4), entry), F.when(i < last, F.lit("t")), "ok"),
    )
    more = F.array(
        F.when(number % 3 == 0, page(last + 2, stale, none, "ok")),
        F.when((number % 7 == 0) & (number % 3 != 0), page(last + 1, stale, none, "error")),
    )
    listed.select(
        "playlist_id", "fetched_at", F.inline(F.concat(whole_pages, F.array_compact(more)))
    ).write.json(f"{base}/playlist_items")
    V.videos(spark, sf_dir).select(
        "resp_idx", F.col("video_id").alias("id"), "playlist_id", "fetched_at",
        F.struct("title", "description", "tags", F.col("published_at").alias("publishedAt")).alias(
            "snippet"
        ),
        F.struct(
            F.col("view_count").alias("viewCount"), F.col("like_count").alias("likeCount"),
            F.col("comment_count").alias("commentCount"),
        ).alias("statistics"),
    ).write.json(f"{base}/videos")
    return _creator_columns(
        enrich.creators(
            V.raw_channels(spark, sf_dir),
            landing.channels(spark, f"{base}/channels"),
            landing.playlist_items(spark, f"{base}/playlist_items"),
            landing.videos(spark, f"{base}/videos"),
            TEST_SETTINGS,
        )
    )


def _creator_columns(creators: DataFrame) -> DataFrame:
    return creators.select(
        "id", "name", "followers", rounded("avg_views"), rounded("engagement_rate"), "niche",
        F.array_join("recent_titles", "|").alias("titles"), "email", "instagram_url", "website",
        "country", "language", clock(F.col("last_upload")).alias("last_upload"), "source",
        clock(F.col("fetched_at")).alias("fetched_at"),
    )


@query
def stage_row_counts(spark, sf_dir):
    """Every stage table written and read back; the queue is appended to twice."""
    base = shared_dir(spark, "stages")
    tables.write_raw_channels(V.raw_channels(spark, sf_dir), f"{base}/raw_channels")
    judged = _evaluated(spark, sf_dir)
    tables.write_creators(judged, f"{base}/creators")
    stored = tables.read_table(spark, f"{base}/creators", judged.schema)
    tables.write_shortlist(score.shortlist(stored), f"{base}/shortlist")
    ready = _ready(spark, sf_dir)
    found = drafts.first_valid(_checked(spark, sf_dir))
    tables.write_messages(
        drafts.messages(ready, found), drafts.run_summary(ready, found), f"{base}/messages"
    )
    for _ in range(2):
        queue = tables.read_optional(spark, f"{base}/dm_queue", DM_QUEUE)
        tables.append_dms(V.messages(spark, sf_dir), queue, f"{base}/dm_queue")
    counted = [
        spark.read.parquet(f"{base}/{name}").agg(
            F.lit(name).alias("table_name"), F.count("*").alias("rows")
        )
        for name in ("raw_channels", "creators", "shortlist", "messages", "dm_queue")
    ]
    return reduce(DataFrame.unionByName, counted)


# Rules --------------------------------------------------------------------------------------


@query
def rule_gates(spark, sf_dir):
    rules = TEST_SETTINGS.rules
    return _creators(spark, sf_dir).select(
        "id",
        score.followers_ok(rules).alias("followers_ok"),
        score.engagement_ok(rules).alias("engagement_ok"),
    )


@query
def keyword_evidence(spark, sf_dir):
    found = score.niche_evidence(TEST_SETTINGS.rules)
    return _creators(spark, sf_dir).select("id", F.array_join(found, ", ").alias("hits"))


@query
def many_keywords(spark, sf_dir):
    """Of 420 overlapping keywords those that each document holds, in one pass over its text."""
    found = text.keyword_hits(F.col("text"), V.SYLLABLES)
    return V.table(spark, sf_dir, "documents").select("doc_id", F.array_join(found, ", ").alias("hits"))


@query
def activity_age(spark, sf_dir):
    age = values.days_since(F.col("last_upload"), AS_OF)
    return _creators(spark, sf_dir).select(
        "id",
        age.alias("upload_age"),
        F.coalesce(age > TEST_SETTINGS.rules.max_upload_age_days, F.lit(False)).alias("too_old"),
        age.isNull().alias("unknown"),
    )


@query
def locale_gate(spark, sf_dir):
    records = V.channels(spark, sf_dir).withColumn("language", enrich.spoken_language())
    return records.select(
        "channel_id",
        score.country_conflict(LOCAL_SETTINGS.discovery).alias("country_conflict"),
        score.language_conflict(LOCAL_SETTINGS.discovery).alias("language_conflict"),
    )


@query
def reasons_status(spark, sf_dir):
    return _evaluated(spark, sf_dir, LOCAL_SETTINGS).select(
        "id", "status", F.array_join("fail_reasons", "; ").alias("fail_reasons")
    )


@query
def brand_fit(spark, sf_dir):
    return _evaluated(spark, sf_dir).select("id", "brand_fit_score")


@query
def shortlist(spark, sf_dir):
    return score.shortlist(_evaluated(spark, sf_dir, LOCAL_SETTINGS)).select(whole("rank"), "id", "status", "brand_fit_score")


@query
def status_counts(spark, sf_dir):
    return score.status_counts(_evaluated(spark, sf_dir))


@query
def reason_histogram(spark, sf_dir):
    return score.reason_histogram(_evaluated(spark, sf_dir, LOCAL_SETTINGS))


# Drafts -------------------------------------------------------------------------------------


@query
def angles(spark, sf_dir):
    angle = drafts.collaboration_angle(TEST_SETTINGS.angles)
    return drafts.eligible(_evaluated(spark, sf_dir)).select("id", angle.alias("collab_angle"))


@query
def prompts(spark, sf_dir):
    return drafts.prompts(
        _evaluated(spark, sf_dir), TEMPLATE, TEST_SETTINGS.angles, TEST_SETTINGS.brand
    ).select("id", "prompt")


@query
def word_counts(spark, sf_dir):
    return V.table(spark, sf_dir, "documents").select(
        "doc_id", text.word_count(F.col("text")).cast("bigint").alias("words")
    )


@query
def draft_parse(spark, sf_dir):
    parsed = drafts.parse_response(F.col("response"))
    return V.draft_attempts(spark, sf_dir).select(
        "creator_id", whole("attempt"), parsed.alias("draft")
    ).select("creator_id", "attempt", "draft.*")


@query
def draft_validity(spark, sf_dir):
    return _checked(spark, sf_dir).select(
        "creator_id", whole("attempt"),
        text.word_count(F.col("draft.email")).cast("bigint").alias("email_words"),
        text.word_count(F.col("draft.dm")).cast("bigint").alias("dm_words"),
        F.array_join("problems", "; ").alias("problems"), "valid",
    )


def _ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drafts.eligible(V.draft_creators(spark, sf_dir)).withColumn(
        "collab_angle", F.lit(TEST_SETTINGS.angles.default)
    )


@query
def first_valid_draft(spark, sf_dir):
    found = drafts.first_valid(_checked(spark, sf_dir))
    return drafts.messages(_ready(spark, sf_dir), found)


@query
def creators_without_draft(spark, sf_dir):
    found = drafts.first_valid(_checked(spark, sf_dir))
    return drafts.without_draft(_ready(spark, sf_dir), found).select("id", "name")


@query
def run_summary(spark, sf_dir):
    return drafts.run_summary(
        _ready(spark, sf_dir), drafts.first_valid(_checked(spark, sf_dir))
    )


@query
def retry_prompts(spark, sf_dir):
    first = _ready(spark, sf_dir).select(
        "id", drafts.render("Write to {name}.", {"name": F.col("name")}).alias("prompt")
    )
    return drafts.retry_prompts(
        first, _checked(spark, sf_dir), SUFFIX, TEST_SETTINGS.drafts
    ).select("creator_id", whole("next_attempt"), "prompt")


@query
def failure_classes(spark, sf_dir):
    return drafts.failure_classes(V.draft_attempts(spark, sf_dir))


@query
def retry_schedule(spark, sf_dir):
    return drafts.retry_schedule(
        V.draft_attempts(spark, sf_dir), TEST_SETTINGS.drafts
    ).select(
        "creator_id", whole("attempt"), "failure", rounded("delay_seconds"),
        F.unix_millis("next_try_at").alias("next_try_ms"),
    )


# Contact planning ---------------------------------------------------------------------------


def _contact_plan(spark: SparkSession, sf_dir: str, live: bool) -> DataFrame:
    return contact.plan_contacts(V.messages(spark, sf_dir), V.contact_log(spark, sf_dir), live)


@query
def contact_plan_dry(spark, sf_dir):
    return _contact_plan(spark, sf_dir, live=False).select("pos", "email_key", "status")


@query
def contact_plan_live(spark, sf_dir):
    return _contact_plan(spark, sf_dir, live=True).select("pos", "email_key", "status")


@query
def contact_plan_keys(spark, sf_dir):
    """The live plan against key tables of the log, of which only the buckets of the messages are read."""
    base = shared_dir(spark, "contact-keys")
    V.contact_log(spark, sf_dir).write.parquet(f"{base}/contact_log/run=old")
    plan = stages.plan_run(spark, base, "run", V.messages(spark, sf_dir), live=True)
    return plan.select("pos", "email_key", "status")


@query
def contact_first_run(spark, sf_dir):
    """No log exists yet."""
    log = tables.read_optional(spark, shared_dir(spark, "no-log-yet"), CONTACT_LOG)
    return contact.plan_contacts(V.messages(spark, sf_dir), log).select("pos", "status")


@query
def outcome_log(spark, sf_dir):
    plan = _contact_plan(spark, sf_dir, live=True)
    rows = contact.log_rows(contact.merge_outcomes(plan, V.outcomes(plan)), RUN_AT)
    return rows.withColumn("date", clock(F.col("date")))


@query
def log_after_two_runs(spark, sf_dir):
    """The same messages planned twice against a log that is only appended to."""
    path = shared_dir(spark, "contact-log")
    batch = V.messages(spark, sf_dir)
    for run_at in (RUN_AT, RERUN_AT):
        log = tables.read_optional(spark, path, CONTACT_LOG)
        tables.append_log(contact.plan_contacts(batch, log), run_at, path)
    log = tables.read_table(spark, path, CONTACT_LOG)
    return log.select(
        "influencer_id", "email", clock(F.col("date")).alias("date"), "status", "sent"
    )


@query
def contact_two_runs(spark, sf_dir):
    """Three live runs over overlapping messages: the second is planned while the first is open, the third when the
    first is settled and the second is not."""
    base = shared_dir(spark, "open-runs")
    V.contact_log(spark, sf_dir).write.parquet(f"{base}/contact_log/run=old")
    batch, plans = V.messages(spark, sf_dir), []
    for run, part in (("first", F.col("pos") % 3 == 0), ("second", F.col("pos") % 2 == 0), ("third", F.lit(True))):
        if run == "third":
            stages.settled(spark, base, "first", RUN_AT, V.outcomes(plans[0]))
        plans.append(stages.plan_run(spark, base, run, batch.where(part), live=True))
    told = [p.select(F.lit(r).alias("run"), "pos", "email_key", "status") for r, p in zip(("first", "second", "third"), plans)]
    return reduce(DataFrame.unionByName, told)


@query
def dm_queue(spark, sf_dir):
    return contact.dm_queue(V.messages(spark, sf_dir), V.old_queue(spark, sf_dir))


@query
def tracking(spark, sf_dir):
    plan = _contact_plan(spark, sf_dir, live=True)
    rows = contact.log_rows(contact.merge_outcomes(plan, V.outcomes(plan)), RUN_AT)
    old = V.contact_log(spark, sf_dir).select("date", "status", "email")
    report = contact.tracking(old.unionByName(rows.select("date", "status", "email")))
    return report.select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), "status", "level", "attempts", "contacts"
    )


@query
def tracking_partials(spark, sf_dir):
    """The same report from the partials of two runs, the second of them counted twice."""
    base = shared_dir(spark, "partials")
    plan = _contact_plan(spark, sf_dir, live=True)
    rows = contact.log_rows(contact.merge_outcomes(plan, V.outcomes(plan)), RUN_AT)
    stages.count_run(V.contact_log(spark, sf_dir), base, "old")
    for _ in range(2):
        stages.count_run(rows, base, "new")
    return stages.tracked(spark, base).select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), "status", "level", "attempts", "contacts"
    )


# Quality ------------------------------------------------------------------------------------


@query
def quality_report(spark, sf_dir):
    """All checks over stored tables in which some rows are wrong: a torn line, a placeholder in messages, a repeated
    send, a made-up address, lost creators."""
    raw = V.raw_channels(spark, sf_dir)
    judged = _stored(spark, _evaluated(spark, sf_dir), "creators")
    number = F.substring("id", 3, 20).cast("bigint")
    made_up = judged.withColumn(
        "email", F.when(F.col("email").isNotNull() & (number % 97 == 0), "made@up.test").otherwise(F.col("email"))
    )
    found = drafts.first_valid(_checked(spark, sf_dir))
    written = _stored(spark, drafts.messages(_ready(spark, sf_dir), found), "messages")
    marked = written.withColumn(
        "dm", F.when(F.col("pos") % 2 == 0, F.concat("dm", F.lit("YOUR_BRAND"))).otherwise(F.col("dm"))
    )
    plan = _stored(spark, _contact_plan(spark, sf_dir, live=True), "plan")
    log = contact.log_rows(contact.merge_outcomes(plan, V.outcomes(plan)), RUN_AT)
    again = log.where(F.col("influencer_id").cast("bigint") % 17 == 0)
    return quality.quality_report(
        quality.landing_checks(landing.torn_lines(spark, _land_pages(spark, sf_dir))),
        quality.record_checks(raw, judged),
        quality.message_checks(marked, TEST_SETTINGS.drafts, TEST_SETTINGS.brand),
        quality.log_checks(log.unionByName(again)),
        quality.email_checks(made_up, V.channels(spark, sf_dir)),
        quality.completeness_check(raw, judged.where(number % 200 != 0), "channel_id", "id", "no creator lost"),
    )


# Streaming ----------------------------------------------------------------------------------


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = V.table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


@query
def stream_first_seen(spark, sf_dir):
    """Hits in three landings whose fetch times go back by months: the last landing repeats creators that the state
    has forgotten by then, so only the key table knows them."""
    base = shared_dir(spark, "stream-raw")
    hits = V.hits(spark, sf_dir).drop("value")
    part = F.pmod(F.xxhash64("channel_id", "item_idx"), F.lit(3))
    for i in (2, 1, 0):
        hits.where(part == i).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(hits.schema).parquet(f"{base}/in")
        jobs.new_channels(stream, f"{base}/out", f"{base}/state", timedelta(seconds=1)).awaitTermination()
    return spark.read.schema(RAW_CHANNELS).parquet(f"{base}/out").select("channel_id")


@query
def stream_contact(spark, sf_dir):
    out, checkpoint = shared_dir(spark, "stream-log"), shared_dir(spark, "stream-state")
    messages = V.customer_messages(_stream(spark, sf_dir, "customer"))
    log = V.contact_log(spark, sf_dir)
    jobs.contact_log(messages, log, out, checkpoint, RUN_AT).awaitTermination()
    return tables.read_table(spark, out, CONTACT_LOG).select(
        "influencer_id", "email", "email_subject", "status"
    )


@query
def stream_outcomes(spark, sf_dir):
    """Messages and delivery outcomes in three landings: a third of the messages lands later, outcomes are told
    twice, come after the deadline of two days, or never."""
    base = shared_dir(spark, "stream-attempts")
    log, batch = V.contact_log(spark, sf_dir), V.messages(spark, sf_dir)
    early = batch.where(F.col("pos") % 3 != 0)
    plan = _stored(spark, contact.plan_contacts(early, log, live=True), "plan")
    told = V.outcomes(plan).join(plan.select("pos", "email"), "pos").select("email", "pos", "error", "told_at")
    last = plan.where((F.col("status") == contact.PLANNED) & (F.col("pos") % 22 == 0)).select(
        "email", "pos", F.lit(None).cast("string").alias("error"), F.lit("2024-02-01 11:00:00").cast("timestamp").alias("told_at")
    )
    landings = (
        ("2024-02-01 08:00:00", early, told.limit(0)),
        ("2024-02-01 12:00:00", batch.where(F.col("pos") % 3 == 0), told),
        # The outcomes of the second landing are told once more.
        ("2024-02-05 00:00:00", batch.limit(0), last.unionByName(told)),
    )
    for at, messages, outcomes in landings:
        when = F.lit(at).cast("timestamp")
        messages, outcomes = (x.withColumn("landed_at", when) for x in (messages, outcomes))
        messages.write.mode("append").parquet(f"{base}/messages")
        outcomes.write.mode("append").parquet(f"{base}/outcomes")
        read = (spark.readStream.schema(x.schema).parquet(f"{base}/{n}") for x, n in ((messages, "messages"), (outcomes, "outcomes")))
        changes = attempts.attempt_changes(*read, log, timedelta(days=2))
        attempts.run_attempts(changes, f"{base}/attempts", f"{base}/state").awaitTermination()
    return attempts.attempts(spark, f"{base}/attempts")


@query
def stream_quota(spark, sf_dir):
    """Requests in three landings, in each of which a third of every day arrives: the later ones are days late, when
    the days are closed."""
    base = shared_dir(spark, "stream-quota")
    requests = V.requests(V.events(spark, sf_dir).withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(3))))
    last = requests.agg(F.max("requested_at")).first()[0]
    for i in range(3):
        at = F.lit(last + timedelta(days=3 * i)).cast("timestamp")
        landed = requests.where(F.col("part") == i).withColumn("landed_at", at)
        landed.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(landed.schema).parquet(f"{base}/in")
        jobs.daily_quota(stream, f"{base}/out", f"{base}/state").awaitTermination()
    days = jobs.quota_totals(spark, f"{base}/out")
    return days.select(clock(F.col("day")).alias("day"), "requests", "units", "over_quota", "closed")


@query
def stream_dm_queue(spark, sf_dir):
    out, checkpoint = shared_dir(spark, "stream-queue"), shared_dir(spark, "stream-state")
    messages = V.customer_messages(_stream(spark, sf_dir, "customer"))
    jobs.dm_queue(messages, V.old_queue(spark, sf_dir), out, checkpoint).awaitTermination()
    return tables.read_table(spark, out, DM_QUEUE).select(*DM_QUEUE.fieldNames())
