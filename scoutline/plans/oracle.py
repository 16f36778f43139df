"""SQL counterparts of the catalog, written from the rules and not from the Spark code.

Common table expressions are joined in front of each query; the texts use global windows and
joined texts where the Spark plans avoid them.
"""

from __future__ import annotations

_WS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
_MAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
_BAD = "('example.com', 'domain.com', 'email.com')"
_AS_OF = "timestamp '2001-08-01 12:00:00'"


def _first_mail(text: str) -> str:
    return f"""lower(list_filter(
        list_transform(regexp_extract_all({text}, '{_MAIL}'), lambda x: trim(x, '.,;:')),
        lambda x: regexp_full_match(x, '{_MAIL}')
            and lower(split_part(x, '@', -1)) not in {_BAD})[1])"""


def _stamp(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%d %H:%M:%S')"


def _words(text: str) -> str:
    return f"len(regexp_extract_all({text}, '[^{_WS}]+'))"


def _sha(text: str) -> str:
    return f"substring(sha256({text}), 1, 24)"


_HITS = """hits as (
  select *, user_id + 40 * k as n, (k * 2 + y) * 1099511627776 + pg * 1024 + it as pos
  from (select event_id, user_id, ts, value, event_type as keyword,
               case event_type when 'click' then 0 when 'error' then 1 when 'purchase' then 2
                               when 'signup' then 3 when 'view' then 4 end as k,
               event_id % 2 as y, event_id // 100 as pg, (event_id % 100) // 2 as it
        from events) e)"""

_FIRST = """firsts as (
  select * from (select *, row_number() over (partition by n order by k, y, pg, it) as seen
                 from hits) h where seen = 1)"""

_LISTED = """listed as (
  select *, row_number() over (partition by k, y, pg order by event_id) - 1 as place,
         (k = 1 and y = 0 and pg = 7) or (k = 3 and y = 1 and pg = 40) as failed,
         case when not (k = 4 and y = 1 and pg = 60) then 'p' || (pg + 1) end as token
  from hits where not (k = 2 and y = 0 and pg = 20)),
 places as (select distinct k, y, pg, failed, token from listed),
 ends as (
  select k, y, min(case when failed or (pg > 0 and before is distinct from pg - 1) then pg
                        when token is null then pg + 1 end) as stop
  from (select *, lag(pg) over (partition by k, y order by pg) as before from places) p
  group by k, y)"""

_TEXT = """texts as (
  select c_custkey as ck, concat('Biz: ', replace(c_name, '#', '.'), '@',
     case when c_custkey % 7 = 0 then 'example.com' when c_custkey % 5 = 0 then 'No_Host'
          else concat(c_mktsegment, '.test') end, '. ',
     case when c_custkey % 3 = 0
          then concat('(https://www.Instagram.com/u', c_custkey, ') ') else '' end,
     case when c_custkey % 6 = 0
          then concat('https://instagram.com/b', c_custkey, '. ') else '' end,
     case when c_custkey % 4 = 0
          then 'https://www.youtube.com/x, https://youtu.be/y ' else '' end,
     case when c_custkey % 5 = 1
          then concat('http://shop', c_custkey, '.test:8080/a?b=1;') else '' end,
     case when c_custkey % 11 = 0 then 'alt@second.org' else '' end) as txt
  from customer)"""

_URLS = """urls as (
  select ck, url, i,
         regexp_replace(lower(regexp_extract(url, '^https?://([^/?#]*)', 1)), '^www\\.', '') as host
  from (select ck, unnest(found) as url, generate_subscripts(found, 1) as i
        from (select ck, list_transform(regexp_extract_all(txt, 'https?://[^\\s<>\\]\\[()]+'),
                                        lambda x: rtrim(x, '.,;:)')) as found from texts) a) b),
 insta as (select ck, min(i) as at_i, arg_min(url, i) as instagram
           from urls where host = 'instagram.com' group by ck),
 sites as (select u.ck, arg_min(url, i) as website
           from urls u left join insta g on g.ck = u.ck
           where u.i is distinct from g.at_i and host <> ''
             and not ends_with(host, 'youtube.com') and not ends_with(host, 'youtu.be')
           group by u.ck)"""

_UPLOADS = """listed_orders as (
  select o_custkey as ck, o_orderkey as ok, o_orderdate as od from orders
  union all select o_custkey + 1, o_orderkey, o_orderdate from orders where o_orderkey % 50 = 0),
 uploads as (
  select * from (select ck, ok, od,
                        row_number() over (partition by ck order by od desc, ok desc) as place
                 from listed_orders) o where place <= 10)"""

_VIDEOS = """vids as (
  select ok, views, likes, comments, a.p_name as title,
         concat(a.p_name, ' ', z.p_name, ' ', a.p_type, ' ', a.p_brand) as vtext
  from (select l_orderkey as ok,
               case when l_orderkey % 17 = 0 then 0 when l_orderkey % 41 = 0 then null
                    else cast(sum(l_quantity) * 10 as bigint) end as views,
               count(*) as likes,
               case when l_orderkey % 19 = 0 then null
                    else sum(case when l_returnflag = 'R' then 1 else 0 end) end as comments,
               min(l_partkey) as lo, max(l_partkey) as hi
        from lineitem group by l_orderkey) v
  join part a on a.p_partkey = lo join part z on z.p_partkey = hi)"""

_METRICS = """metrics as (
  select ck, avg(views) as avg_views,
         avg(case when views <> 0 and comments is not null then (likes + comments) / views end)
           as rate,
         string_agg(title, '|' order by place) as titles,
         string_agg(title, '", "' order by place) as stored_titles,
         string_agg(vtext, ' ' order by place) as vtext,
         arg_min(od, place) as last_upload
  from uploads join vids using (ok) group by ck)"""

_CHANNELS = """chans as (
  select c_custkey as ck, 'UC' || c_custkey as id, c_name, c_mktsegment, c_acctbal, n_name,
         case when c_custkey % 23 = 0 then 'n/a' when c_custkey % 29 = 0 then ''
              when c_custkey % 31 = 0 then '1.5'
              else cast(cast(floor((c_acctbal + 1000) * 10) as bigint) as varchar) end as subs,
         case when c_custkey % 13 = 0 then case when c_nationkey % 2 = 0 then 'en' end
              when c_custkey % 9 = 0 then 'fr' else 'en' end as lang,
         c_custkey % 37 <> 0 as good
  from customer join nation on c_nationkey = n_nationkey)"""

_COUNT = "try_cast(case when subs = '1.5' then null else subs end as bigint)"


def _niche(text: str, words: tuple[str, ...]) -> str:
    cases = ", ".join(
        f"case when contains(lower({text}), '{w.lower()}') then '{w}' end" for w in words
    )
    return f"concat_ws(', ', {cases})"


_NICHE = ("red", "bolt", "gear")

_CREATORS = f"""creators as (
  select ck, id, good, case when good then c_name else 'Raw ' || ck end as name,
         case when good then {_COUNT} end as followers,
         case when good then avg_views end as avg_views, case when good then rate end as rate,
         case when good then nullif({_niche("txt || ' ' || coalesce(vtext, '')", _NICHE)}, '')
              end as niche,
         case when good then coalesce(titles, '') else '' end as titles,
         case when good then coalesce(stored_titles, '') else '' end as stored_titles,
         case when good then {_first_mail("txt")} end as email,
         case when good then instagram end as instagram,
         case when good then website end as website,
         case when good then n_name end as country, case when good then lang end as lang,
         case when good then last_upload end as last_upload, c_mktsegment as source
  from chans join texts using (ck) left join insta using (ck) left join sites using (ck)
       left join metrics using (ck)),
 measured as (
  select *, len(list_filter(['red', 'bolt', 'gear'], lambda w: contains(lower(
              concat(coalesce(niche, ''), ' ', coalesce(niche, ''), ' ', stored_titles)), w)))
              as hits,
         case when last_upload is not null
              then greatest(0, date_sub('day', last_upload, {_AS_OF})) end as upload_age
  from (select * from creators) c)"""

_PARTS = (_TEXT, _URLS, _UPLOADS, _VIDEOS, _METRICS, _CHANNELS, _CREATORS)


def _judged(country: str | None) -> str:
    country_rule = (
        f"case when country <> '{country}' then 'country does not match configured region' end"
        if country
        else "cast(null as varchar)"
    )
    return f"""judged as (
  select *, case when reasons <> '' then 'FAIL' when email is null then 'PASS_NO_EMAIL'
                 else 'PASS' end as status,
         round((case when followers between 5000 and 100000 then 1.0::double else 0 end * 0.2::double
              + case when rate is null then 0::double
                     else least(1.0::double, rate / 0.02::double) end * 0.35::double
              + least(1.0::double, hits / 2.0::double) * 0.25::double
              + case when upload_age is null then 0::double
                     else greatest(0::double, 1.0::double - upload_age / 400.0::double) end
                * 0.2::double) * 100, 2) as score
  from (select *, concat_ws('; ',
      case when coalesce(followers between 5000 and 100000, false) then null
           else 'followers outside configured range or unavailable' end,
      case when coalesce(rate >= 0.005::double, false) then null
           else 'engagement rate below threshold or unavailable' end,
      case when hits < 2 then 'insufficient fashion/beauty keyword matches' end,
      case when upload_age > 400
           then 'last upload is older than configured activity window' end,
      case when upload_age is null then 'last upload date unavailable' end,
      {country_rule},
      case when lang <> 'en' then 'language does not match configured language' end) as reasons
    from measured) m)"""


_ATTEMPTS = f"""attempts as (
  select conv_id, attempt, (conv_id + attempt) % 23 between 1 and 9 as failed,
         (conv_id + attempt) % 23 as e,
         case when conv_id % 5 = 0 then '' else {{trim}}(subject) end as subject,
         case when conv_id % 5 = 0 then '' else {{trim}}(email) end as email,
         case when conv_id % 5 = 0 then '' else {{trim}}(coalesce(dm, '')) end as dm
  from (select t.conv_id, (t.turn + 1) // 2 as attempt,
               regexp_extract(t.text, '^[^.\\n]*', 0) as subject, t.text as email, p.text as dm
        from conversations t
        left join conversations p on p.conv_id = t.conv_id and p.turn = t.turn - 1
        where t.role = 'assistant') a),
 checked as (
  select *, concat_ws('; ', case when subject = '' then 'subject missing' end,
      case when {_words("subject")} > 8 then 'subject too long' end,
      case when {_words("email")} not between 60 and 200 then 'email length' end,
      case when {_words("dm")} not between 15 and 50 then 'dm length' end) as problems
  from (select *, row_number() over (partition by conv_id order by attempt) as draft_no
        from attempts where not failed) a where draft_no <= 3)""".replace("{trim}", "trim")

_ERRORS = """errors as (
  select conv_id, (turn + 1) // 2 as attempt, (conv_id + (turn + 1) // 2) % 23 as e
  from conversations where role = 'assistant'),
 classed as (
  select *, case e when 1 then 'transient' when 2 then 'transient' when 3 then 'row'
                   when 4 then 'fatal' when 5 then 'other' when 6 then 'transient'
                   when 7 then 'fatal' when 8 then 'transient' when 9 then 'transient' end as failure
  from errors),
 called as (
  select *, row_number() over (partition by conv_id, answers order by attempt) as call_no
  from (select *, coalesce(sum(case when failure is null then 1 else 0 end) over (
          partition by conv_id order by attempt rows between unbounded preceding and 1 preceding), 0)
          as answers from classed) c)"""

_READY = """ready as (
  select cast(c_custkey as varchar) as id, c_custkey as pos, c_name as name,
         case when c_custkey % 3 <> 0 then concat('c', c_custkey, '@mail.test') end as email
  from customer where c_acctbal >= 0),
 drafted as (
  select cast(conv_id as varchar) as id, arg_min(subject, attempt) as subject,
         arg_min(email, attempt) as body, arg_min(dm, attempt) as dm
  from checked where problems = '' group by conv_id)"""

_MESSAGES = f"""msgs as (
  select c_custkey as pos, cast(c_custkey % 1200 as varchar) as influencer_id,
         c_name as influencer,
         case when c_custkey % 10 = 3 then 'Not Found'
              when c_custkey % 10 = 4 then concat('x', c_custkey, '@example.com')
              when c_mktsegment = 'BUILDING' then ' Agency@Mail.test'
              when c_custkey % 4 = 0 then concat(' U', c_custkey % 700, '@Mail.test ')
              else concat('u', c_custkey % 700, '@mail.test') end as email,
         concat('Hello ', c_mktsegment) as subject, concat('Body ', c_name) as email_message,
         case when c_custkey % 6 = 0 then '' else concat('dm ', c_custkey) end as dm,
         c_custkey % 4 <> 2 and c_custkey % 9 <> 0 as approved
  from customer),
 good as (
  select *, lower(trim(email)) as email_key from msgs
  where approved and regexp_full_match(trim(email), '{_MAIL}')
    and lower(split_part(trim(email), '@', -1)) not in {_BAD}),
 oldlog as (
  select concat('u', s_suppkey, '@mail.test') as email_key,
         case when s_suppkey % 7 = 0 then null when s_suppkey % 4 = 0 then 'SIMULATED'
              when s_suppkey % 4 = 1 then 'SKIPPED_DUPLICATE'
              when s_suppkey % 4 = 2 then 'SENT_TO_TEST_INBOX' else 'FAILED' end as status
  from supplier),
 plan as (
  select *, row_number() over (partition by email_key order by pos) as nth,
         email_key in (select email_key from oldlog) as seen,
         email_key in (select email_key from oldlog
                       where status is null or status not in ('SIMULATED', 'SKIPPED_DUPLICATE'))
           as seen_live
  from good),
 settled as (
  select *, case when nth > 1 or seen_live then 'SKIPPED_DUPLICATE'
                 when pos % 11 = 0 then 'PLANNED' when pos % 13 = 0 then 'FAILED' else 'SENT_TO_TEST_INBOX' end as final
  from plan)"""


def _with(*parts: str, query: str) -> str:
    return "with " + ",\n ".join(parts) + "\n" + query


def _over_creators(query: str, country: str | None = None) -> str:
    return _with(*_PARTS, _judged(country), query=query)


def _over_videos(query: str) -> str:
    return _with(_UPLOADS, _VIDEOS, _METRICS, query=query)


def _escaped(text: str) -> str:
    return rf"""list_aggregate(list_transform(string_split({text}, ''), lambda c: case
        when c = '"' then '\"' when c = '\' then '\\' when c = chr(10) then '\n'
        when c = chr(13) then '\r' when c = chr(9) then '\t' when c = chr(8) then '\b'
        when c = chr(12) then '\f' when unicode(c) between 32 and 126 then c
        when unicode(c) < 65536 then printf('\u%04x', unicode(c))
        else printf('\u%04x\u%04x', 55296 + ((unicode(c) - 65536) >> 10),
                    56320 + ((unicode(c) - 65536) & 1023)) end), 'string_agg', '')"""


_PLAYLIST_REQUEST = _sha(
    """'{"endpoint": "playlistItems", "maxResults": 10, "part": "contentDetails", """
    """"playlistId": "UU' || c_custkey || '"}'"""
)
_REQUESTS = f"""asked as (
  select 'UC' || c_custkey as channel_id, 'playlistItems' as endpoint, c_custkey,
         {_PLAYLIST_REQUEST} as request_key
  from customer
  union all
  select 'UC' || ck, 'videos', ck,
         {_sha('''concat('{"endpoint": "videos", "id": "',
            string_agg('V' || ok, ',' order by place), '", "part": "snippet,statistics"}')''')}
  from uploads where ck in (select c_custkey from customer) group by ck)"""

_SEARCH_KEY = _sha(
    """concat('{"maxResults": 50, ',
        case when token = '' then '' else concat('"pageToken": "', token, '", ') end,
        '"part": "snippet", "q": "', keyword, '", "regionCode": "IN", ',
        '"relevanceLanguage": "en", "type": "', kind, '"}')"""
)


def oracle_sql() -> dict[str, str]:
    mail_ok = (
        f"regexp_full_match(trim(email), '{_MAIL}') "
        f"and lower(split_part(trim(email), '@', -1)) not in {_BAD}"
    )
    hit_rows = """select k as keyword_idx, y as type_idx, pg as page_idx, place as item_idx,
        'UC' || n as channel_id,
        case when value >= 2 then 'Channel ' || n when y = 0 then '' end as title
        from listed where value >= 1"""
    chain = """not exists (select 1 from ends e
        where e.k = listed.k and e.y = listed.y and e.stop <= listed.pg)"""
    creator_rows = f"""select id, name, followers, round(avg_views, 6) as avg_views,
        round(rate, 6) as engagement_rate, niche, titles, email, instagram as instagram_url,
        website, country, lang as language, {_stamp("last_upload")} as last_upload, source,
        '2001-08-01 00:00:00' as fetched_at from creators"""
    public = ("customer", "red", "bolt", "gear", "ECONOMY", "furniture")
    return {
        "flagship_shortlist": _over_creators(
            f"""select row_number() over (order by score desc, ck) as rank, id, name, followers,
                round(avg_views, 6) as avg_views, round(rate, 6) as engagement_rate, niche, email,
                {_stamp("last_upload")} as last_upload, status, score as brand_fit_score
                from judged where status <> 'FAIL'"""
        ),
        "search_plan": _with(
            _HITS, _LISTED,
            """asked as (select distinct k, y, keyword, token
                from listed where not failed and token is not null
                union all select distinct k, y, keyword, '' from
                (select k, keyword from hits group by all) a, (values (0), (1)) t(y)),
             named as (select *, case when y = 0 then 'channel' else 'video' end as kind
                from asked)""",
            query=f"""select keyword, kind as result_type, token as page_token,
                {_SEARCH_KEY} as request_key from named""",
        ),
        "request_plan": _with(
            _UPLOADS, _REQUESTS, query="select channel_id, endpoint, request_key from asked"
        ),
        "request_pending": _with(
            _UPLOADS, _REQUESTS,
            query="""select channel_id, endpoint, request_key
                from asked join customer using (c_custkey)
                where endpoint = 'videos' or c_acctbal < 0 or c_mktsegment = 'BUILDING'""",
        ),
        "request_pending_keys": _with(
            _UPLOADS, _REQUESTS,
            query="""select channel_id, endpoint, request_key
                from asked join customer using (c_custkey)
                where endpoint = 'videos' or c_acctbal < 0 or c_mktsegment = 'BUILDING'""",
        ),
        "page_chain": _with(
            _HITS, _LISTED,
            query=f"""select k as keyword_idx, y as type_idx, pg as page_idx, count(*) as items
                from listed where {chain} group by all""",
        ),
        "hits_exploded": _with(_HITS, _LISTED, query=hit_rows),
        "landed_hits": _with(
            _HITS, _LISTED, query=f"{hit_rows} and {chain} and not (k = 0 and y = 1 and pg >= 30)"
        ),
        "first_seen": _with(
            _HITS, _FIRST,
            query=f"""select 'UC' || n as channel_id, 'Channel ' || n as title,
                keyword as source_keyword, {_stamp("ts")} as fetched_at, pos from firsts""",
        ),
        "page_cap": _with(
            _HITS, _FIRST,
            """paged as (select k, y, pg, count(*) as c from firsts group by all),
             ahead as (select k, y, pg, coalesce(sum(c) over (order by k, y, pg
                rows between unbounded preceding and 1 preceding), 0) as before from paged)""",
            query="""select 'UC' || n as channel_id, keyword as source_keyword, pos
                from firsts join ahead using (k, y, pg) where before < 200""",
        ),
        "page_cap_open": _with(
            _HITS, _FIRST,
            query="select 'UC' || n as channel_id, keyword as source_keyword, pos from firsts",
        ),
        "keyword_yield": _with(
            _HITS, _FIRST,
            query="""select keyword, case when y = 0 then 'channel' else 'video' end as result_type,
                count(*) as hits, count(distinct n) as channels,
                (select count(*) from firsts f where f.k = h.k and f.y = h.y) as new_channels
                from hits h group by k, y, keyword""",
        ),
        "quota_daily": f"""select {_stamp("date_trunc('day', ts)")} as day, count(*) as requests,
            cast(sum(case when event_id % 2 = 0 then 100 else 1 end) as bigint) as units,
            sum(case when event_id % 2 = 0 then 100 else 1 end) > 10000 as over_quota
            from events group by date_trunc('day', ts)""",
        "id_batches": """with numbered as (
            select 'UC' || c_custkey as id, row_number() over (order by
              substring(sha256('UC' || c_custkey), 1, 3), 'UC' || c_custkey) - 1 as n from customer)
            , batched as (
              select n // 50 as batch, count(*) as ids, string_agg(id, ',' order by id) as id_list
              from numbered group by n // 50)
            select *, substring(sha256(concat('{"endpoint": "channels", "id": "', id_list,
              '", "part": "snippet,statistics,contentDetails"}')), 1, 24) as request_key
            from batched""",
        "channel_pending": """with numbered as (
            select 'UC' || c_custkey as id, row_number() over (order by
              substring(sha256('UC' || c_custkey), 1, 3), 'UC' || c_custkey) - 1 as n from customer where c_acctbal < 0)
            , batched as (
              select n // 50 as batch, count(*) as ids, string_agg(id, ',' order by id) as id_list
              from numbered group by n // 50)
            select *, substring(sha256(concat('{"endpoint": "channels", "id": "', id_list,
              '", "part": "snippet,statistics,contentDetails"}')), 1, 24) as request_key
            from batched""",
        "channel_left_join": _with(
            _CHANNELS,
            query=f"""select 'UC' || ck as id,
                case when c_acctbal < 0 or not good then 'Raw ' || ck
                     when c_mktsegment = 'BUILDING' then c_name || ' v2' else c_name end as name,
                case when c_acctbal >= 0 and good then {_COUNT} end as followers,
                case when c_acctbal >= 0 and good then n_name end as country,
                c_mktsegment as source, '2001-08-01 00:00:00' as fetched_at,
                case when c_acctbal < 0 then 'no channel record'
                     when not good then 'invalid country' end as enrich_error from chans""",
        ),
        "enrichment_summary": """select count(*) as total,
            count(*) filter (c_acctbal >= 0 and c_custkey % 37 <> 0) as enriched,
            count(*) filter (c_acctbal < 0) as not_returned,
            count(*) filter (c_acctbal >= 0 and c_custkey % 37 = 0) as invalid from customer""",
        "recent_uploads": _with(
            _UPLOADS,
            query="""select 'UU' || ck as playlist_id,
                cast(date_diff('day', cast(od as date), date '2100-01-01') as bigint)
                  * 1099511627776 - ok as item_idx, 'V' || ok as video_id from uploads""",
        ),
        "uploaded_videos": _over_videos(
            """select 'UU' || ck as playlist_id, 'V' || ok as video_id, title,
                strftime(od, '%Y-%m-%dT%H:%M:%SZ') as published_at
                from uploads join vids using (ok)"""
        ),
        "recent_titles": _over_videos("select 'UU' || ck as playlist_id, titles from metrics"),
        "last_upload": _over_videos(
            f"""select 'UU' || ck as playlist_id, {_stamp("arg_min(od, ok)")} as last_upload
                from uploads join vids using (ok) group by ck"""
        ),
        "avg_reactions": _over_videos(
            """select 'UU' || ck as playlist_id, round(avg(likes), 6) as avg_likes,
                round(avg(comments), 6) as avg_comments from uploads join vids using (ok) group by ck"""
        ),
        "avg_views": _over_videos(
            "select 'UU' || ck as playlist_id, round(avg_views, 6) as avg_views from metrics"
        ),
        "engagement": _over_videos(
            "select 'UU' || ck as playlist_id, round(rate, 6) as engagement_rate from metrics"
        ),
        "counts_parsed": _with(
            _CHANNELS,
            query=f"""select id as channel_id, {_COUNT} as followers,
                try_cast(nullif(subs, '') as double) as number from chans""",
        ),
        "public_text_hits": _with(
            _TEXT, _UPLOADS, _VIDEOS, _METRICS,
            query=f"""select 'UC' || ck as channel_id,
                {_niche("txt || ' ' || coalesce(vtext, '')", public)} as hits
                from texts left join metrics using (ck)""",
        ),
        "emails_found": _with(
            _TEXT,
            query=f"""select 'UC' || ck as channel_id, email,
                case when email is not null then 'channel description' end as email_source
                from (select ck, {_first_mail("txt")} as email from texts) t""",
        ),
        "emails_in_documents": f"select doc_id, {_first_mail('text')} as email from documents",
        "email_validity": _with(_MESSAGES, query=f"select pos, {mail_ok} as valid from msgs"),
        "links": _with(
            _TEXT, _URLS,
            query="""select 'UC' || ck as channel_id, instagram, website
                from texts left join insta using (ck) left join sites using (ck)""",
        ),
        "page_links": rf"""with found as (
            select page_id, list_transform(regexp_extract_all(concat(url, ' ', html),
                'https?://[^{_WS}<>\]\[()]+'), lambda x: rtrim(x, '.,;:)')) as urls from pages)
            select page_id, len(urls) as urls, urls[1] as first_url,
              regexp_replace(lower(regexp_extract(urls[1], '^https?://([^/?#]*)', 1)),
                             '^www\.', '') as first_host from found""",
        "locale_profile": _with(
            _CHANNELS,
            query="""select id as channel_id, 'https://www.youtube.com/channel/' || id
                as profile_url, lang as language from chans""",
        ),
        "titles_json": f"""select doc_id, concat('["', {_escaped("text")}, '", "', {_escaped(
            "concat('\"', lang, '\" \\ ☃ ', chr(128512))")}, '"]') as titles_json from documents""",
        "flat_file_creators": _over_creators(creator_rows),
        "landed_creators": _over_creators(creator_rows),
        "flat_file_contacts": _with(
            _MESSAGES,
            query="""select (select count(*) from customer c where c.c_custkey < plan.pos) as pos, influencer, email_key,
                case when nth > 1 or seen then 'SKIPPED_DUPLICATE' else 'SIMULATED' end as status
                from plan""",
        ),
        "stage_row_counts": _with(
            *_PARTS, _judged(None), _ATTEMPTS, _READY, _MESSAGES,
            query="""select 'raw_channels' as table_name, count(*) as rows from customer
                union all select 'creators', count(*) from creators
                union all select 'shortlist', count(*) from judged where status <> 'FAIL'
                union all select 'messages', count(*) from ready join drafted using (id)
                union all select 'dm_queue', count(distinct influencer_id) from msgs
                  where dm <> ''""",
        ),
        "rule_gates": _over_creators(
            """select id, coalesce(followers between 5000 and 100000, false) as followers_ok,
                coalesce(rate >= 0.005::double, false) as engagement_ok from creators"""
        ),
        "keyword_evidence": _over_creators(
            f"""select id, {_niche("concat(coalesce(niche, ''), ' ', stored_titles)", _NICHE)}
                as hits from creators"""
        ),
        "activity_age": _over_creators(
            """select id, upload_age, coalesce(upload_age > 400, false) as too_old,
                upload_age is null as unknown
                from measured"""
        ),
        "locale_gate": _with(
            _CHANNELS,
            query="""select id as channel_id, n_name <> 'NATION_3' as country_conflict,
                coalesce(lang <> 'en', false) as language_conflict from chans""",
        ),
        "reasons_status": _over_creators(
            "select id, status, reasons as fail_reasons from judged", "NATION_3"
        ),
        "brand_fit": _over_creators("select id, score as brand_fit_score from judged"),
        "shortlist": _over_creators(
            """select row_number() over (order by score desc, ck) as rank, id, status,
                score as brand_fit_score from judged where status <> 'FAIL'""",
            "NATION_3",
        ),
        "status_counts": _over_creators(
            "select status, count(*) as creators from judged group by status"
        ),
        "reason_histogram": _over_creators(
            """select reason, count(*) as creators from
                (select unnest(string_split(reasons, '; ')) as reason from judged
                 where reasons <> '') r group by reason""",
            "NATION_3",
        ),
        "angles": _over_creators(
            """select id, case when rate >= 0.010::double then 'user-generated content'
                when rate >= 0.006::double then 'affiliate partnership'
                when followers >= 50000 or avg_views >= 1000 then 'paid placement'
                else 'product seeding' end as collab_angle from judged where status <> 'FAIL'"""
        ),
        "prompts": _over_creators(
            """select id, concat('Write to ', name, ' on YouTube.', chr(10), 'Niche: ',
                coalesce(niche, 'Not Found'), '. Themes: ', coalesce(niche, 'Not Found'), '.',
                chr(10), 'Titles: ', coalesce(nullif(replace(titles, '|', '; '), ''), 'Not Found'),
                '.', chr(10), 'Brand YOUR_BRAND, YOUR_PRODUCT: ',
                case when rate >= 0.010::double then 'user-generated content'
                when rate >= 0.006::double then 'affiliate partnership'
                when followers >= 50000 or avg_views >= 1000 then 'paid placement'
                else 'product seeding' end,
                '. Free products plus a paid content partnership. Answer as {json}.') as prompt
                from judged where status <> 'FAIL'"""
        ),
        "word_counts": f"select doc_id, {_words('text')} as words from documents",
        "draft_parse": _with(
            _ATTEMPTS,
            query="""select cast(conv_id as varchar) as creator_id, attempt,
                case when failed and e <> 4 then '' else subject end as subject,
                case when failed and e <> 4 then '' else email end as email,
                case when failed and e <> 4 then '' else dm end as dm from attempts""",
        ),
        "draft_validity": _with(
            _ATTEMPTS,
            query=f"""select cast(conv_id as varchar) as creator_id, attempt,
                {_words("email")} as email_words, {_words("dm")} as dm_words, problems,
                problems = '' as valid from checked""",
        ),
        "first_valid_draft": _with(
            _ATTEMPTS, _READY,
            query="""select id as influencer_id, name as influencer, r.email, subject,
                body as email_message, dm, 'product seeding' as collab_angle,
                'PENDING_APPROVAL' as message_status, false as approved, pos
                from ready r join drafted d using (id)""",
        ),
        "creators_without_draft": _with(
            _ATTEMPTS, _READY,
            query="select id, name from ready where id not in (select id from drafted)",
        ),
        "run_summary": _with(
            _ATTEMPTS, _READY,
            query="""select eligible, found as drafted, eligible - found as failed,
                case when eligible = 0 then 'write empty table'
                     when found = 0 then 'fail without writing' else 'write drafts' end as outcome
                from (select count(*) as eligible, count(d.id) as found
                      from ready left join drafted d using (id)) c""",
        ),
        "retry_prompts": _with(
            _ATTEMPTS, _READY,
            query=f"""select cast(conv_id as varchar) as creator_id, count(*) + 1 as next_attempt,
                concat('Write to ', any_value(name), '.', chr(10), string_agg(concat('You wrote ',
                  {_words("checked.email")}, ' words of email and ', {_words("dm")},
                  ' words of DM.'), chr(10) order by attempt)) as prompt
                from checked join ready on id = cast(conv_id as varchar)
                group by conv_id
                having count(*) < 3 and count(*) filter (problems = '') = 0""",
        ),
        "failure_classes": _with(
            _ERRORS,
            query="""select failure, count(*) as attempts, failure = 'fatal' as abort
                from classed where failure is not null group by failure""",
        ),
        "retry_schedule": _with(
            _ERRORS,
            query="""select cast(conv_id as varchar) as creator_id, attempt, failure,
                delay as delay_seconds,
                cast(epoch_ms(timestamp '2024-01-01 00:00:00') + delay * 1000 as bigint)
                  as next_try_ms
                from (select *, case e when 1 then 2.5::double when 6 then 90::double
                                else pow(2.0::double, call_no - 1) end as delay from called
                      where failure in ('transient', 'row') and call_no < 3) c""",
        ),
        "contact_plan_dry": _with(
            _MESSAGES,
            query="""select pos, email_key, case when nth > 1 or seen then 'SKIPPED_DUPLICATE'
                else 'SIMULATED' end as status from plan""",
        ),
        "contact_plan_live": _with(
            _MESSAGES,
            query="""select pos, email_key, case when nth > 1 or seen_live
                then 'SKIPPED_DUPLICATE' else 'PLANNED' end as status from plan""",
        ),
        "contact_plan_keys": _with(
            _MESSAGES,
            query="""select pos, email_key, case when nth > 1 or seen_live
                then 'SKIPPED_DUPLICATE' else 'PLANNED' end as status from plan""",
        ),
        "contact_first_run": _with(
            _MESSAGES,
            query="""select pos, case when nth > 1 then 'SKIPPED_DUPLICATE' else 'SIMULATED' end
                as status from plan""",
        ),
        "outcome_log": _with(
            _MESSAGES,
            query="""select influencer_id, influencer, email, email_message as message_generated,
                subject as email_subject, final = 'SENT_TO_TEST_INBOX' as sent,
                '2024-02-01 00:00:00' as date, final as status,
                case when final = 'FAILED' then 'mailbox full' else '' end as error
                from settled""",
        ),
        "log_after_two_runs": _with(
            _MESSAGES,
            query="""select influencer_id, email, '2024-02-01 00:00:00' as date,
                case when nth > 1 then 'SKIPPED_DUPLICATE' else 'SIMULATED' end as status,
                false as sent from plan
                union all select influencer_id, email, '2024-02-02 00:00:00', 'SKIPPED_DUPLICATE',
                false from plan""",
        ),
        "contact_two_runs": _with(
            _MESSAGES,
            """first as (
              select *, seen_live or row_number() over (partition by email_key order by pos) > 1 as dup
              from plan where pos % 3 = 0),
             second as (
              select *, seen_live or row_number() over (partition by email_key order by pos) > 1
                or email_key in (select email_key from first where not dup) as dup
              from plan where pos % 2 = 0),
             third as (
              select *, seen_live or nth > 1 or email_key in (select email_key from first where not dup)
                or email_key in (select email_key from second where not dup) as dup
              from plan),
             runs as (
              select 'first' as run, pos, email_key, dup from first
              union all select 'second', pos, email_key, dup from second
              union all select 'third', pos, email_key, dup from third)""",
            query="""select run, pos, email_key, case when dup then 'SKIPPED_DUPLICATE' else 'PLANNED' end as status
                from runs""",
        ),
        "dm_queue": _with(
            _MESSAGES,
            query="""select cast(s_suppkey as varchar) as influencer_id, s_name as influencer,
                'old ' || s_suppkey as dm, 'PENDING_MANUAL' as status from supplier
                union all
                select influencer_id, arg_min(influencer, pos), arg_min(dm, pos), 'PENDING_MANUAL'
                from msgs where dm <> '' and influencer_id not in
                  (select cast(s_suppkey as varchar) from supplier) group by influencer_id""",
        ),
        "tracking": _with(
            _MESSAGES,
            query="""select day, status, case grouping(day, status) when 0 then 'status' when 1 then 'day'
                else 'all' end as level, count(*) as attempts, count(distinct email_key) as contacts
                from (select '2024-01-01' as day, status, email_key from oldlog
                      union all select '2024-02-01', final, email_key from settled) l
                group by rollup (day, status)""",
        ),
        "tracking_partials": _with(
            _MESSAGES,
            query="""select day, status, case grouping(day, status) when 0 then 'status' when 1 then 'day'
                else 'all' end as level, count(*) as attempts, count(distinct email_key) as contacts
                from (select '2024-01-01' as day, status, email_key from oldlog
                      union all select '2024-02-01', final, email_key from settled) l
                group by rollup (day, status)""",
        ),
        "many_keywords": """with part as (
              select x, i from (select unnest(string_split('th er an in re on at en nd ti es or te of ed is it al ar st', ' ')) as x,
                unnest(range(20)) as i) p),
             word as (select x, i as place from part
                      union all select a.x || b.x, 20 + 20 * a.i + b.i from part a, part b),
             found as (select doc_id, string_agg(x, ', ' order by place) as hits
                       from documents join word on contains(lower(text), x) group by doc_id)
             select doc_id, coalesce(hits, '') as hits from documents left join found using (doc_id)""",
        "quality_report": _with(
            *_PARTS, _judged(None), _ATTEMPTS, _READY, _MESSAGES, _HITS, _LISTED,
            query="""select *, failed_rows = 0 as ok from (
                select 'landed lines whole' as check_name,
                  count(*) filter (k = 0 and y = 1 and pg = 30) as failed_rows, count(*) as total_rows from places
                union all select 'enough raw records' as check_name,
                  greatest(0, 80 - count(*)) as failed_rows, count(*) as total_rows from customer
                union all select 'enough records', greatest(0, 50 - count(*)), count(*) from judged
                union all select 'source and time present',
                  count(*) filter (coalesce(source, '') = ''), count(*) from judged
                union all select 'status with reason',
                  count(*) filter (status = 'FAIL' and reasons = ''), count(*) from judged
                union all select 'messages within word limits',
                  count(*) filter (problems <> ''), count(*)
                  from (select min(problems) as problems from checked
                        where problems = '' and cast(conv_id as varchar) in (select id from ready)
                        group by conv_id) d
                union all select 'no placeholder in messages',
                  count(*) filter (contains(concat(subject, ' ', body, ' ', marked), 'YOUR_BRAND')
                    or contains(concat(subject, ' ', body, ' ', marked), 'YOUR_PRODUCT')), count(*)
                  from (select *, case when pos % 2 = 0 then dm || 'YOUR_BRAND' else dm end as marked
                        from ready join drafted using (id)) w
                union all select 'no duplicate send',
                  count(*) filter (n > 1), count(*) from (select count(*) as n from
                    (select * from settled
                     union all select * from settled where cast(influencer_id as bigint) % 17 = 0) l
                  where final = 'SENT_TO_TEST_INBOX' group by email_key) s
                union all select 'no invented address',
                  count(*) filter (not contains(lower(txt), kept)), count(*)
                  from (select *, case when ck % 97 = 0 then 'made@up.test' else judged.email end as kept
                        from judged join texts using (ck) where judged.email is not null) e
                union all select 'no creator lost',
                  count(*) filter ('UC' || c_custkey not in (select id from judged where ck % 200 <> 0)),
                  count(*) from customer) r""",
        ),
        "stream_first_seen": _with(
            _HITS, query="select distinct 'UC' || n as channel_id from hits"
        ),
        "stream_contact": _with(
            _MESSAGES,
            query="""select influencer_id, email, subject as email_subject,
                case when nth > 1 or seen then 'SKIPPED_DUPLICATE' else 'SIMULATED' end as status
                from plan""",
        ),
        "stream_outcomes": _with(
            _MESSAGES,
            query="""select email_key, pos,
                case when seen_live or turn > 1 then 'SKIPPED_DUPLICATE'
                     when pos % 3 = 0 or pos % 22 = 11 then 'FAILED' when pos % 11 = 0 then 'SENT_TO_TEST_INBOX'
                     when pos % 13 = 0 then 'FAILED' else 'SENT_TO_TEST_INBOX' end as status,
                case when seen_live or turn > 1 then ''
                     when pos % 3 = 0 or pos % 22 = 11 then 'no outcome before the deadline' when pos % 11 = 0 then ''
                     when pos % 13 = 0 then 'mailbox full' else '' end as error
                from (select *, row_number() over (partition by email_key order by pos % 3 = 0, pos) as turn
                      from plan) p""",
        ),
        "stream_quota": f"""select {_stamp("date_trunc('day', ts)")} as day, count(*) as requests,
            cast(sum(case when event_id % 2 = 0 then 100 else 1 end) as bigint) as units,
            sum(case when event_id % 2 = 0 then 100 else 1 end) > 10000 as over_quota, true as closed
            from events group by date_trunc('day', ts)""",
        "stream_dm_queue": _with(
            _MESSAGES,
            query="""select influencer_id, arg_min(influencer, pos) as influencer, arg_min(dm, pos) as dm,
                'PENDING_MANUAL' as status from msgs where dm <> '' and influencer_id not in
                  (select cast(s_suppkey as varchar) from supplier) group by influencer_id""",
        ),
    }
