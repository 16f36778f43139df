"""SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

from scoutline.llm.quality_rules import CANDIDATES, Risk, path

_SPACE = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
_NONE = "''"


def _gone(text: str, chars: str) -> str:
    return f"translate({text}, {chars}, {_NONE})"


def _quality_rules() -> str:
    risk = Risk()
    limit, rules = risk.limit, list(CANDIDATES)
    settings = ", ".join(
        f"({j}, " + ", ".join(f"{one[r]!r}::double" if r in one else "null::double" for r in rules) + ")" for j, one in enumerate(path())
    )
    share = lambda a, b: f"case when {b} = 0 then 0.0 else {a}::double / {b}::double end"
    return f"""
with docs as (select row_number() over () as r, doc_id, lang, coalesce(text, '') as text from documents),
word as (
  select r, unnest(w) as word, generate_subscripts(w, 1) as i
  from (select r, list_filter(regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') as w from docs)
),
win as (
  select r, i, word || ' ' || lead(word) over o || ' ' || lead(word, 2) over o as g
  from word window o as (partition by r order by i)
),
rep as (
  select r, i from (select r, i, count(*) over (partition by r, g) as n from win where g is not null) where n > 1
),
cov as (select r, count(distinct j) as n from (select r, unnest([i, i + 1, i + 2]) as j from rep) group by r),
lines as (
  select r, count(*) as n_lines, count(*) - count(distinct line) as n_dup
  from (select r, unnest(string_split(text, chr(10))) as line from docs)
  where length({_gone("line", _SPACE)}) > 0 group by r
),
nw as (select r, count(*) as n from word group by r),
counted as (
  select doc_id, lang, coalesce(nw.n, 0) as n_words, length({_gone("text", _SPACE)}) as word_chars,
    length(text) - length({_gone("text", "'#*$%&|<>'")}) as n_symbols, coalesce(n_dup, 0) as n_dup_lines,
    coalesce(n_lines, 0) as n_lines, coalesce(cov.n, 0) as n_repeat_words
  from docs left join nw using (r) left join cov using (r) left join lines using (r)
),
valued as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    {share("n_symbols", "word_chars")} as symbol_share, {share("n_dup_lines", "n_lines")} as dup_line_share,
    {share("n_repeat_words", "n_words")} as repeat_share, {share("word_chars", "n_words")} as mean_word_chars
  from counted
),
good as (select doc_id from labels group by doc_id having min(quality) = 1),
holdout as (select * from valued where not base_failed and doc_id in (select doc_id from good)),
cand(j, {", ".join(f"{r}_cut" for r in rules)}) as (values {settings}),
tested as (
  select lang, j, count(*) as n, count(*) filter ({" or ".join(f"coalesce({r} > {r}_cut, false)" for r in rules)}) as k
  from holdout, cand group by all
),
level as (select {risk.error!r} / count(distinct coalesce(lang, chr(0))) as a from holdout),
tail as (
  select lang, j,
    case when k > n * {limit!r} then 1.0 else list_sum(list_transform(generate_series(0, k), lambda i:
      exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({limit!r}) + (n - i) * ln(1 - {limit!r})))) end as p
  from tested
),
ended as (select lang, coalesce(min(j) filter (p > a), {len(path())}) - 1 as j from tail, level group by lang),
cut as (select lang, {", ".join(f"{r}_cut" for r in rules)} from ended join cand using (j))
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
  not (base_failed or {" or ".join(f"coalesce({r} > {r}_cut, false)" for r in CANDIDATES)}) as kept
from valued v left join cut c on v.lang is not distinct from c.lang
"""


_HOST = "translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_WARC = """
with p as (
  select page_id, url, encode(coalesce(html, '')) as body, sha1(coalesce(html, '')) as hex from pages
),
d as (
  select page_id, url, octet_length(body)::bigint as payload_bytes,
    array_to_string(list_transform(range(8), lambda g: (
      array_to_string(list_transform([15, 10, 5, 0], lambda s:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(hex, 1 + 5 * g, 5))::bigint >> s) & 31) + 1)::bigint, 1)), '')
    )), '') as payload_digest
  from p
),
f as (select *, min(page_id) over (partition by payload_digest, payload_bytes) as first_id from d),
r as (
  select *, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from f
),
k as (
  select *, array_to_string(list_reverse(string_split(%s, '.')), ',') || ')' ||
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) || regexp_extract(coalesce(url, ''), '^[^#?]*(\\?[^#]*)', 1) as url_key,
    strftime(timestamp '2024-01-01' + to_seconds(page_id), '%%Y-%%m-%%dT%%H:%%M:%%SZ') as date
  from r
)
select page_id, payload_bytes, payload_digest, case when first_id = page_id then 'response' else 'revisit' end as record_type,
  case when first_id <> page_id then first_id end as refers_to, url_key, date,
  row_number() over (order by url_key, date, page_id) - 1 as position
from k
""" % _HOST

_URL = """
with r as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages
),
h as (select page_id, %s as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from r),
rules(verdict, rule, rule_host, rule_path) as (values
  ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
  ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'),
  ('block', 'com/de/', 'com', '/de/')
),
best as (
  select page_id, max_by(rule, length(rule)) as rule, max_by(verdict, length(rule)) as verdict
  from h join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  group by page_id
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from h left join best using (page_id)
""" % _HOST

_PHRASES = """
with piece as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents
),
p as (select lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') as w from piece),
w1 as (select lang, x, count(*)::hugeint as f from (select lang, unnest(w) as x from p) group by all),
w2 as (
  select lang, x, y, count(*)::hugeint as f
  from (select lang, w[i] as x, w[i + 1] as y from (select lang, w, unnest(range(1, len(w))) as i from p)) group by all
),
w3 as (
  select lang, x, y, z, count(*)::hugeint as f
  from (
    select lang, w[i] as x, w[i + 1] as y, w[i + 2] as z from (select lang, w, unnest(range(1, len(w) - 1)) as i from p where len(w) > 2)
  )
  group by all having count(*) >= 10
),
two as (
  select c.lang, c.x || ' ' || c.y as phrase, c.f as a, [a.f, b.f] as lr
  from w2 c join w1 a using (lang, x) join w1 b on b.lang = c.lang and b.x = c.y
  left join (select lang, x, y, max(f) as f from w3 group by all) d on d.lang = c.lang and d.x = c.x and d.y = c.y
  left join (select lang, y, z, max(f) as f from w3 group by all) e on e.lang = c.lang and e.y = c.x and e.z = c.y
  where c.f >= 10 and 100 * greatest(coalesce(d.f, 0), coalesce(e.f, 0)) < 50 * c.f
),
three as (
  select c.lang, c.x || ' ' || c.y || ' ' || c.z as phrase, c.f as a,
    case when 1000000 * c.f * c.f // (a.f * d.f) <= 1000000 * c.f * c.f // (b.f * e.f) then [a.f, d.f] else [b.f, e.f] end as lr
  from w3 c join w1 a using (lang, x) join w2 d on d.lang = c.lang and d.x = c.y and d.y = c.z
  join w2 b on b.lang = c.lang and b.x = c.x and b.y = c.y join w1 e on e.lang = c.lang and e.x = c.z
),
scored as (
  select *, 1000000 * a * a // (lr[1] * lr[2]) as score from (select * from two union all select * from three)
),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from scored)
select r.lang, rank::bigint as rank, phrase, a::bigint as a, lr[1]::bigint as l, lr[2]::bigint as r, n::bigint as n, score::bigint as score
from ranked r join (select lang, sum(f) as n from w1 group by lang) using (lang) where rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": _quality_rules(),
        "op2_warc_index": _WARC,
        "op8_url_filters": _URL,
        "op12_collocations": _PHRASES,
    }
