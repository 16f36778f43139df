"""URL rules against a plain loop over all rules."""

import re

from pyspark.sql import functions as F

from scoutline.llm import url_filters as U
from scoutline.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/x", "https://example.org/en/1", "https://a.b.example.org/en/199?x#y",
    "https://example.org/en/2", "http://notexample.org/es/", "http://org", "http://org/", "http://x.com/fr/", "http://x.com/de",
    "http://x.com/de/q", "x://y://z.com/de/", "http://é.org/fr/", "http://a.org?b/es/", "http://a..org/", "http://com/fr/\n2", "http://a.com#/de/",
]


def plain(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    found = []
    for verdict, rule in rules:
        of, at = rule.split("/", 1)[0], rule[len(rule.split("/", 1)[0]) :]
        if (host == of or host.endswith("." + of)) and path.startswith(at):
            found.append((len(rule), len(of), verdict == "block", rule, verdict))
    best = max(found, default=None)
    return host, path, best[3] if best else None, best[4] if best else "allow"


def judged(spark, rules, urls=URLS):
    pages = spark.createDataFrame([(i, u, "old", i) for i, u in enumerate(urls)], "page_id long, url string, verdict string, extra long")
    rows = U.judge(pages, U.rule_table(spark, rules)).orderBy("page_id").collect()
    assert [r.extra for r in rows] == list(range(len(urls)))
    return [(r.host, r.path, r.rule, r.verdict) for r in rows]


def test_rules(spark):
    assert judged(spark, URL_RULES) == [plain(u, URL_RULES) for u in URLS]


def test_ties_and_repeats(spark):
    rules = [("allow", "x.com/d"), ("block", "com/de/"), ("allow", "com/de/"), ("allow", "com/de/"), ("block", "b.example.org/")]
    assert judged(spark, rules, URLS * 2) == [plain(u, rules) for u in URLS] * 2


def test_rules_without_a_host(spark):
    for rules in ([("block", ""), ("allow", "org/")], [("block", "/a"), ("allow", "x.com/")], [("allow", ""), ("block", "")]):
        urls = [*URLS, "http:///a/b", "http:///", "://"]
        assert judged(spark, rules, urls) == [plain(u, rules) for u in urls]


def test_clashing_columns_and_long_urls(spark):
    long = "http://" + "a." * 3_000 + "example.org/es/" + "x/" * 100_000
    rows = [(1, long, "h", "p", "r", 7), (2, None, "h", "p", "r", 8), (2, None, "h", "p", "r", 8)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, path string, rule string, kind int")
    got = U.judge(pages, U.rule_table(spark, URL_RULES)).orderBy("page_id").collect()
    assert [(r.page_id, r.kind, r.rule, r.verdict) for r in got] == [
        (1, 7, "example.org/es/", "block"), (2, 8, None, "allow"), (2, 8, None, "allow")]
    assert got[0].host == "a." * 3_000 + "example.org" and got[1].host == got[1].path == ""


def test_hot_urls_are_split(spark):
    """One URL on half of the rows and none on a third: with strict limits the join of the verdicts is dealt anew."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        url = F.when(F.col("id") % 6 < 3, "http://hot.example.org/es/x").when(F.col("id") % 6 < 5, F.lit(None)).otherwise(
            F.concat(F.lit("http://h"), "id", F.lit(".fr/")))
        pages = spark.range(60_000).repartition(8).select(F.col("id").alias("page_id"), url.alias("url"))
        judged = U.judge(pages, U.rule_table(spark, URL_RULES))
        assert judged.groupBy("verdict").count().orderBy("verdict").collect()[1]["count"] == 30_000
        judged.write.format("noop").mode("overwrite").save()
        frame = judged.select("page_id", "verdict")
        frame.collect()
        assert "skew=true" in frame._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_empty(spark):
    assert judged(spark, URL_RULES, []) == []
    assert {v for _, _, r, v in judged(spark, [])} == {"allow"}
