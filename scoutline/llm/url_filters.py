"""URL filters: host-suffix and path-prefix expressions, matched through short hashes.

Every URL is expanded into the expressions that a rule could be written as. Expressions and rules
meet in an equi-join on the first bits of their SHA-256, a match is confirmed by the whole digest,
and of all confirmed rules the longest decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoutline.session import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Hexadecimal digits of the short hash that expressions are joined on.
PREFIX_DIGITS = 8


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): the host follows the first ``://`` and ends before ``/``, ``?`` or ``#``, with
    A-Z lower-cased; the path goes on to ``?`` or ``#``. A NULL or a URL without ``://`` has neither."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Rules (verdict, text like ``example.org/en/``) as a table; the host ends before the first ``/``."""
    rows = spark.createDataFrame(list(rules), "verdict string, rule string")
    return rows.select(
        "rule",
        "verdict",
        F.translate(F.regexp_extract("rule", r"^([^/]*)", 1), UPPER, LOWER).alias("rule_host"),
        F.regexp_extract("rule", r"^[^/]*((?s).*)$", 1).alias("rule_path"),
    )


def _digest(host: Column, path: Column) -> Column:
    # A host holds no "/" and a path is empty or starts with it, so the parts can't be confused.
    return F.sha2(F.concat(host, path).cast("binary"), 256)


def _expressions(host: Column, path: Column, lengths: Sequence[int], labels: int) -> Column:
    """Structs (host, path) of all host suffixes of at most ``labels`` labels with the path's
    prefixes of the given lengths. No rule has other lengths, so none is missed."""
    parts = F.split(host, r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.lit(labels), F.size(parts))),
        lambda n: F.array_join(F.slice(parts, -n, n), "."),
    )
    cuts = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    return F.flatten(
        F.transform(
            suffixes,
            lambda s: F.transform(
                cuts, lambda n: F.struct(s.alias("h"), F.substring(path, F.lit(1), n).alias("p"))
            ),
        )
    )


def judge(pages: DataFrame, rules: DataFrame, *, url: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row; columns of these names are replaced.

    A rule fits its host and all subdomains if the path starts with the rule's path. The longest
    rule text wins; of equally long ones that with the longer host, then ``block`` over ``allow``,
    then the greater text. Without a rule the verdict is ``default`` and ``rule`` is NULL. NULL and
    malformed URLs have empty host and path and fit only a rule with an empty host. Repeated rows
    are judged once and all returned. The rule lengths are fetched to the driver: a few numbers.
    """
    rank = F.struct(
        F.length("rule").alias("length"),
        F.length("rule_host").alias("host_length"),
        (F.col("verdict") == "block").alias("blocks"),
        "rule",
        "verdict",
    )
    bounds = rules.agg(
        F.sort_array(F.collect_set(F.length("rule_path"))).alias("lengths"),
        F.max(F.size(F.split("rule_host", r"\.", -1))).alias("labels"),
        F.max(F.when((F.col("rule_host") == "") & (F.col("rule_path") == ""), rank)).alias("bare"),
    ).first()
    host, path = url_parts(F.col(url))
    rows = pages.drop("rule", "verdict").withColumns({"host": host, "path": path})
    if not bounds["labels"]:
        return rows.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    digested = rules.withColumn("rule_digest", _digest(F.col("rule_host"), F.col("rule_path")))
    digested = digested.withColumn("rule_short", F.substring("rule_digest", 1, PREFIX_DIGITS))
    # URLs without host and path may be many, and only a rule without both fits them.
    bare = (F.col("host") == "") & (F.col("path") == "")
    places = rows.filter(~bare).select("host", "path").distinct()
    expressions = _expressions(F.col("host"), F.col("path"), bounds["lengths"], bounds["labels"])
    spread = places.select("host", "path", F.explode(expressions).alias("e")).select(
        "host", "path", _digest(F.col("e.h"), F.col("e.p")).alias("digest")
    )
    met = spread.join(digested, F.substring("digest", 1, PREFIX_DIGITS) == F.col("rule_short"))
    best = (
        met.filter(F.col("digest") == F.col("rule_digest"))
        .groupBy("host", "path")
        .agg(F.max(rank).alias("best"))
        .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    )
    # Written, as adaptive execution splits a hot URL only where both sides of the join are dealt for it.
    judged = rows.filter(~bare).join(stored(best, "best-rules"), ["host", "path"], "left").select(*rows.columns, "rule", "verdict")
    rule, verdict = (bounds["bare"]["rule"], bounds["bare"]["verdict"]) if bounds["bare"] else (None, default)
    told = rows.filter(bare).withColumns({"rule": F.lit(rule).cast("string"), "verdict": F.lit(verdict)})
    return judged.unionByName(told).withColumn("verdict", F.coalesce("verdict", F.lit(default)))
