"""Explainable pass/fail rules, the fit score, and the ranked shortlist."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoutline.config import Discovery, Rules, Settings
from scoutline.fixed import FAIL, PASS, PASS_NO_EMAIL, REASONS
from scoutline.functions.text import keyword_hits, present
from scoutline.functions.values import days_since
from scoutline.operators.ordering import position

# Rows of one score that share a block of this many positions are numbered by one task.
RANK_BLOCK = 1 << 20


def followers_ok(rules: Rules) -> Column:
    in_range = F.col("followers").between(rules.min_followers, rules.max_followers)
    return F.coalesce(in_range, F.lit(False))


def engagement_ok(rules: Rules) -> Column:
    rate = F.nanvl("engagement_rate", F.lit(None).cast("double"))
    return F.coalesce(rate >= rules.min_engagement_rate, F.lit(False))


def niche_evidence(rules: Rules) -> Column:
    """Keywords in the stored niche, themes and titles; titles are separated as in stored text."""
    titles = F.array_join("recent_titles", '", "')
    return keyword_hits(
        F.concat_ws(
            " ",
            F.coalesce("niche", F.lit("")), F.coalesce("content_themes", F.lit("")),
            F.coalesce(titles, F.lit("")),
        ),
        rules.niche_keywords,
    )


def country_conflict(discovery: Discovery) -> Column:
    return _conflict("country", discovery.region_code)


def language_conflict(discovery: Discovery) -> Column:
    return _conflict("language", discovery.language)


def _conflict(column: str, expected: str | None) -> Column:
    if not expected:
        return F.lit(False)
    return F.coalesce(present(F.col(column)) != expected, F.lit(False))


def fail_reasons(settings: Settings) -> Column:
    """Reasons in rule order; needs the ``hits`` and ``upload_age`` columns of ``evaluate``."""
    rules, discovery = settings.rules, settings.discovery
    broken = {
        "followers": ~followers_ok(rules),
        "engagement": ~engagement_ok(rules),
        "niche": F.col("hits") < rules.min_keyword_hits,
        "activity": F.col("upload_age") > rules.max_upload_age_days,
        "upload_date": F.col("upload_age").isNull(),
        "country": country_conflict(discovery),
        "language": language_conflict(discovery),
    }
    return F.array_compact(
        F.array(*[F.when(failed, F.lit(REASONS[rule])) for rule, failed in broken.items()])
    )


def brand_fit(rules: Rules) -> Column:
    """Weighted score from 0 to 100; missing parts count as zero."""
    one, zero, weights = F.lit(1.0), F.lit(0.0), rules.weights
    followers = F.when(followers_ok(rules), one).otherwise(zero)
    rate = F.col("engagement_rate") / F.lit(float(rules.engagement_score_cap))
    engagement = F.when(rate.isNotNull(), F.least(one, rate)).otherwise(zero)
    niche = F.least(one, F.col("hits") / F.lit(float(rules.min_keyword_hits)))
    freshness = one - F.col("upload_age") / F.lit(float(rules.max_upload_age_days))
    activity = F.when(freshness.isNotNull(), F.greatest(zero, freshness)).otherwise(zero)
    weighted = (
        followers * weights.followers + engagement * weights.engagement
        + niche * weights.niche + activity * weights.activity
    )
    return F.round(weighted * 100, 2)


def evaluate(creators: DataFrame, settings: Settings, as_of: datetime) -> DataFrame:
    """Set status, fail_reasons and brand_fit_score on every row; no row is dropped."""
    measured = creators.withColumns(
        {
            "hits": F.size(niche_evidence(settings.rules)),
            "upload_age": days_since(F.col("last_upload"), as_of),
        }
    ).withColumn("fail_reasons", fail_reasons(settings))
    status = (
        F.when(F.size("fail_reasons") > 0, F.lit(FAIL))
        .when(present(F.col("email")).isNull(), F.lit(PASS_NO_EMAIL))
        .otherwise(F.lit(PASS))
    )
    return measured.withColumns(
        {"status": status, "brand_fit_score": brand_fit(settings.rules)}
    ).drop("hits", "upload_age")


def shortlist(evaluated: DataFrame) -> DataFrame:
    """Rows that did not fail, best score first, ties in discovery order, with their rank.

    Scores have two decimals, so there are at most some ten thousand of them; within one score
    the rows are numbered in blocks of positions, so a common score is spread over tasks. The numbered rows are
    written before the blocks are put in order, so ``evaluated`` is read once.
    """
    kept = evaluated.where(F.col("status") != FAIL).withColumn(
        "block", F.floor(F.col("pos") / RANK_BLOCK)
    )
    ranked = position(kept, "brand_fit_score", ["pos"], "block", descending=True, written=True)
    return (
        ranked.withColumn("rank", F.col("position") + 1)
        .drop("block", "position")
        .orderBy(F.col("brand_fit_score").desc(), F.col("pos").asc())
    )


def status_counts(evaluated: DataFrame) -> DataFrame:
    return evaluated.groupBy("status").agg(F.count("*").alias("creators"))


def reason_histogram(evaluated: DataFrame) -> DataFrame:
    return (
        evaluated.select(F.explode("fail_reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count("*").alias("creators"))
    )
