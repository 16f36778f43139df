"""Quality rules whose cutoffs are chosen under a guaranteed limit of false rejections.

Every rule rejects a document if a statistic of its text exceeds a cutoff. The cutoffs are learned
per stratum from labelled holdout documents. All rules go one fixed path together, in which one rule after the
other takes its next stricter cutoff; each setting on it is tested, from the mildest on, with an exact binomial test of
"these rules together reject a share of ``limit`` or more of the good documents", and the path ends before the
first that cannot be ruled out. Testing a fixed order needs no correction inside a stratum, and the whole
limit serves the union of the rules; over the strata the error level is divided by their number. So with
probability ``1 - error`` the rules reject less than ``limit`` of the good documents in every stratum. With
the default settings some 220 good documents of a stratum can certify cutoffs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from scoutline.functions.values import bound
from scoutline.session import stored

SYMBOLS = "[#*$%&|<>]"

#: Rule statistics with their candidate cutoffs, mildest first.
CANDIDATES: dict[str, tuple[float, ...]] = {
    "symbol_share": (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02),
    "dup_line_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1),
    "repeat_share": (0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1),
    "mean_word_chars": (40.0, 30.0, 25.0, 20.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.0),
}


def path() -> list[dict[str, float]]:
    """The joint settings in their order: level by level, rule by rule, the next stricter cutoff is added."""
    settings, now = [], {}
    for level in range(max(map(len, CANDIDATES.values()))):
        for rule, cuts in CANDIDATES.items():
            if level < len(cuts):
                now = now | {rule: cuts[level]}
                settings.append(now)
    return settings


@dataclass(frozen=True)
class Risk:
    """``limit``: share of good documents per stratum that all rules together may reject.
    ``error``: probability that this is violated anywhere."""

    limit: float = 0.02
    error: float = 0.05


def words(text: Column) -> Column:
    """Runs of anything but the six ASCII white-space characters."""
    return F.array_remove(F.split(text, "[ \\t-\\r]+"), "")


#: Up to so many repeated windows, each window is looked up in their list instead of being sorted.
FEW_REPEATS = 32


def repeated_words(found: Column) -> Column:
    """Words inside 3-word windows that occur twice or more, the first occurrence included.

    Windows are compared by their 64-bit hash. A text without repeats costs one hash set; with few,
    their places are looked up in the short list of repeated hashes; with many, sorting
    (hash, place) brings equal windows together, so the work is n log n for any text. A window
    covers three places, less those of the next one.
    """

    def windows(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - 3)
        return F.transform(at, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def looked_up(h: Column) -> Column:
        repeats = bound(
            F.sort_array(h),
            lambda s: F.array_distinct(
                F.filter(s, lambda x, k: (F.get(s, k - 1) == x).eqNullSafe(True))
            ),
        )
        at = F.sequence(F.lit(0), F.size(h) - 1)
        return bound(repeats, lambda r: F.filter(at, lambda i: F.array_contains(r, F.get(h, i))))

    def sorted_out(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            again = F.filter(
                s,
                lambda x, k: (F.get(s, k + 1)["h"] == x["h"]).eqNullSafe(True)
                | (F.get(s, k - 1)["h"] == x["h"]).eqNullSafe(True),
            )
            return F.sort_array(F.transform(again, lambda x: x["i"]))

        return bound(pairs, places)

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, step: total + step)

    zero = F.lit(0).cast("bigint")

    def counted(h: Column) -> Column:
        return bound(
            F.size(h) - F.size(F.array_distinct(h)),
            lambda extra: F.when(extra == 0, zero)
            .when(extra <= FEW_REPEATS, bound(looked_up(h), covered))
            .otherwise(bound(sorted_out(h), covered)),
        )

    return bound(found, lambda w: F.when(F.size(w) >= 3, bound(windows(w), counted)).otherwise(zero))


def text_statistics(text: Column) -> Column:
    """Struct of the base counts of a text; NULL counts as empty."""

    def counts(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n", -1), lambda line: line.rlike("[^ \\t-\\r]"))

        def of_words(w: Column) -> Column:
            return F.struct(
                F.size(w).cast("bigint").alias("n_words"),
                F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
                (F.size(F.split(t, SYMBOLS, -1)) - 1).cast("bigint").alias("n_symbols"),
                bound(
                    lines,
                    lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("unlike")),
                ).alias("lines"),
                repeated_words(w).alias("n_repeat_words"),
            )

        return bound(words(t), of_words)

    return bound(F.coalesce(text, F.lit("")), counts)


def count_documents(docs: DataFrame, stratum: str) -> DataFrame:
    """Base counts of every document, with its id and stratum ``_s``."""
    rows = docs.select("doc_id", F.col(stratum).alias("_s"), text_statistics(F.col("text")).alias("c"))
    return rows.select("doc_id", "_s", "c.*").select(
        "doc_id",
        "_s",
        "n_words",
        "word_chars",
        "n_symbols",
        F.col("lines.n").cast("bigint").alias("n_lines"),
        (F.col("lines.n") - F.col("lines.unlike")).cast("bigint").alias("n_dup_lines"),
        "n_repeat_words",
    )


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")), F.lit(0.0))


def with_rule_values(counted: DataFrame) -> DataFrame:
    """Add the statistic of every rule, computed from the counts; a text without words has zeros."""
    return counted.withColumns(
        {
            "symbol_share": _share("n_symbols", "word_chars"),
            "dup_line_share": _share("n_dup_lines", "n_lines"),
            "repeat_share": _share("n_repeat_words", "n_words"),
            "mean_word_chars": _share("word_chars", "n_words"),
        }
    )


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), summed exactly in logarithms; 1 where k > n p.

    Such k can't certify anything, so the sum has at most n p terms.
    """
    odds = math.log(p) - math.log1p(-p)
    first = n * F.lit(math.log1p(-p))
    start = F.struct(first.alias("term"), first.alias("sum"))

    def add(s: Column, i: Column) -> Column:
        term = s["term"] + F.log((n - i + 1) / i) + F.lit(odds)
        return bound(
            term,
            lambda t: F.struct(
                t.alias("term"),
                (F.greatest(s["sum"], t) + F.log1p(F.exp(-F.abs(s["sum"] - t)))).alias("sum"),
            ),
        )

    some = F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>"))
    inside = F.exp(F.aggregate(some, start, add, lambda s: s["sum"]))
    return F.when(k <= n * p, inside).otherwise(F.lit(1.0))


def certified_cutoffs(holdout: DataFrame, stratum: str, risk: Risk = Risk()) -> DataFrame:
    """One row per stratum with the cutoffs of the strictest certified setting, NULL for rules that have none yet.

    ``holdout`` has the rule values of good documents only. All settings are counted in one pass
    with map-side combine, so a stratum that owns most rows is no burden. A stratum in which not even the
    mildest setting is certified has no row.
    """
    settings = path()
    rejects = [reduce(Column.__or__, [F.col(r) > c for r, c in one.items()]) for one in settings]
    sums = [F.count_if(r).alias(f"k_{j}") for j, r in enumerate(rejects)]
    counted = stored(holdout.groupBy(stratum).agg(F.count("*").alias("n"), *sums), "cutoff-counts")
    level = risk.error / max(1, counted.count())
    tests = [
        F.struct(
            F.lit(j).alias("j"), F.col(f"k_{j}").alias("k"),
            *[F.lit(one.get(r)).cast("double").alias(f"{r}_cutoff") for r in CANDIDATES],
        )
        for j, one in enumerate(settings)
    ]
    tested = counted.select(stratum, "n", F.inline(F.array(*tests))).withColumn(
        "passed", binomial_tail(F.col("k"), F.col("n"), risk.limit) <= level
    )
    # The order is fixed, so what counts is the setting before the first that did not pass.
    failed = F.min(F.when(~F.col("passed"), F.col("j"))).over(Window.partitionBy(stratum))
    certified = tested.withColumn("failed", failed).filter("failed is null or j < failed")
    cutoffs = [f"{r}_cutoff" for r in CANDIDATES]
    last = certified.groupBy(F.col(stratum).alias("_stratum")).agg(F.max_by(F.struct(*cutoffs), "j").alias("last"))
    return last.select("_stratum", "last.*")


def judge(
    docs: DataFrame, labels: DataFrame, *, stratum: str = "lang", risk: Risk = Risk()
) -> DataFrame:
    """Base counts, ``base_failed`` and ``kept`` of every document, with the cutoffs of its stratum.

    The holdout are all labelled good documents (every label of the id says quality 1) that pass the
    base rules. A NULL stratum is a stratum of its own; a stratum without labels, or with too few to
    certify anything, has no cutoffs and keeps what passes the base. NULL texts count as empty,
    rows with equal ids are judged row by row, labels without a document are not used. Only ids,
    strata and counts leave the scan; they are written once and read for both passes.
    """
    counted = stored(with_rule_values(count_documents(docs, stratum)), "quality-counts")
    counted = counted.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("_q")).filter("_q = 1").select("doc_id")
    holdout = counted.filter(~F.col("base_failed")).join(good, "doc_id", "left_semi")
    cutoffs = certified_cutoffs(holdout, "_s", risk)
    judged = counted.join(cutoffs, F.col("_s").eqNullSafe(F.col("_stratum")), "left")
    rejects = F.lit(False)
    for rule in CANDIDATES:
        rejects = rejects | F.coalesce(F.col(rule) > F.col(f"{rule}_cutoff"), F.lit(False))
    return (
        judged.withColumn("kept", ~(F.col("base_failed") | rejects))
        .withColumn(stratum, F.col("_s"))
        .drop("_s", "_stratum")
    )
