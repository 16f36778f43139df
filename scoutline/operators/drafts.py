"""Drafts: angles and prompts out to a generator, responses back in, validated and retried."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from scoutline.config import Angles, Brand, DraftLimits
from scoutline.fixed import (
    FATAL_ERRORS,
    FATAL_STATUS,
    PASS,
    PASS_NO_EMAIL,
    PENDING_APPROVAL,
    RATE_LIMITED,
    ROW_ERROR_STATUS,
    ROW_ERROR_TEXT,
    SERVER_ERROR,
    TRANSIENT_ERRORS,
)
from scoutline.functions.text import present, strip, within_words, word_count
from scoutline.functions.values import bound, or_sentinel
from scoutline.schemas import MESSAGE_COLUMNS

ELIGIBLE = (PASS, PASS_NO_EMAIL)

_RESPONSE = "subject string, email string, dm string"
#: Seconds beyond which a told delay is no usable one: ten years.
LONGEST_WAIT = 315_360_000.0
_STRICT = {"allowSingleQuotes": "false"}


def eligible(evaluated: DataFrame) -> DataFrame:
    return evaluated.where(F.col("status").isin(*ELIGIBLE))


def collaboration_angle(angles: Angles) -> Column:
    """First matching angle; missing metrics match nothing."""
    rate, reach = F.col("engagement_rate"), F.col("followers")
    return (
        F.when(rate >= angles.high_engagement_rate, angles.high_engagement)
        .when(rate >= angles.mid_engagement_rate, angles.mid_engagement)
        .when(
            (reach >= angles.high_reach_followers)
            | (F.col("avg_views") >= angles.high_reach_views),
            angles.high_reach,
        )
        .otherwise(angles.default)
    )


def prompt_facts(angle: Column, brand: Brand) -> dict[str, Column]:
    """The nine values a prompt may use."""
    return {
        "name": or_sentinel(F.col("name")),
        "platform": or_sentinel(F.col("platform")),
        "niche": or_sentinel(F.col("niche")),
        "content_themes": or_sentinel(F.col("content_themes")),
        "recent_titles": titles_text(F.col("recent_titles")),
        "brand_name": F.lit(brand.name),
        "brand_product": F.lit(brand.product),
        "collab_angle": angle,
        "value_prop": F.lit(brand.value_prop),
    }


def titles_text(titles: Column) -> Column:
    return F.when(F.size(titles) > 0, F.array_join(titles, "; ")).otherwise(or_sentinel(F.lit("")))


def render(template: str, values: dict[str, Column]) -> Column:
    """Fill the named slots of a template in one pass, so inserted text is never rescanned."""
    parts: list[Column] = []
    for literal, slot, form, conversion in Formatter().parse(template):
        if form or conversion:
            raise ValueError(f"slot {{{slot}}}: conversions and formats are not supported")
        if literal:
            parts.append(F.lit(literal))
        if slot is not None:
            parts.append(values[slot].cast("string"))
    return F.concat(*parts) if parts else F.lit("")


def prompts(evaluated: DataFrame, template: str, angles: Angles, brand: Brand) -> DataFrame:
    """Angle and first prompt for every eligible creator."""
    ready = eligible(evaluated).withColumn("collab_angle", collaboration_angle(angles))
    prompt = render(template, prompt_facts(F.col("collab_angle"), brand))
    return ready.withColumn("prompt", prompt)


def parse_response(response: Column) -> Column:
    """Struct of trimmed subject, email and dm; three empty texts unless it is one JSON object.

    The reader stops at the end of the first value. Wrapping the text once as a list and once as
    an object field makes it see what follows: only a single complete value survives both.
    """
    as_list = F.from_json(
        F.concat(F.lit("["), response, F.lit("]")), f"array<struct<{_RESPONSE}>>", _STRICT
    )
    as_field = F.from_json(
        F.concat(F.lit('{"value":'), response, F.lit(',"end":1}')),
        f"struct<value: struct<{_RESPONSE}>, end: int>",
        _STRICT,
    )
    body = strip(response)
    braces = F.startswith(body, F.lit("{")) & F.endswith(body, F.lit("}"))

    def fields(read: Column) -> Column:
        whole = read["braces"] & (F.size(read["list"]) == 1) & (read["field"]["end"] == 1)
        first = F.get(read["list"], F.lit(0))
        return F.struct(
            *[
                F.coalesce(F.when(whole, strip(first[name])), F.lit("")).alias(name)
                for name in ("subject", "email", "dm")
            ]
        )

    return bound(
        F.struct(braces.alias("braces"), as_list.alias("list"), as_field.alias("field")), fields
    )


def draft_problems(draft: Column, limits: DraftLimits) -> Column:
    """Ordered list of what is wrong with a draft; empty when it is valid."""
    subject = draft["subject"]
    return F.array_compact(
        F.array(
            F.when(subject == "", F.lit("subject missing")),
            F.when(word_count(subject) > limits.subject_max_words, F.lit("subject too long")),
            F.when(~within_words(draft["email"], limits.email_words), F.lit("email length")),
            F.when(~within_words(draft["dm"], limits.dm_words), F.lit("dm length")),
        )
    )


def numbered_calls(attempts: DataFrame) -> DataFrame:
    """Add ``failure``, ``draft_no`` and ``call_no`` to every call of a creator, in order of ``attempt``.

    A call that failed gives no draft, whatever text came with it: it is one of the calls (``call_no``)
    made for the draft that the next answer gives (``draft_no``).
    """
    order = Window.partitionBy("creator_id").orderBy("attempt")
    answered = F.col("failure").isNull().cast("int")
    before = F.coalesce(
        F.sum(answered).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint")
    )
    calls = Window.partitionBy("creator_id", "draft_no").orderBy("attempt")
    return (
        attempts.withColumn("failure", failure_class())
        .withColumn("draft_no", before + 1)
        .withColumn("call_no", F.row_number().over(calls))
    )


def check_attempts(attempts: DataFrame, limits: DraftLimits) -> DataFrame:
    """Answered calls up to the limit of drafts, with the parsed draft, its problems and ``valid``."""
    return (
        numbered_calls(attempts)
        .where(F.col("failure").isNull() & (F.col("draft_no") <= limits.max_attempts))
        .withColumn("draft", parse_response(F.coalesce("response", F.lit(""))))
        .withColumn("problems", draft_problems(F.col("draft"), limits))
        .withColumn("valid", F.size("problems") == 0)
    )


def first_valid(checked: DataFrame) -> DataFrame:
    """The first valid draft of each creator.

    Invalid attempts drop out as NULLs of the aggregate; a filter on ``valid`` would make the
    optimizer repeat the parsing inside the filter.
    """
    number = F.when(F.col("valid"), F.col("attempt"))
    return (
        checked.groupBy("creator_id")
        .agg(F.min_by("draft", number).alias("draft"), F.min(number).alias("attempt"))
        .where(F.col("attempt").isNotNull())
    )


def messages(ready: DataFrame, drafts: DataFrame) -> DataFrame:
    """Draft records in the MESSAGES layout, waiting for approval."""
    joined = ready.join(drafts, F.col("id") == F.col("creator_id"))
    values = {
        "influencer_id": F.col("id"),
        "influencer": F.col("name"),
        "email": F.col("email"),
        "subject": F.col("draft.subject"),
        "email_message": F.col("draft.email"),
        "dm": F.col("draft.dm"),
        "collab_angle": F.col("collab_angle"),
        "message_status": F.lit(PENDING_APPROVAL),
        "approved": F.lit(False),
    }
    return joined.select(*[values[c].alias(c) for c in MESSAGE_COLUMNS], "pos")


def without_draft(ready: DataFrame, drafts: DataFrame) -> DataFrame:
    """Eligible creators whose attempts gave no valid draft; they are skipped, not filled in."""
    return ready.join(drafts, F.col("id") == F.col("creator_id"), "left_anti")


def run_summary(ready: DataFrame, drafts: DataFrame) -> DataFrame:
    """One row: eligible, drafted, failed, and what may be written."""
    found = drafts.select("creator_id", F.lit(True).alias("drafted"))
    counted = ready.join(found, F.col("id") == F.col("creator_id"), "left").agg(
        F.count("*").alias("eligible"), F.count_if("drafted").alias("drafted")
    )
    return counted.select(
        "eligible",
        "drafted",
        (F.col("eligible") - F.col("drafted")).alias("failed"),
        F.when(F.col("eligible") == 0, "write empty table")
        .when(F.col("drafted") == 0, "fail without writing")
        .otherwise("write drafts")
        .alias("outcome"),
    )


def retry_prompts(
    first_prompts: DataFrame, checked: DataFrame, suffix: str, limits: DraftLimits
) -> DataFrame:
    """Next prompt for creators with no valid attempt and tries left.

    Every invalid draft has added its own observed word counts to the prompt; failed calls have not.
    """
    feedback = render(
        suffix,
        {
            "email_words": word_count(F.col("draft.email")),
            "dm_words": word_count(F.col("draft.dm")),
        },
    )
    open_tries = (
        checked.groupBy("creator_id")
        .agg(
            F.bool_or("valid").alias("done"),
            F.count("*").alias("tries"),
            F.array_sort(F.collect_list(F.struct("attempt", feedback.alias("text")))).alias("said"),
        )
        .where(~F.col("done") & (F.col("tries") < limits.max_attempts))
    )
    added = F.array_join(F.transform("said", lambda s: s["text"]), "\n")
    return first_prompts.join(open_tries, F.col("id") == F.col("creator_id")).select(
        "creator_id",
        (F.col("tries") + 1).alias("next_attempt"),
        F.concat_ws("\n", "prompt", added).alias("prompt"),
    )


def failure_class() -> Column:
    """Class of a failed attempt: row, fatal, transient or other; NULL when nothing failed."""
    status, kind = F.col("status_code"), F.coalesce("error_type", F.lit(""))
    row_error = (status == ROW_ERROR_STATUS) & F.contains("error_message", F.lit(ROW_ERROR_TEXT))
    return (
        F.when(status.isNull() & (kind == ""), F.lit(None).cast("string"))
        .when(row_error, "row")
        .when(kind.isin(*FATAL_ERRORS) | status.isin(*FATAL_STATUS), "fatal")
        .when(
            kind.isin(*TRANSIENT_ERRORS) | (status == RATE_LIMITED) | (status >= SERVER_ERROR),
            "transient",
        )
        .otherwise("other")
    )


def failure_classes(attempts: DataFrame) -> DataFrame:
    """Failed attempts by class; one fatal row makes the run fail."""
    return (
        attempts.select(failure_class().alias("failure"))
        .where(F.col("failure").isNotNull())
        .groupBy("failure")
        .agg(F.count("*").alias("attempts"), F.max(F.col("failure") == "fatal").alias("abort"))
    )


def retry_schedule(attempts: DataFrame, limits: DraftLimits) -> DataFrame:
    """Delay and time of the next try for failed calls that may be repeated.

    A rate-limited call waits as long as the server says (seconds or an HTTP date, with a year of two
    or four digits); all others, and calls whose header is no usable delay, back off exponentially
    with the number of calls made for the same draft.
    """
    said = present(F.trim("retry_after"))
    seconds = said.try_cast("double")
    day = F.regexp_replace(F.regexp_replace(said, r"\A[A-Za-z]{3,9}, ", ""), "(?<=[A-Za-z0-9])-(?=[A-Za-z0-9])", " ")
    offset = F.regexp_replace(day, r" (GMT|UTC)\z", " +0000")
    until = F.coalesce(
        *[
            F.try_to_timestamp(value, F.lit(f"d MMM {year} HH:mm:ss{zone}"))
            for year in ("yyyy", "yy")
            for value, zone in ((offset, " xx"), (day, ""))
        ]
    )
    wait = F.unix_micros(until) / 1e6 - F.unix_micros("attempted_at") / 1e6
    asked = F.coalesce(seconds, wait)
    # Not a number sorts above infinity, so the bound takes out both.
    told = F.when(
        (F.col("status_code") == RATE_LIMITED) & (asked <= LONGEST_WAIT), F.greatest(F.lit(0.0), asked)
    )
    backoff = F.lit(limits.retry_base_delay) * F.pow(F.lit(2.0), F.col("call_no") - 1)
    delay = F.coalesce(told, backoff)
    return (
        numbered_calls(attempts)
        .where(F.col("failure").isin("transient", "row"))
        .where(F.col("call_no") < limits.max_calls)
        .select(
            "creator_id",
            "attempt",
            "failure",
            delay.alias("delay_seconds"),
            F.timestamp_micros(
                (F.unix_micros("attempted_at") + F.round(delay * 1e6)).cast("bigint")
            ).alias("next_try_at"),
        )
    )
