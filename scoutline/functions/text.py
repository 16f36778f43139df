"""Text rules as column expressions: words, keywords, e-mail addresses and links."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from scoutline.fixed import (
    EMAIL_DOMAIN,
    EMAIL_LOCAL,
    EMAIL_TRIM,
    INSTAGRAM_HOST,
    PLACEHOLDER_DOMAINS,
    URL,
    URL_TRIM,
    VIDEO_HOSTS,
)
from scoutline.functions.values import bound

# Unicode blanks. Java's \s knows only the ASCII ones, so the set is spelled out.
_RARE_BLANKS = (
    "\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
_RARE_RANGE = r"[\x1c-\x1f\x80-\xa0\u1680-\u3000]"
BLANK_CHARS = "\t\n\x0b\x0c\r " + _RARE_BLANKS
# A run of local-part characters without an @ behind it can hold no address at any later start,
# so a search may begin only at the start of a run or where the last match ended. The possessive
# quantifier and this guard keep long runs linear.
EMAIL_SEARCH = rf"(?:\G|(?<!{EMAIL_LOCAL})){EMAIL_LOCAL}++@{EMAIL_DOMAIN}"
EMAIL_WHOLE = rf"\A{EMAIL_LOCAL}+@{EMAIL_DOMAIN}\z"

MASK_BITS = 62


def strip(text: Column) -> Column:
    """Remove Unicode blanks from both ends."""
    return F.btrim(text, F.lit(BLANK_CHARS))


def present(text: Column) -> Column:
    """NULL for empty text."""
    return F.nullif(text, F.lit(""))


def plain_blanks(text: Column) -> Column:
    """Rare blanks as ordinary ones, so that plain ASCII classes can match afterwards.

    A regex class with all blanks is several times slower than the ASCII one. A coarse class
    rules out most texts; only the others are translated.
    """
    spaces = " " * len(_RARE_BLANKS)
    return bound(
        text,
        lambda t: F.when(t.rlike(_RARE_RANGE), F.translate(t, _RARE_BLANKS, spaces)).otherwise(t),
    )


def word_count(text: Column) -> Column:
    """Words between Unicode blanks."""
    return F.regexp_count(plain_blanks(text), F.lit(r"\S+"))


def within_words(text: Column, bounds: tuple[int, int]) -> Column:
    return word_count(text).between(*bounds)


def is_valid_email(value: Column) -> Column:
    """True for a whole, well-formed address outside the placeholder domains; never NULL."""
    address = strip(value)
    domain = F.lower(F.substring_index(address, "@", -1))
    return F.coalesce(address.rlike(EMAIL_WHOLE) & ~domain.isin(*PLACEHOLDER_DOMAINS), F.lit(False))


def extract_email(text: Column) -> Column:
    """First valid address in the text, lower-cased, or NULL."""
    found = F.regexp_extract_all(text, F.lit(EMAIL_SEARCH), 0)
    cleaned = F.transform(found, lambda x: F.btrim(x, F.lit(EMAIL_TRIM)))
    first = F.lower(F.get(F.filter(cleaned, is_valid_email), F.lit(0)))
    return F.when(F.contains(text, F.lit("@")), first)


def extract_urls(text: Column) -> Column:
    """All web addresses in order, without trailing punctuation, as structs of url and host."""
    found = F.when(
        F.contains(text, F.lit("http")),
        F.regexp_extract_all(plain_blanks(text), F.lit(URL), 0),
    ).otherwise(F.array().cast("array<string>"))
    cleaned = F.transform(found, lambda x: F.rtrim(x, F.lit(URL_TRIM)))
    return F.transform(cleaned, lambda u: F.struct(u.alias("url"), url_host(u).alias("host")))


def url_host(url: Column) -> Column:
    authority = F.lower(F.regexp_extract(url, r"\Ahttps?://([^/?#]*)", 1))
    return F.regexp_replace(authority, r"\Awww\.", "")


def profile_links(text: Column) -> Column:
    """Struct of the Instagram profile and the website found in the text.

    The first address on the Instagram host is the profile. The website is the first other one
    outside the video host; a second Instagram address therefore counts as a website. So among
    the addresses outside the video host, the website is the first, or the second where the first
    is the profile.
    """
    outside = F.filter(
        extract_urls(text),
        lambda u: reduce(
            Column.__and__,
            [~F.endswith(u["host"], F.lit(video)) for video in VIDEO_HOSTS],
            u["host"] != "",
        ),
    )

    def choose(urls: Column) -> Column:
        on_instagram = lambda u: u["host"] == INSTAGRAM_HOST
        first, second = F.get(urls, F.lit(0)), F.get(urls, F.lit(1))
        return F.struct(
            F.get(F.filter(urls, on_instagram), F.lit(0))["url"].alias("instagram"),
            F.when(on_instagram(first), second["url"]).otherwise(first["url"]).alias("website"),
        )

    return bound(outside, choose)


#: From so many keywords on, one automaton reads the text once for all of them.
MANY_KEYWORDS = 40


def keyword_names(keywords: Sequence[str]) -> Column:
    """The keywords as one constant array; one expression however many they are."""
    return F.from_json(F.lit(json.dumps(list(keywords))), "array<string>")


def _scan(keywords: Sequence[str]):
    """A column function lower-cased text -> bit masks of all keywords that occur, 62 to a mask.

    The automaton is built on the driver, shipped with the function and walks each text once, so the cost of a
    text hardly depends on the number of keywords. Overlapping and repeated keywords are all found.
    """
    import ahocorasick

    empty, places = 0, {}
    for i, keyword in enumerate(keywords):
        if keyword:
            places.setdefault(keyword.lower(), []).append(i)
        else:
            empty |= 1 << i  # the empty text is in every text
    automaton = ahocorasick.Automaton()
    bits = [sum(1 << i for i in at) for at in places.values()]
    for number, word in enumerate(places):
        automaton.add_word(word, number)
    if places:
        automaton.make_automaton()
    parts, size = -(-len(keywords) // MASK_BITS), (1 << MASK_BITS) - 1

    @F.pandas_udf("array<bigint>")
    def masks(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            if text is None:
                out.append(None)
                continue
            found = empty
            if places:
                for number in {number for _, number in automaton.iter(text)}:
                    found |= bits[number]
            out.append([found >> (MASK_BITS * k) & size for k in range(parts)])
        return pd.Series(out)

    return masks


def _bit(masks: Column, i: Column) -> Column:
    mask = F.get(masks, F.floor(i / MASK_BITS).cast("int"))
    return F.call_function("shiftright", mask, F.pmod(i, F.lit(MASK_BITS)).cast("int")).bitwiseAND(F.lit(1)) == 1


def keyword_hits(text: Column, keywords: Sequence[str]) -> Column:
    """Configured keywords that occur in the text as substrings, case-insensitively, in order."""
    if not keywords:
        return F.array().cast("array<string>")
    if len(keywords) >= MANY_KEYWORDS:
        masks = F.coalesce(_scan(keywords)(F.lower(text)), F.array().cast("array<bigint>"))
        return bound(masks, lambda m: F.filter(keyword_names(keywords), lambda _, i: _bit(m, i)))
    lowered = F.lower(text)
    return F.array_compact(
        F.array(*[F.when(F.contains(lowered, F.lit(k.lower())), F.lit(k)) for k in keywords])
    )


def keyword_masks(text: Column, keywords: Sequence[str]) -> list[Column]:
    """The same test as bit masks, one bigint per 62 keywords, so that hits combine by bit_or."""
    lowered = F.lower(text)
    if len(keywords) >= MANY_KEYWORDS:
        scanned = _scan(keywords)(lowered)
        none = F.lit(0).cast("bigint")
        return [F.coalesce(F.get(scanned, F.lit(k)), none) for k in range(-(-len(keywords) // MASK_BITS))]
    masks = []
    for start in range(0, len(keywords), MASK_BITS):
        mask = F.lit(0).cast("bigint")
        for bit, keyword in enumerate(keywords[start : start + MASK_BITS]):
            hit = F.contains(lowered, F.lit(keyword.lower()))
            mask = mask.bitwiseOR(F.when(hit, F.lit(1 << bit)).otherwise(F.lit(0)).cast("bigint"))
        masks.append(mask)
    return masks


def mask_keywords(masks: Sequence[Column], keywords: Sequence[str]) -> Column:
    """Turn masks back into the ordered keyword list."""
    if not keywords:
        return F.array().cast("array<string>")
    if len(keywords) >= MANY_KEYWORDS:
        return bound(F.array(*masks), lambda m: F.filter(keyword_names(keywords), lambda _, i: _bit(m, i)))
    named = [
        F.when(
            masks[i // MASK_BITS].bitwiseAND(F.lit(1 << (i % MASK_BITS)).cast("bigint")) != 0,
            F.lit(keyword),
        )
        for i, keyword in enumerate(keywords)
    ]
    return F.array_compact(F.array(*named))
