"""Text rules against plain loops over random and hand-made texts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from scoutline.functions import text

ADDRESS = re.compile(text.EMAIL_WHOLE.replace(r"\z", r"\Z"))


def scan_addresses(value):
    """Addresses from left to right, each as long as possible, by trying every end."""
    start = 0
    while start < len(value):
        ends = [e for e in range(len(value), start, -1) if ADDRESS.match(value[start:e])]
        if ends:
            yield value[start : ends[0]]
        start = ends[0] if ends else start + 1


def scanned_email(value):
    usable = [a.strip(".,;:") for a in scan_addresses(value)]
    usable = [
        a.lower() for a in usable
        if ADDRESS.match(a) and a.lower().split("@")[1] not in text.PLACEHOLDER_DOMAINS
    ]
    return usable[0] if usable else None


def scan_urls(value):
    """Walk from one scheme to the next and take characters up to a blank or bracket."""
    at = 0
    while at < len(value):
        scheme = next((s for s in ("https://", "http://") if value.startswith(s, at)), None)
        if scheme is None:
            at += 1
            continue
        end = body = at + len(scheme)
        while end < len(value) and not value[end].isspace() and value[end] not in "<>[]()":
            end += 1
        if end > body:
            yield value[at:end].rstrip(".,;:)")
        at = end


def host_of(url):
    rest = url.partition("//")[2]
    for mark in "/?#":
        rest = rest.partition(mark)[0]
    rest = rest.lower()
    return rest[4:] if rest.startswith("www.") else rest


def scanned_links(value):
    urls = [(u, host_of(u)) for u in scan_urls(value)]
    on_instagram = [n for n, (_, host) in enumerate(urls) if host == "instagram.com"][:1]
    sites = [
        u for n, (u, host) in enumerate(urls)
        if n not in on_instagram and host
        and not any(host.endswith(video) for video in ("youtube.com", "youtu.be"))
    ]
    return (urls[on_instagram[0]][0] if on_instagram else None, sites[0] if sites else None)


def random_texts(pieces, count, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(count)]


def test_email_equals_scan(evaluate):
    pieces = list("ab1._%+-@@@.,;: \n") + [
        "Me@Shop.com", "@example.com", "x@domain.com", ".co", "a@b.cc", "é", "_x@c.org", "..",
    ]
    texts = random_texts(pieces, 3000, 1)
    assert evaluate(text.extract_email, texts) == [scanned_email(t) for t in texts]
    long_runs = ["a" * 200_000 + "@", "a" * 200_000 + " b@x.io"]
    assert evaluate(text.extract_email, long_runs) == [None, "b@x.io"]


def test_email_examples(evaluate):
    texts = [
        "x@domain.com,first@two.words.net,second@w.net", "<Kiln.Room+news@POTTERY.Museum>", "user@host", "a@@b.net", None, "",
        "only@EMAIL.com", "..@.. then_9%@q-r.io!",
    ]
    assert evaluate(text.extract_email, texts) == [
        "first@two.words.net", "kiln.room+news@pottery.museum", None, None, None, None, None, "then_9%@q-r.io"]


def test_valid_email(evaluate):
    cases = {
        "Not Found": False, "a@example.com": False, "a@brand.co": True, " a@brand.co ": True,
        "a@EXAMPLE.com": False, "a@sub.example.com": True, "a b@c.de": False, "": False, None: False,
        "a@brand.co\n": True, "a@b": False,
    }
    assert evaluate(text.is_valid_email, list(cases)) == list(cases.values())


def test_links_equal_scan(evaluate):
    pieces = [
        "https://instagram.com/a", "http://www.Instagram.com/b", "https://www.youtube.com/x",
        "https://youtu.be/y", "http://shop.test:80/?q=1", "https://brand.test", "http://", ".,;:)",
        " ", "　", "(", ")", "<", "text", "https://m.youtube.com#", "\x1c", "—",
    ]
    texts = random_texts(pieces, 3000, 2)
    found = evaluate(text.profile_links, texts)
    assert [(r["instagram"], r["website"]) for r in found] == [scanned_links(t) for t in texts]
    assert any(site and "nstagram" in site for _, site in map(scanned_links, texts))


def test_word_count_equals_split(evaluate):
    blanks = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0       　"
    texts = random_texts(list(blanks) + ["a", "bé", "​", "—", "\x1b", "\U0001f600"], 3000, 3)
    assert evaluate(text.word_count, texts) == [len(t.split()) for t in texts]
    assert evaluate(lambda c: text.within_words(c, (3, 5)), ["one two three", "one two"]) == [True, False]


def test_strip_equals_python(evaluate):
    texts = random_texts(list(" \t\x1f\x85 　ab"), 500, 4)
    assert evaluate(text.strip, texts) == [t.strip() for t in texts]


def test_keywords_keep_order_and_match_inside_words(evaluate):
    words = ("skincare", "Hair", "haul")
    texts = ["HAIRcut haul", "none", "my skinCARE, hair", None]
    hits = [["Hair", "haul"], [], ["skincare", "Hair"], []]
    assert evaluate(lambda c: text.keyword_hits(c, words), texts) == hits


def test_masks_equal_hits_beyond_one_word(evaluate):
    words = tuple(f"k{i}x" for i in range(130))
    rng = random.Random(5)
    texts = [" ".join(rng.sample(words, rng.randint(0, 9))) for _ in range(100)]

    def through_masks(column):
        return text.mask_keywords(text.keyword_masks(column, words), words)

    assert evaluate(through_masks, texts) == evaluate(lambda c: text.keyword_hits(c, words), texts)


@pytest.mark.parametrize("count", [39, 40, 200])
def test_many_keywords_equal_a_loop(evaluate, count):
    """Overlapping, nested, repeated and empty keywords, with other letters than ASCII and more than one mask."""
    rng = random.Random(count)
    pieces = ["a", "b", "é", "Ab", "日", " "]
    words = ["aba", "ab", "b", "abab", "É", "AB", "ab"] + ["".join(rng.choices(pieces, k=rng.randint(1, 5))) for _ in range(count - 8)] + [""]
    texts = ["".join(rng.choices([*pieces, "x", "İ"], k=rng.randint(0, 20))) for _ in range(200)] + [None, "", "xyz", "ab" * 50_000]
    want = [[w for w in words if t is not None and w.lower() in t.lower()] for t in texts]
    assert evaluate(lambda c: text.keyword_hits(c, words), texts) == want
    masks = evaluate(lambda c: text.mask_keywords(text.keyword_masks(F.coalesce(c, F.lit("")), words), words), texts)
    assert masks == [w if t is not None else [""] for w, t in zip(want, texts)]


def test_host_keeps_port_and_drops_one_www(evaluate):
    urls = ["http://www.www.x.test:80/a", "https://X.test?q", "https://x.test#f", "https://"]
    hosts = ["www.x.test:80", "x.test", "x.test", ""]
    assert evaluate(text.url_host, urls) == hosts


def test_present(evaluate):
    assert evaluate(text.present, ["", "a", None]) == [None, "a", None]
    assert evaluate(lambda c: F.size(text.extract_urls(c)), ["no address"]) == [0]
