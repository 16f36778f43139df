"""Phrases against a plain count, shared keys, split stripes, and defined results for odd inputs."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from scoutline.llm import collocations as C

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def plain(docs, s, top=2000):
    counts, n = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        low = (text or "").translate(str.maketrans(LETTERS, LETTERS.lower()))
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, s.longest + 1):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        candidates = {p: a for p, a in own.items() if len(p) >= s.shortest and a >= s.least}
        rows = []
        for p, a in candidates.items():
            inside = (q for q in candidates if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))))
            if any(100 * candidates[q] >= s.subsumed * a for q in inside):
                continue
            score, k = min((1_000_000 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for i, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top]):
            out.append((lang, i + 1, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def made(rng, rows=300):
    vocabulary = ["the", "The", "of", "ä", "b", "c", "d", "e-f", "g", "日本"]
    out = []
    for _ in range(rows):
        words = rng.choices(vocabulary, weights=[30, 3, 9, 5, 5, 3, 3, 2, 1, 2], k=rng.randint(0, 30))
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "!"]) for w in words)
        out.append((rng.choice(["en", "en", "en", "de", None]), text))
    return out


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_against_a_plain_count(spark, longest):
    docs = made(random.Random(longest))
    s = C.Settings(longest=longest, hot=6, parts=3, least=4)
    df = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    assert sorted(tuple(r) for r in C.phrases(df, s, top=15).collect()) == plain(docs, s, 15)


def test_small_blocks_and_a_full_bit_table(spark, monkeypatch):
    monkeypatch.setattr(C, "TOGETHER", 40)
    monkeypatch.setattr(C, "BLOCK", 5)
    docs = made(random.Random(9), 120)
    s = C.Settings(least=3, table_bits=8)
    df = spark.createDataFrame(docs, "lang string, text string").repartition(2)
    assert sorted(tuple(r) for r in C.phrases(df, s).collect()) == plain(docs, s)


def test_words_with_one_key_start_the_job_anew(spark):
    docs = made(random.Random(3), 60)
    s = C.Settings(least=3)
    df = spark.createDataFrame(docs, "lang string, text string").coalesce(1)
    texts = df.selectExpr("coalesce(lang, 'und') as lang", "text")
    _, seed = C.vocabulary(texts, s, key_bits=8)
    assert seed > 0  # some two of some twenty-five words share one of 256 keys at first
    # The words that share a key are told apart even inside one batch.
    rows = texts.mapInArrow(C._vocabulary_rows(0, 8), "key bigint, lang string, word string, n bigint").collect()
    assert len(rows) > len({r.key for r in rows})
    with pytest.raises(RuntimeError):
        C.vocabulary(texts, s, key_bits=2)


def test_odd_inputs(spark):
    schema = "doc_id long, lang string, text string, rank string, n string, phrase string"
    same = [(None, None, "x y x", None, None, None)] * 12
    odd = [(1, "en", None, "a", "b", "c"), (2, "en", "", None, None, None), (3, "en", " .,!\n", None, None, None)]
    long = [(4, "en", "go on " * 100_000 + "z" * 300_000, None, None, None)]
    df = spark.createDataFrame(same + odd + long, schema)
    got = C.phrases(df)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = plain([(r[1], r[2]) for r in same + odd + long], C.Settings())
    assert sorted(tuple(r) for r in got.collect()) == want
    assert {w[0] for w in want} == {"en", "und"}
    assert C.phrases(df.limit(0)).count() == 0


def test_products_beyond_64_bits(spark):
    """Scores of counts whose products pass 64 bits are exact."""
    rows = spark.createDataFrame([(1, 2, 3_000_000_007)], "w0 long, w1 long, a long")
    totals = spark.createDataFrame([(1, 4_000_000_019), (2, 5_000_000_029)], "w0 long, n long")
    got = C._least_score(rows, 2, {1: totals}).first()
    assert got.score == 1_000_000 * 3_000_000_007**2 // (4_000_000_019 * 5_000_000_029)


def test_one_stripe_a_word_and_nothing_of_rare_runs():
    """However many runs follow a word, a block sends one row for it, and no run with a rare word."""
    words = [f"a{i}" for i in range(20)]
    text = " ".join(f"{x} {y} {z} rare{i}." for i, (x, y, z) in enumerate((x, y, z) for x in words for y in words for z in words[:3]))
    batch = pa.RecordBatch.from_pydict({"lang": ["en"], "text": [text]})
    key = C._read(pa.RecordBatch.from_pydict({"lang": ["en"], "text": [" ".join(words)]}), 0, 64).key
    s = C.Settings(table_bits=20)

    def table(numbers):
        bits = np.zeros(1 << s.table_bits, dtype=np.uint8)
        bits[(numbers >> np.uint64(64 - s.table_bits)).astype(np.int64)] = 1
        return np.packbits(bits, bitorder="little")

    pairs = [np.repeat(key, 20), np.tile(key, 20)]
    tables = [table(key), table(C.joined_key(pairs))]
    for hot, rows in ((key[:0], 20), (key[:1], 19 + s.parts)):
        sent = pa.Table.from_batches(C._stripe_rows(2, tables, hot, 0, 64, s)(iter([batch])))
        assert 20 <= len(sent) <= rows and set(sent.column("w0").to_pylist()) == set(key.view(np.int64).tolist())
        counts = [n for row in sent.column("counts").to_pylist() for n in row]
        assert len(counts) == 20 * 20 * 3 and set(counts) == {1}
