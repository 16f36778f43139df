"""Held-out accuracy, the word arrays, and defined results for odd inputs."""

import re
import zlib

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scoutline.llm import quality_classifier as C
from scoutline.llm import words as W


def test_held_out_accuracy(spark):
    """Fitted without the held-out fold, on the 0.01 tables; the fold is scored by the same model."""
    base = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    model = C.train(docs, labels)
    rows = C.scored(docs.join(labels, "doc_id"), model).select("doc_id", "quality", "score", "predicted", C.held_out(F.col("doc_id")).alias("out"))
    rows = rows.collect()
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.out]
    assert model.rows == sum(not r.out for r in rows)
    assert np.mean([r.quality == r.predicted for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs = spark.createDataFrame([(i, f"some words {i % 2} here") for i in range(60)], "doc_id long, text string")
    labels = [(i, i % 2) for i in range(60)]
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q) for i, q in labels]
    a, b = (C.train(docs, spark.createDataFrame(x, "doc_id long, quality int")) for x in (labels, flipped))
    assert a.rows < 60 and (a.weights == b.weights).all()


def test_odd_inputs(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, None), (None, 1), (4, 0), (5, 1), (99, 1)], "doc_id long, quality int")
    rows = [(1, "a b", 1), (4, "x", 2), (5, None, 3), (5, "y y", 4), (None, "", 5), (None, None, 6), (7, "long " * 50_000, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score long")
    model = C.train(docs, labels)
    got = C.scored(docs, model)
    assert got.columns == ["doc_id", "text", "score", "predicted"]
    scores = [r.score for r in got.collect()]
    assert len(scores) == len(rows) and all(0 <= s <= 1 for s in scores)
    assert C.scored(docs.limit(0), model).count() == 0
    nothing = C.train(docs, labels.limit(0))
    assert nothing.rows == 0 and {r.score for r in C.scored(docs, nothing).collect()} == {0.5}


@pytest.mark.parametrize("block", [7, 1 << 20])
def test_words(monkeypatch, block):
    monkeypatch.setattr(W, "BLOCK", block)
    texts = [None, "", "  ", "a", " b c\x0bd ", "é" * 40 + " x", "tail\n"]
    found = W.hashed_words(texts)
    for i, text in enumerate(texts):
        want = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        at = range(found.first[i], found.first[i + 1])
        assert [found.data[found.start[j] : found.stop[j]].decode() for j in at] == want


@given(st.lists(st.text(alphabet="abAB \n", max_size=30), max_size=8))
def test_equal_words_have_equal_hashes(texts):
    for fold in (False, True):
        found = W.hashed_words(texts, fold=fold)
        seen = {}
        for a, b, h in zip(found.start, found.stop, found.hash):
            word = found.data[a:b].lower() if fold else found.data[a:b]
            assert seen.setdefault(word, h) == h
        assert len(set(seen.values())) == len(seen)


def plain_features(text, buckets):
    """{bucket: weight} of one text, n-gram by n-gram: words and pairs of words, forms and pairs of forms."""
    found = W.hashed_words([text], kinds=C._KINDS)
    words, raw = [int(h) for h in found.hash], re.findall(r"[^\x20\x09-\x0D]+", text or "")
    mix = lambda v: int(W.mixed(np.array([v % 2**64], dtype=np.uint64))[0])
    odd, out = 0x9E3779B97F4A7C15, {}
    forms = []
    for i, word in enumerate(raw):
        kinds = 0
        for byte in word.encode():
            kinds |= int(C._KINDS[byte])
        again = i > 0 and raw[i - 1] == word
        forms.append(mix((kinds * 2 | again) * 31 + min(len(word.encode()), 24)))
    families = (
        words, [mix(a * odd + b) for a, b in zip(words, words[1:])],
        [mix(f + odd) for f in forms], [mix(a * odd % 2**64 ^ b) for a, b in zip(forms, forms[1:])],
    )
    for family in families:
        for h in family:
            out[h % buckets] = out.get(h % buckets, 0.0) + 1 / len(family)
    return out


def plain_ftrl(rows, s):
    """FTRL-proximal, weight by weight, over rows of ({bucket: value}, label) in the order of the shard."""
    z, n = {}, {}

    def weight(i):
        v = z.get(i, 0.0)
        if i != s.buckets:  # the bias has no penalty on its size
            v = 0.0 if abs(v) <= s.l1 else v - (s.l1 if v > 0 else -s.l1)
        return -v / ((s.beta + n.get(i, 0.0) ** 0.5) / s.alpha + s.l2)

    order = np.random.default_rng(7)
    for _ in range(s.epochs):
        for r in order.permutation(len(rows)):
            x, y = rows[r]
            w = {i: weight(i) for i in x}
            p = 1 / (1 + np.exp(-min(35, max(-35, sum(w[i] * v for i, v in x.items())))))
            for i, v in x.items():
                g = (p - y) * v
                sigma = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / s.alpha
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z}


def test_scores_against_plain_python(spark):
    """n-grams, updates and dot products against a version that does one at a time, over two shards."""
    s = C.Settings(buckets=1 << 10, shard_rows=20, epochs=3)
    rng = np.random.default_rng(4)
    vocabulary = ["good", "bad", "The", "x1", "é!", "##", "same", "same"]
    texts = [" ".join(rng.choice(vocabulary[i % 2 :], size=rng.integers(1, 30))) for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    model = C.train(docs, labels, s)
    known = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2]
    shards = -(-len(known) // s.shard_rows)
    of = {r.doc_id: r.s for r in docs.selectExpr("doc_id", f"cast(pmod(xxhash64(doc_id), {shards}) as int) s").collect()}
    weights = np.zeros(s.buckets + 1)
    for shard in range(shards):
        own = [i for i in known if of[i] == shard]
        rows = [({b: float(np.float32(v)) for b, v in plain_features(texts[i], s.buckets).items()} | {s.buckets: 1.0}, i % 2) for i in own]
        for b, w in plain_ftrl(rows, s).items():
            weights[b] += np.float32(w) * len(own) / len(known)
    assert np.abs(weights - model.weights).max() < 1e-4 * max(1, np.abs(weights).max())
    got = {r.doc_id: r.score for r in C.scored(docs, model).collect()}
    for i, text in enumerate(texts):
        total = weights[s.buckets] + sum(weights[b] * v for b, v in plain_features(text, s.buckets).items())
        assert abs(got[i] - 1 / (1 + np.exp(-total))) < 1e-3
