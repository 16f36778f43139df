"""Held-out accuracy, Viterbi against all labellings, spans of mixed texts, and odd inputs."""

import itertools
import random
import zlib

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scoutline.llm import language_id as L
from scoutline.llm import queries

BASE = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.op11_language_id(spark, BASE).collect()}
    docs = spark.read.parquet(f"{BASE}/documents.parquet").select("doc_id", "lang", F.length("text").alias("n")).collect()
    assert len(got) == len(docs)
    assert all(got[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 3 == 1) for d in docs)
    held = [d for d in docs if got[d.doc_id].held_out]
    assert np.mean([got[d.doc_id].lang_pred == d.lang for d in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_languages_of_the_held_out_fold_change_nothing(spark):
    rows = [(i, ["hello there", "guten tag"][i % 2], ["en", "de"][i % 2]) for i in range(60)]
    wrong = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 3 == 1 else x) for i, t, x in rows]
    a, b = (L.train(spark.createDataFrame(x, "doc_id long, text string, lang string")) for x in (rows, wrong))
    assert a.languages == b.languages == ["de", "en"] and a.rows == b.rows < 60
    assert (a.logs == b.logs).all()


@given(st.lists(st.lists(st.tuples(*[st.integers(-4, 0)] * 3), max_size=6), min_size=1, max_size=4), st.integers(0, 5))
def test_viterbi_against_all_labellings(texts, switch):
    first = np.cumsum([0, *map(len, texts)])
    scores = np.array([w for t in texts for w in t], dtype=np.float32).reshape(-1, 3)
    label = L.viterbi(first, scores, switch)
    for i, text in enumerate(texts):

        def value(path):
            return sum(w[k] for w, k in zip(text, path)) - switch * sum(a != b for a, b in zip(path, path[1:]))

        best = max(map(value, itertools.product(range(3), repeat=len(text))))
        assert value(label[first[i] : first[i + 1]].tolist()) == best


def test_n_grams_one_at_a_time():
    settings = L.Settings()
    alphabet = L.Alphabet()
    words = L.words_of(["Ähm, Ωa ähm", "a", None, ""], alphabet)
    spelled = ["ähm", "ω", "a", "ähm", "a"]
    assert words.first.tolist() == [0, 4, 5, 5, 5]
    assert ["".join(map(chr, words.points[a:b])) for a, b in zip(words.at, words.at[1:])] == spelled
    assert words.start.tolist() == [0, 5, 6, 8, 0] and words.stop.tolist() == [3, 6, 7, 11, 1]
    assert len(set(words.unique.tolist())) == 3
    owner, bucket = L.n_grams(words, np.arange(5), settings)
    own = [sorted(bucket[owner == i].tolist()) for i in range(5)]
    assert own[0] == own[3] and own[2] == own[4]
    # Of a word of n letters: n single letters, and of each greater size what fits between its edges.
    assert [len(x) for x in own] == [sum([n] + [max(0, n + 2 - k + 1) for k in (2, 3, 4)]) for n in (3, 1, 1, 3, 1)]


def test_script_narrows_candidates(spark):
    rows = [(i, "привет мир", "ru") for i in range(40)] + [(i, "прывет свет", "be") for i in range(40, 80)]
    rows += [(i, "hello world", "en") for i in range(80, 120)]
    model = L.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    allowed = L.candidates(model)
    cyrillic, latin, greek = (L.SCRIPT_NAMES.index(x) + 1 for x in ("cyrillic", "latin", "greek"))
    assert model.languages == ["be", "en", "ru"]
    assert allowed[cyrillic].tolist() == [True, False, True] and allowed[latin].tolist() == [False, True, False]
    assert allowed[greek].all()
    texts = ["zzz qqq", "щщщ", "hello world привет мир", "αβγ"]
    got = L.identified(spark.createDataFrame(list(enumerate(texts)), "i int, text string").coalesce(1), model)
    got = {r.i: r for r in got.collect()}
    assert got[0].lang_pred == "en" and got[1].lang_pred in ("ru", "be")
    spans = [(s.start, s.stop, s.lang) for s in got[2].spans]
    assert spans == [(0, 11, "en"), (12, 22, "ru")]


def test_spans_of_mixed_text(spark):
    """Long stretches in two languages of one script are told apart near their border, and the longer one wins."""
    docs = spark.read.parquet(f"{BASE}/documents.parquet")
    model = L.train(docs)
    sample = docs.where(F.length("text") > 1500).groupBy("lang").agg(F.min_by("text", F.xxhash64("doc_id")).alias("text"))
    texts = {r.lang: r.text[:1500] for r in sample.collect()}
    pairs = list(itertools.permutations(sorted(texts), 2))
    mixed = [(i, texts[a][:600] + " " + texts[b]) for i, (a, b) in enumerate(pairs)]
    for r in L.identified(spark.createDataFrame(mixed, "i int, text string"), model).collect():
        a, b = pairs[r.i]
        assert r.lang_pred == b
        own = sum(max(0, min(s.stop, 600) - s.start) for s in r.spans if s.lang == a)
        other = sum(max(0, s.stop - max(s.start, 600)) for s in r.spans if s.lang == b)
        assert own > 480 and other > 1300, (a, b, own, other)


def test_odd_inputs(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK", 50)
    rng = random.Random(5)
    rows = [(i, "".join(rng.choices("abcd ", k=30)), "x") for i in range(30)] + [(i, "".join(rng.choices("efgh ", k=30)), "y") for i in range(30, 60)]
    rows += [(None, "zz", "z"), (90, None, "z"), (91, "zz", None)]
    schema = "doc_id long, text string, lang string"
    model = L.train(spark.createDataFrame(rows, schema))
    assert model.languages == ["x", "y"]
    odd = [(1, None, "s"), (2, "", "s"), (3, "12 ... \n", "s"), (3, "12 ... \n", "s"), (None, "ab", "s"), (5, "efgh " * 40_000, "s"), (6, "e" * 200_000, "s"), (7, "\U00020000̀ ab", "s")]
    df = spark.createDataFrame(odd, "doc_id long, text string, score string")
    got = L.identified(df, model)
    assert got.columns == ["doc_id", "text", "score", "lang_pred", "spans"]
    rows = got.collect()
    assert len(rows) == len(odd)
    assert [r.lang_pred for r in rows if r.doc_id in (1, 2, 3)] == ["und"] * 4
    assert all(r.score == 0 and r.spans == [] for r in rows if r.lang_pred == "und")
    assert {r.doc_id: r.lang_pred for r in rows if r.doc_id in (None, 5, 6)} == {None: "x", 5: "y", 6: "y"}
    assert L.identified(df.limit(0), model).count() == 0
    none = L.train(spark.createDataFrame([], schema))
    assert {(r.lang_pred, r.score) for r in L.identified(df, none).collect()} == {("und", 0.0)}
