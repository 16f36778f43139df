"""Edit distance against a table, recall and precision against brute force over all windows."""

import random

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from scoutline.llm import decontamination as D
from scoutline.llm import queries
from tests.llm.conftest import SF


def least_edits(item, text):
    """Least edits between the item and any part of the text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        above, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(above[j - 1] + (a != b), above[j] + 1, row[j - 1] + 1))
    return min(row)


def prefix_edits(item, window):
    row = list(range(len(window) + 1))
    for i, a in enumerate(item, 1):
        above, row = row, [i]
        for j, b in enumerate(window, 1):
            row.append(min(above[j - 1] + (a != b), above[j] + 1, row[j - 1] + 1))
    return min(row)


@given(st.lists(st.integers(0, 4), min_size=1, max_size=20), st.lists(st.integers(0, 4), max_size=30), st.integers(0, 8))
def test_edit_distance(item, window, most):
    a, b = np.array(item, dtype=np.uint64), np.array(window, dtype=np.uint64)
    want = prefix_edits(item, window[: len(item) + most])
    assert D.edit_distance(a, b, most) == min(want, most + 1)


def frames(spark, docs, items):
    return (
        spark.createDataFrame(docs, "doc_id long, text string, distance string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )


def test_recall_and_precision(spark):
    rng = random.Random(9)
    words = [f"v{i}" for i in range(400)]
    items = {i: rng.choices(words, k=rng.randint(8, 60)) for i in range(40)}
    docs, edits = [], {}
    for doc_id in range(300):
        text = rng.choices(words, k=rng.randint(20, 120))
        if doc_id % 3:
            item = rng.randrange(40)
            copy = list(items[item])
            for _ in range(rng.randint(0, int(0.2 * len(copy)))):
                at = rng.randrange(len(copy))
                kind = rng.randrange(3)
                copy[at : at + (kind != 1)] = [rng.choice(words)] if kind else []
            at = rng.randrange(len(text))
            text[at:at] = [w.upper() for w in copy]
        docs.append((doc_id, " \n".join(text), "old"))
        edits[doc_id] = [t.lower() for t in text]
    want = {}
    for doc_id, text in edits.items():
        for item, own in items.items():
            n = least_edits(own, text)
            if n <= int(0.2 * len(own)):
                want[doc_id, item] = n
    got = {(r.doc_id, r.item_id): r for r in D.contaminated(*frames(spark, docs, [(i, " ".join(w)) for i, w in items.items()])).collect()}
    assert set(got) <= set(want)
    assert len(got) >= 0.95 * len(want) and len(want) > 150
    assert np.mean([got[p].distance == want[p] for p in got]) > 0.95
    exact = [p for p, n in want.items() if n == 0]
    assert exact and all(p in got and got[p].distance == 0 for p in exact)


def test_recall_at_the_most_edits(spark):
    """Every kind of edit, spread over items of every length, exactly as many as allowed."""
    rng, items, docs = random.Random(10), {}, []
    words = [f"v{i}" for i in range(20_000)]
    for n in (8, 10, 15, 20, 40, 80, 160):
        for kind in ("change", "insert", "delete"):
            for _ in range(15):
                own, copy = rng.sample(words, n), []
                edited = set(rng.sample(range(n), int(0.2 * n)))
                for i, w in enumerate(own):
                    copy += [w] if i not in edited else {"change": ["new"], "insert": ["new", w], "delete": []}[kind]
                items[len(items)] = " ".join(own)
                docs.append((len(docs), " ".join([*rng.sample(words, 30), *copy, *rng.sample(words, 30)]), ""))
    got = {(r.doc_id, r.item_id) for r in D.contaminated(*frames(spark, docs, list(items.items()))).collect()}
    assert got == {(i, i) for i in items}


KINDS = ("change", "insert", "delete")


@pytest.mark.parametrize("number", range(5))
def test_agreement_of_walks(number):
    """By class and kind of edit: how often a walk agrees at the most edits, and how often one of all walks does."""
    s = D.Settings()
    length, draw = s.longest(number), np.random.default_rng(number)
    k, walks = s.allowed(length), D.repetitions(number, s)
    for kind in KINDS:
        agree, met = [], 0
        for _ in range(300):
            own = draw.integers(1, 1 << 62, size=length, dtype=np.uint64)
            copy = np.append(D.edited(own, kind, k, draw), draw.integers(1, 1 << 62, size=length, dtype=np.uint64))
            both = np.concatenate((own, copy))
            a, b = D._walks(both, np.array([0, length]), np.array([length, len(both)]), number, walks, s)
            agree.append((a == b).mean())
            met += (a == b).any()
        assert np.mean(agree) > 0.15 and met >= 0.95 * 300, (kind, np.mean(agree), met)


def test_walks_of_equal_and_of_unrelated_words():
    s, draw = D.Settings(), np.random.default_rng(3)
    words = draw.integers(1, 1 << 62, size=400, dtype=np.uint64)
    words[200:220] = words[40:60]
    a, b, c = D._walks(words, np.array([40, 200, 300]), np.array([60, 260, 400]), 4, 27, s)
    assert (a == b).all() and not (a == c).any()


def test_recall_of_walks_alone(spark, monkeypatch):
    """Without the second way, by pieces, at exactly the most edits: of all items the share that is wanted, and of
    each kind and length most."""
    real = D.pairs_of
    monkeypatch.setattr(D, "pairs_of", lambda kinds, blocks, rare, keys, s: real(kinds.limit(0) if keys == "pieces" else kinds, blocks, rare, keys, s))
    rng, items, docs, kind_of = random.Random(20), {}, [], {}
    words = [f"v{i}" for i in range(20_000)]
    for n in (8, 10, 15, 20, 40, 80, 160):
        for kind in KINDS:
            for _ in range(25):
                own, copy = rng.sample(words, n), []
                edited = set(rng.sample(range(n), int(0.2 * n)))
                for i, w in enumerate(own):
                    copy += [w] if i not in edited else {"change": ["new"], "insert": ["new", w], "delete": []}[kind]
                kind_of[len(items)] = (n, kind)
                items[len(items)] = " ".join(own)
                docs.append((len(docs), " ".join([*rng.sample(words, 30), *copy, *rng.sample(words, 30)]), ""))
    got = {r.doc_id for r in D.contaminated(*frames(spark, docs, list(items.items()))).collect() if r.doc_id == r.item_id}
    assert len(got) >= 0.96 * len(items)
    share = {k: sum(i in got for i in items if kind_of[i] == k) / 25 for k in kind_of.values()}
    assert min(share.values()) >= 0.8, share


def pairs_verified(spark, monkeypatch, n):
    """How many pairs of windows and blocks are verified for n items and n documents that share a template."""
    template = [f"t{i}" for i in range(18)]
    items = [(i, " ".join([*template, *[f"i{i}x{j}" for j in range(5)]])) for i in range(n)]
    docs = [(i, " ".join([*[f"d{i}y{j}" for j in range(9)], *template, *[f"d{i}x{j}" for j in range(15)]]), "") for i in range(n)]
    docs.append((n, "see " + items[3][1], ""))
    counted, real = [], D._verified

    def verified(pairs, kinds, blocks, settings):
        counted.append(pairs.count())
        return real(pairs, kinds, blocks, settings)

    monkeypatch.setattr(D, "_verified", verified)
    got = {(r.doc_id, r.item_id) for r in D.contaminated(*frames(spark, docs, items)).collect()}
    monkeypatch.setattr(D, "_verified", real)
    assert got == {(n, 3)}
    return sum(counted)


def test_a_shared_template_makes_no_quadratic_pairs(spark, monkeypatch):
    few, many = (pairs_verified(spark, monkeypatch, n) for n in (100, 200))
    assert many <= 2.2 * few + 50 and many < 200 * 200 / 4, (few, many)


def test_rare_words_lose_no_pair(spark):
    """Keys that all blocks share ask for a rare word: the same is found as without."""
    rng = random.Random(30)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(["what", "is", "the", "best", "way", "to", *rng.choices(words, k=rng.randint(6, 30)), "?"])) for i in range(60)]
    docs = []
    for i in range(150):
        copy = items[rng.randrange(60)][1].split()
        for _ in range(rng.randint(0, int(0.25 * len(copy)))):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        docs.append((i, " ".join([*rng.choices(words, k=10), *copy, *rng.choices(words, k=10)]), ""))
    got = [
        sorted(tuple(r) for r in D.contaminated(*frames(spark, docs, items), D.Settings(bucket=b)).collect()) for b in (0, 10**6)
    ]
    assert got[0] == got[1] and len(got[0]) > 80


def test_blocks():
    s = D.Settings()
    for n in range(1, 400):
        blocks = s.blocks(n)
        assert blocks[0][0] == 0 and blocks[-1][1] == n and all(a[1] == b[0] for a, b in zip(blocks, blocks[1:]))
        lengths = [b - a for a, b in blocks]
        assert max(lengths) <= 20 and (len(lengths) == 1 or min(lengths) >= 10)
        # However the edits lie, one block has no more than it may have.
        assert s.allowed(n) < sum(s.allowed(x) + 1 for x in lengths)


def test_short_items_word_for_word(spark):
    items = [(n, " ".join(f"s{n}x{i}" for i in range(n))) for n in range(1, 8)]
    docs = [(n, f"some words {t.upper()} and more", "") for n, t in items] + [(10 + n, t, "") for n, t in items]
    docs += [(20 + n, f"before {t.rsplit(' ', 1)[0]} not the last", "") for n, t in items if n > 1]
    got = {(r.doc_id, r.item_id, r.distance, r.start, r.item_words) for r in D.contaminated(*frames(spark, docs, items)).collect()}
    assert got == {(n, n, 0, 2, n) for n, _ in items} | {(10 + n, n, 0, 0, n) for n, _ in items}


def test_query_finds_every_whole_item(spark, tables):
    found = {(r.doc_id, r.item_id) for r in queries.op7_decontamination(spark, SF).collect()}
    items = {b["item_id"]: b["text"].lower().split() for b in tables("benchmark")}
    for d in tables("documents"):
        text = " " + " ".join(d["text"].lower().split()) + " "
        for item, own in items.items():
            if f" {' '.join(own)} " in text:
                assert (d["doc_id"], item) in found
    docs = {d["doc_id"]: d["text"].lower().split() for d in tables("documents")}
    for doc_id, item in found:
        assert least_edits(items[item], docs[doc_id]) <= 0.2 * len(items[item])


def test_odd_inputs(spark):
    item = " ".join(f"q{i}" for i in range(20))
    docs = [(1, None, "a"), (2, "", "a"), (3, item, "a"), (3, item, "a"), (None, "x " + item, "b"), (4, "y " * 50_000 + item + " z" * 500, "c"), (5, item.replace(" ", "\t"), "d")]
    items = [(7, item), (8, item.upper()), (9, None), (10, ""), (11, "too short"), (None, item)]
    got = sorted(((r.doc_id or 0, r.item_id or 0, r.distance, r.start) for r in D.contaminated(*frames(spark, docs, items)).collect()))
    assert got == sorted((d, i, 0, s) for d, s in ((3, 0), (0, 1), (4, 50_000), (5, 0)) for i in (7, 8, 0))
    left = D.without_contaminated(*frames(spark, docs, items))
    assert left.columns == ["doc_id", "text", "distance"]
    assert sorted(r.doc_id for r in left.collect()) == [1, 2]
    assert D.contaminated(*frames(spark, [], items)).count() == 0
    assert D.contaminated(*frames(spark, docs, [])).count() == 0
    assert D.without_contaminated(*frames(spark, docs, [])).count() == len(docs)
