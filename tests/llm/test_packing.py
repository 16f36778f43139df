"""Packing against a plain best-fit loop, and its invariants on whole tables."""

import random

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scoutline.llm import packing as P
from scoutline.llm import queries
from tests.llm.conftest import SF

LENGTHS = P.Lengths((8, 16, 32), per_bin=1.0)


def plain(sizes, lengths, least):
    """Best fit by looking at every bin: of the tightest the one used last."""
    bins, places = [], []
    for size in sizes:
        fitting = [(b["free"], -b["used_at"], n) for n, b in enumerate(bins) if b["free"] >= size]
        if fitting:
            n = min(fitting)[2]
        else:
            n = len(bins)
            capacity = min(c for c in lengths.capacities if c >= max(size, least))
            bins.append({"free": capacity, "used": 0})
        bins[n]["free"] -= size
        bins[n]["used"] += size
        bins[n]["used_at"] = len(places)
        places.append(n)
    down = [min(c for c in lengths.capacities if c >= b["used"]) for b in bins]
    return places, down, sum(map(lengths.cost, down))


@given(st.lists(st.integers(1, 32), max_size=60))
def test_against_a_plain_loop(sizes):
    sizes.sort(reverse=True)
    for least in LENGTHS.capacities:
        assert P._pack_once(sizes, LENGTHS, least) == plain(sizes, LENGTHS, least)
    best = P.pack(sizes, LENGTHS)[2]
    assert best == min(plain(sizes, LENGTHS, c)[2] for c in LENGTHS.capacities)


def check(rows, want, lengths):
    """``want``: the length of every document. All units are placed once, in bins that hold them."""
    bins, units = {}, {}
    for r in rows:
        units.setdefault(r.doc_id, []).append((r.first_unit, r.n_units))
        bins.setdefault((r.bin_group, r.bin_no), []).append(r)
    assert {d: sum(n for _, n in parts) for d, parts in units.items()} == want
    for parts in units.values():
        at = 0
        for first, n in sorted(parts):
            assert first == at
            at += n
    for held in bins.values():
        at = 0
        for r in sorted((r for r in held if r.n_units), key=lambda r: r.bin_offset):
            assert r.bin_offset == at
            at += r.n_units
        assert {r.bin_capacity for r in held} == {min(c for c in lengths.capacities if c >= at)}


def test_query(spark, tables):
    rows = queries.op4_best_fit_packing(spark, SF).collect()
    want = {d["doc_id"]: len(d["text"].encode().split()) for d in tables("documents")}
    check(rows, {d: n + 1 if n else 0 for d, n in want.items()}, P.Lengths())


def test_many_groups(spark, monkeypatch):
    monkeypatch.setattr(P, "GROUP_PIECES", 50)
    rng = random.Random(4)
    sizes = {i: rng.choice([0, 1, 5, 31, 32, 33, 100]) for i in range(700)}
    docs = spark.createDataFrame(list(sizes.items()), "doc_id long, n long")
    rows = P.pack_documents(docs, F.col("n"), LENGTHS).collect()
    assert len({r.bin_group for r in rows}) > 10
    check(rows, sizes, LENGTHS)


def test_nulls_repeats_and_clashing_columns(spark):
    docs = spark.createDataFrame([(None, 3, 1), (1, None, 1), (1, None, 1), (2, 40, 9), (2, 40, 9)], "doc_id long, n long, piece long")
    rows = P.pack_documents(docs, F.col("n"), LENGTHS).collect()
    assert sorted((r.doc_id or 0, r.piece, r.first_unit, r.n_units) for r in rows) == [
        (0, 0, 0, 3), (1, 0, 0, 0), (1, 0, 0, 0), (2, 0, 0, 32), (2, 0, 0, 32), (2, 1, 32, 8), (2, 1, 32, 8),
    ]
    assert P.pack_documents(docs.limit(0), F.col("n"), LENGTHS).count() == 0
