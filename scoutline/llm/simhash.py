"""SimHash near-duplicates with pivot distance tables.

Equal fingerprints are collapsed first. For each distinct fingerprint its Hamming distances to a set
of reference fingerprints, the pivots, are computed once. Two fingerprints within ``k`` bits differ by
at most ``k`` in every coordinate of that table, so any pair with a greater coordinate difference is
discarded, and the survivors are verified bit by bit.

The pairs that the tables are applied to come from an equi-join: of ``2k`` blocks of bits, two
fingerprints within ``k`` bits agree on ``k`` whole blocks at least, so they meet under one of the
combinations of ``k`` blocks. A pair counts under the first combination only. A fingerprint has at
most sum(C(64, i), i <= k) others within k bits (43,744 for 3), so links grow with the fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoutline.llm.graph import components
from scoutline.llm.words import small_batches
from scoutline.session import stored

BITS = 64
SEED = 42
PIVOTS = 16
#: Shingles whose bits are counted at a time.
CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of a text as a signed 64-bit number; 0 if it has no word."""
    words = text.encode("utf-8").lower().split() if text else []
    if not words:
        return 0
    size = min(shingle, len(words))
    ones, total = np.zeros(BITS, dtype=np.int64), len(words) - size + 1
    digest, join = xxhash.xxh64_digest, b" ".join
    for at in range(0, total, CHUNK):
        stop = min(total, at + CHUNK)
        parts = zip(*(words[at + i : stop + i] for i in range(size)))
        hashes = b"".join([digest(join(p), SEED) for p in parts])
        bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big", signed=True)


def fingerprints(text: Column, shingle: int) -> Column:
    """Fingerprints of a text column, computed where the rows lie."""

    @F.pandas_udf("bigint")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts.tolist()], dtype="int64")

    return compute(F.coalesce(text, F.lit("")))


def _blocks(k: int) -> list[int]:
    """Masks of 2k blocks of about equal size, as signed 64-bit numbers."""
    edges = [round(i * BITS / (2 * k)) for i in range(2 * k + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _table(fp: Column, half: int) -> Column:
    """Eight distances to pivots, one byte each."""
    parts = [
        F.shiftleft(_distance(fp, F.xxhash64(F.lit(half * 8 + j))).cast("bigint"), 8 * j) for j in range(8)
    ]
    return reduce(lambda x, y: x.bitwiseOR(y), parts)


def _coordinate(table: Column, j: int) -> Column:
    return F.shiftrightunsigned(table, 8 * j).bitwiseAND(F.lit(255).cast("bigint"))


def links(distinct: DataFrame, k: int) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct fingerprints ``fp`` that differ in at most k bits."""
    if k < 1:
        raise ValueError("k must be at least 1; equal fingerprints need no links")
    blocks = _blocks(k)
    united = lambda chosen: reduce(lambda x, y: x | y, (blocks[i] for i in chosen))
    tabled = distinct.select("fp", *[_table(F.col("fp"), h).alias(f"t{h}") for h in range(PIVOTS // 8)])
    keys = [
        F.struct(
            F.lit(n).alias("chosen"),
            F.lit(chosen[-1]).alias("last"),
            F.col("fp").bitwiseAND(F.lit(united(chosen)).cast("bigint")).alias("bits"),
        )
        for n, chosen in enumerate(combinations(range(2 * k), k))
    ]
    spread = tabled.select("*", F.inline(F.array(*keys)))
    left, right = spread.alias("l"), spread.drop("last").alias("r")
    differing = F.col("l.fp").bitwiseXOR(F.col("r.fp"))
    zero = F.lit(0).cast("bigint")
    equal_so_far = reduce(
        lambda x, y: x + y,
        [
            ((F.lit(i) <= F.col("l.last")) & (differing.bitwiseAND(F.lit(m).cast("bigint")) == zero)).cast("int")
            for i, m in enumerate(blocks)
        ],
    )
    coordinates = [
        F.abs(_coordinate(F.col(f"l.t{h}"), j) - _coordinate(F.col(f"r.t{h}"), j))
        for h in range(PIVOTS // 8)
        for j in range(8)
    ]
    met = (
        (F.col("l.chosen") == F.col("r.chosen"))
        & (F.col("l.bits") == F.col("r.bits"))
        & (F.col("l.fp") < F.col("r.fp"))
        & (F.greatest(*coordinates) <= k)
        & (equal_so_far == k)
    )
    survivors = left.join(right, met).select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))
    return survivors.filter(_distance(F.col("a"), F.col("b")) <= k)


def near_duplicates(docs: DataFrame, *, shingle: int = 3, k: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hexadecimal digits) and component_id.

    Words are runs of non-white-space, A-Z lower-cased; a shorter text is one shingle; a text without
    words, or NULL, has fingerprint zero and is linked like any other. The component is the smallest
    doc_id reachable over links of at most ``k`` bits; NULL ids are never smallest, a component of
    NULL ids only has a NULL id. Repeated rows come out repeatedly. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = stored(
        docs.select(F.col("doc_id"), fingerprints(F.col("text"), shingle).alias("fp")), "fingerprints"
    )
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    found = components(links(distinct.select("fp"), k))
    members = stored(
        found.join(distinct, found["node"] == distinct["fp"]).select("fp", "component", "first_id"), "members"
    )
    smallest = members.groupBy("component").agg(F.min("first_id").alias("reached"))
    reached = members.join(smallest, "component").select("fp", "reached")
    of_print = distinct.join(reached, "fp", "left").select(
        "fp", F.coalesce("reached", "first_id").alias("component_id")
    )
    # Written, as adaptive execution splits a hot fingerprint only where both sides of the join are dealt for it.
    of_print = stored(of_print, "components")
    return rows.join(of_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, *, shingle: int = 3, k: int = 3) -> DataFrame:
    """The rows of ``docs`` with the smallest id of each group of near-duplicates, all columns kept.

    Rows with equal id and text count once; rows without an id can't be told apart and stay.
    """
    judged = near_duplicates(docs, shingle=shingle, k=k)
    first = judged.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    kept = docs.filter(F.col("doc_id").isNotNull()).join(first, "doc_id", "left_semi")
    kept = kept.dropDuplicates(["doc_id", "text"])
    return kept.unionByName(docs.filter(F.col("doc_id").isNull())).select(*docs.columns)
