"""Jump hash against a plain loop, and its law: a new shard takes rows only into itself."""

import zlib
from collections import Counter

from scoutline.llm import queries, sharding
from tests.llm.conftest import SF


def jump(key, shards):
    key, at, to = key % 2**64, -1, 0
    while to < shards:
        at = to
        key = (key * sharding.MULTIPLIER + 1) % 2**64
        to = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


KEYS = [0, 1, 2, 3, 77, 10**9, 2**40 + 5, 2**62 - 1, 2**63 - 1, -1, -(2**63), -12345]


def test_jump_hash(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(k,) for k in KEYS], "k long")
    for shards in (1, 2, 3, 16, 17, 100, 5000):
        got = [r[0] for r in df.select(sharding.jump_shard(F.col("k"), shards)).collect()]
        assert got == [jump(k, shards) for k in KEYS]


def check(docs, got, shards=16):
    assert len(got) == len(docs)
    want = Counter(
        (
            d["doc_id"], len((d["text"] or "").encode()) + 1, zlib.crc32((d["text"] or "").encode()), "key",
            jump(d["doc_id"] or 0, shards), jump(d["doc_id"] or 0, shards + 1),
        )
        for d in docs
    )
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in got) == want
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_query(spark, tables):
    got = queries.op10_sharding(spark, SF).collect()
    check(tables("documents"), got)
    assert all(r.grown_shard in (r.shard, 16) for r in got)


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(None, None, 1, "a"), (None, "é", 2, "b"), (5, "same", 3, "c"), (5, "same", 3, "c"), (6, "", 0, "d")] + [(7, "x", 1, "e")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard long, slot string")
    check([{"doc_id": r[0], "text": r[1]} for r in rows], sharding.shard_documents(docs).collect())


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.shard_documents(docs).count() == 0
