"""Sharding by jump consistent hashing, with gapless slots inside every shard.

The shard of a key is found by the published jump hash: a 64-bit linear congruential generator,
seeded with the key, makes ever larger jumps over the shard numbers, and the last number below the
shard count is the shard. There is no ring table, and with one shard more a key either stays or
moves into the new shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from scoutline.functions.values import bound
from scoutline.session import stored

# The generator of the published jump hash, and 2^31.
MULTIPLIER = 2862933555777941757
TWO_31 = 2147483648.0

#: A key makes about ln(shards) jumps, spread like a Poisson count: 256 jumps are never needed.
MOST_JUMPS = 256

_LIMB = (1 << 22) - 1
_M0, _M1, _M2 = MULTIPLIER & _LIMB, (MULTIPLIER >> 22) & _LIMB, MULTIPLIER >> 44


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _next_key(k: Column) -> Column:
    """key * MULTIPLIER + 1 modulo 2^64; the key is held as limbs of 22, 22 and 20 bits, so that
    no product leaves 63 bits and arithmetic that raises on overflow can be used."""
    low = k["k0"] * _M0 + 1
    middle = F.shiftrightunsigned(low, 22) + k["k0"] * _M1 + k["k1"] * _M0
    high = F.shiftrightunsigned(middle, 22) + k["k0"] * _M2 + k["k1"] * _M1 + k["k2"] * _M0
    return F.struct(
        low.bitwiseAND(_long(_LIMB)).alias("k0"),
        middle.bitwiseAND(_long(_LIMB)).alias("k1"),
        high.bitwiseAND(_long((1 << 20) - 1)).alias("k2"),
    )


def jump_shard(key: Column, shards: int) -> Column:
    """Shard 0 to ``shards - 1`` of a 64-bit key; a NULL key counts as 0.

    Text or composite keys are hashed to 64 bits first, for example with ``F.xxhash64``.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    whole = F.coalesce(key.cast("bigint"), _long(0))
    start = F.struct(
        whole.bitwiseAND(_long(_LIMB)).alias("k0"),
        F.shiftrightunsigned(whole, 22).bitwiseAND(_long(_LIMB)).alias("k1"),
        F.shiftrightunsigned(whole, 44).alias("k2"),
        _long(-1).alias("shard"),
        _long(0).alias("jump"),
    )

    def step(state: Column, _: Column) -> Column:
        def jumped(k: Column) -> Column:
            top = F.shiftleft(k["k2"], 11).bitwiseOR(F.shiftrightunsigned(k["k1"], 11))
            to = (state["jump"] + 1).cast("double") * (F.lit(TWO_31) / (top + 1).cast("double"))
            return F.struct(
                k["k0"].alias("k0"),
                k["k1"].alias("k1"),
                k["k2"].alias("k2"),
                state["jump"].alias("shard"),
                F.floor(to).cast("bigint").alias("jump"),
            )

        return F.when(state["jump"] < shards, bound(_next_key(state), jumped)).otherwise(state)

    last = F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, MOST_JUMPS))), start, step)
    return bound(
        last,
        lambda s: F.when(s["jump"] >= shards, s["shard"])
        .otherwise(F.raise_error(F.lit("jump hash did not end")).cast("bigint"))
        .cast("int"),
    )


def assign(rows: DataFrame, key: Column, shards: int, *, name: str = "shard") -> DataFrame:
    """Add the shard of every row; a column of that name is replaced. Nothing is shuffled."""
    return rows.withColumn(name, jump_shard(key, shards))


def with_slots(rows: DataFrame, order: list[str], *, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Add the gapless position of every row inside its shard, in the given order (NULLs first).

    The rows, which should be narrow, are dealt by ranges of (shard, order, row id), so that neither
    a large shard nor a repeated key lands in one task, and are numbered where they lie. Only one
    row per (shard, range) passes the window that turns these numbers into offsets. The numbered
    rows are written once, since a second computation could draw other ranges. Columns whose names
    start with an underscore are reserved.
    """
    keys = [shard, *order, "_row"]
    dealt = (
        rows.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("_row")
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_range", F.shiftrightunsigned("_at", 33))
    )
    numbered = stored(dealt, "slots")
    ranges = numbered.groupBy(shard, "_range").agg(
        F.count("*").alias("_n"), F.min("_at").alias("_first")
    )
    earlier = Window.partitionBy(shard).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select(
        F.col(shard).alias("_shard"),
        F.col("_range").alias("_of"),
        (F.coalesce(F.sum("_n").over(earlier), _long(0)) - F.col("_first")).alias("_shift"),
    )
    same = F.col(shard).eqNullSafe(F.col("_shard")) & (F.col("_range") == F.col("_of"))
    return (
        numbered.join(offsets, same)
        .withColumn(slot, F.col("_at") + F.col("_shift"))
        .drop("_at", "_range", "_shard", "_of", "_shift")
    )


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Document ids with size, text checksum, shard, slot, and the shard if one more were appended.

    A NULL text has size 1 and checksum 0, a NULL id the key 0; repeated rows get slots of their
    own. Other columns of ``docs`` are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows = assign(rows, F.col("doc_id"), shards)
    rows = assign(rows, F.col("doc_id"), shards + 1, name="grown_shard")
    # Written before it is dealt: finding the ranges reads its input twice, and texts are long.
    rows = stored(rows.withColumn("law", F.lit("key")), "shards")
    slotted = with_slots(rows, ["doc_id", "text_crc32", "size"])
    return slotted.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
