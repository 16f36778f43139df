"""Running counts and unbroken runs over ordered blocks, so that no window ever sees all rows at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from scoutline.session import stored


def running_before(
    counts: DataFrame, outer: str, inner: str | None = None, *, descending: bool = False
) -> DataFrame:
    """Add ``before``: the sum of ``n`` over all earlier blocks.

    ``counts`` has one row per block (outer, inner) with its size ``n``. Only one row per
    ``outer`` value passes through one task, so ``outer`` must have few values (large blocks,
    scores, hash prefixes); the blocks of one outer value are summed in a window of their own.
    """
    order = F.col(outer).desc() if descending else F.col(outer).asc()
    earlier = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    if inner is None:
        return counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), zero))
    totals = counts.groupBy(outer).agg(F.sum("n").alias("outer_n"))
    totals = totals.select(outer, F.coalesce(F.sum("outer_n").over(earlier), zero).alias("before"))
    within = Window.partitionBy(outer).orderBy(inner).rowsBetween(Window.unboundedPreceding, -1)
    return (
        counts.withColumn("inner_before", F.coalesce(F.sum("n").over(within), zero))
        .join(totals, outer)
        .withColumn("before", F.col("before") + F.col("inner_before"))
        .drop("inner_before")
    )


def position(
    rows: DataFrame,
    outer: str,
    order: Sequence[Column | str],
    inner: str | None = None,
    *,
    descending: bool = False,
    name: str = "position",
    written: bool = False,
) -> DataFrame:
    """Zero-based position of every row in the order (outer, inner, ``order``).

    Each block is numbered on its own and shifted by the size of the blocks before it. That reads ``rows`` twice;
    with ``written`` the numbered rows become a table first, from which the sizes are read, so ``rows`` is read once.
    """
    block = [outer] if inner is None else [outer, inner]
    numbered = rows.withColumn(
        "in_block", F.row_number().over(Window.partitionBy(*block).orderBy(*order))
    )
    if written:
        numbered = stored(numbered, "numbered")
        counts = numbered.groupBy(*block).agg(F.max("in_block").cast("bigint").alias("n"))
    else:
        counts = rows.groupBy(*block).agg(F.count("*").alias("n"))
    offsets = running_before(counts, outer, inner, descending=descending).select(*block, "before")
    return (
        numbered.join(offsets, block)
        .withColumn(name, F.col("before") + F.col("in_block") - 1)
        .drop("before", "in_block")
    )


def chain_ends(
    rows: DataFrame, chain: Sequence[str], place: str, broken: Column, last: Column, block_bits: int = 14
) -> DataFrame:
    """The first place of each chain that is no longer part of it: (chain columns, end), NULL if all of it is whole.

    A chain counts its places from 0. It ends before a ``broken`` row, before a place whose predecessor is missing, and
    after a ``last`` row. Gaps are found by one window over blocks of 2^block_bits places, so that one long chain
    is many partitions; what is left to one task is a row per block of a chain. Rows may repeat.
    """
    block = F.shiftright(F.col(place).cast("bigint"), block_bits)
    narrow = rows.where(F.col(place).isNotNull()).select(
        *chain, block.alias("block"), F.col(place).alias("place"), broken.alias("broken"), last.alias("last")
    )
    before = F.lag("place").over(Window.partitionBy(*chain, "block").orderBy("place"))
    own = F.least(
        F.when(F.col("broken"), F.col("place")),
        F.when(F.col("last"), F.col("place") + 1),
        F.when(F.col("place") - before > 1, F.col("place")),
    )
    blocks = (
        narrow.withColumn("own", own)
        .groupBy(*chain, "block")
        .agg(F.min("place").alias("low"), F.max("place").alias("high"), F.min("own").alias("own"))
    )
    reached = F.coalesce(F.lag("high").over(Window.partitionBy(*chain).orderBy("block")), F.lit(-1))
    gap = F.when(F.col("low") - reached > 1, F.col("low"))
    return blocks.withColumn("end", F.least("own", gap)).groupBy(*chain).agg(F.min("end").alias("end"))


def unbroken(
    rows: DataFrame, chain: Sequence[str], place: str, broken: Column, last: Column, block_bits: int = 14
) -> DataFrame:
    """The rows of each chain up to its end, see :func:`chain_ends`; rows without a place are left out.

    ``rows`` is read twice, once for the narrow columns that decide, so give a stored table.
    """
    ends = chain_ends(rows, chain, place, broken, last, block_bits)
    ends = ends.select(*[F.col(c).alias(f"_{c}") for c in chain], "end")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in chain]
    return (
        rows.join(ends, same)
        .where(F.col("end").isNull() | (F.col(place) < F.col("end")))
        .where(F.col(place).isNotNull())
        .drop("end", *[f"_{c}" for c in chain])
    )
