"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted, each with a cost. Pieces are packed in falling size: a piece
goes where the least room is left after it, and where nothing fits a bin is opened. Which size to
open is decided jointly for a whole group: each policy "open at least size c" and "open the size with
the least cost per unit" is packed in full, every bin is then downsized to the smallest length that
holds its contents, and the policy with the least total cost stays.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoutline.session import stored


@dataclass(frozen=True)
class Lengths:
    """Permitted lengths, the fixed cost of a sequence, and the cost of a unit of length. The fixed
    part makes long sequences pay off, the unit part makes empty room cost."""

    capacities: tuple[int, ...] = (256, 512, 1024, 2048, 4096)
    per_bin: float = 16.0
    per_unit: float = 1.0

    def cost(self, capacity: int) -> float:
        return self.per_bin + self.per_unit * capacity


def _pack_once(sizes: list[int], lengths: Lengths, least: int) -> tuple[list[int], list[int], float]:
    """(bin of each piece, contents of each bin, total cost) when bins of at least ``least`` are opened.

    Bins wait in one stack per free room; a bit mask of the rooms that have bins finds the tightest.
    """
    waiting: dict[int, list[int]] = {}
    mask, places, used, room = 0, [], [], []
    sizes_up = sorted(lengths.capacities)
    for size in sizes:
        fits = mask >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            stack = waiting[free]
            number = stack.pop()
            if not stack:
                mask &= ~(1 << free)
        else:
            number = len(used)
            free = next(c for c in sizes_up if c >= max(size, least))
            used.append(0)
            room.append(free)
        used[number] += size
        left = free - size
        if left:
            waiting.setdefault(left, []).append(number)
            mask |= 1 << left
        places.append(number)
    down = [next(c for c in sizes_up if c >= u) for u in used]
    return places, down, sum(map(lengths.cost, down))


def pack(sizes: list[int], lengths: Lengths) -> tuple[list[int], list[int], float]:
    """The cheapest packing over all opening policies; ``sizes`` fall and none exceeds the largest length."""
    best = None
    cheapest = min(lengths.capacities, key=lambda c: (lengths.cost(c) / c, c))
    for least in [cheapest, *sorted(lengths.capacities, reverse=True)]:
        found = _pack_once(sizes, lengths, least)
        if best is None or found[2] < best[2]:
            best = found
    return best


#: Pieces that are packed together; the waste of a group's last bins is spread over so many.
GROUP_PIECES = 20_000

PACKED = (
    "doc_id string, piece int, first_unit bigint, n_units bigint, "
    "bin_group int, bin_no int, bin_capacity int, bin_offset int"
)


def pieces(docs: DataFrame, length: Column, lengths: Lengths) -> DataFrame:
    """(doc_id, piece, first_unit, n_units): documents cut at the largest permitted length, none lost.

    A document of length zero or NULL is one empty piece.
    """
    most = max(lengths.capacities)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(length.cast("bigint"), F.lit(0).cast("bigint")).alias("n"))
    last = F.greatest(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / most))
    cut = rows.select("doc_id", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("piece"))
    first = F.col("piece") * most
    return cut.select(
        "doc_id",
        F.col("piece").cast("int").alias("piece"),
        first.alias("first_unit"),
        F.least(F.col("n") - first, F.lit(most).cast("bigint")).alias("n_units"),
    )


def pack_documents(docs: DataFrame, length: Column, lengths: Lengths = Lengths()) -> DataFrame:
    """One row per piece of a document with its bin: bin_group, bin_no, bin_capacity and bin_offset.

    Groups of about GROUP_PIECES pieces are drawn by a hash of piece and row, so their number grows
    with the corpus, equal or hot documents spread over all of them, and one task holds one group.
    Only ids and lengths are shuffled. Empty pieces take no room: they lie in bins like all others, at
    offset 0 of a bin of their own group. Repeated rows are packed repeatedly; a NULL id is kept.
    """
    if not lengths.capacities or min(lengths.capacities) < 1:
        raise ValueError("capacities must be positive")
    cut = pieces(docs, length, lengths).withColumn("_row", F.monotonically_increasing_id())
    cut = stored(cut, "pieces")
    groups = max(1, math.ceil(cut.count() / GROUP_PIECES))
    # Ids travel as text: Pandas would turn whole numbers next to NULL into floating-point ones.
    cut = cut.withColumn("doc_id", F.col("doc_id").cast("string"))
    dealt = cut.withColumn("bin_group", F.pmod(F.xxhash64("doc_id", "piece", "_row"), F.lit(groups)).cast("int"))

    def pack_group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n_units", "doc_id", "piece", "_row"], ascending=[False, True, True, True], ignore_index=True)
        some = rows.n_units > 0
        places, capacities, _ = pack(rows.n_units[some].tolist(), lengths)
        if not capacities:
            capacities = [min(lengths.capacities)]
        filled, offsets = [0] * len(capacities), []
        for place, size in zip(places, rows.n_units):
            offsets.append(filled[place])
            filled[place] += int(size)
        rest = len(rows) - len(places)
        rows["bin_no"] = places + [0] * rest
        rows["bin_capacity"] = [capacities[p] for p in rows.bin_no]
        rows["bin_offset"] = offsets + [0] * rest
        return rows.drop(columns="_row")[[c.split()[0] for c in PACKED.split(", ")]]

    packed = dealt.groupBy("bin_group").applyInPandas(pack_group, PACKED)
    return packed.withColumn("doc_id", F.col("doc_id").cast("bigint"))
