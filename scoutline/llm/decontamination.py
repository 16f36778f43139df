"""Benchmark decontamination: CGK embedding, bit-sampling LSH and exact edit verification, over words.

Long items are cut into blocks of at most ``block`` words; of an item with ``e`` edits one of ``B`` blocks has no more than
its share of them, ``e / B``. The CGK random walk reads a block step by step and moves on, or not, by a random function of
the step and the word read; sequences a few edits apart fall into step again soon, so edit distance becomes Hamming
distance between the words read. Each repetition samples a few steps of its own walk as a key; keys of blocks and of
windows of their size meet in an equi-join, and every pair that met is verified by edit distance, block by block and
then over the whole item. How often is measured: the walks of each class of lengths are tried on random sequences with
as many changes, insertions or deletions as are allowed, and repeated until all kinds have the recall wanted.

A key that many blocks share, as of a question template, asks for more: of the words of a block that are rarest
in the benchmark one more than edits are allowed, one must be in the window as well. So pairs grow with the
windows, not with items times windows, unless the items are alike.

What the walks miss: a block in which ``e`` edits are allowed is also cut into ``e + 1`` pieces, of which one is whole. Windows
in which no block was found meet the blocks by their pieces.

Windows start at every word where a block could begin. With at most ``k`` edits the first ``m`` words
of a block leave at least ``m - 1 - 2k`` of its word pairs whole, and the first word that is no edit is
one of the block's first ``k + 1``; other starts are passed over. Pairs, first words and pieces are looked up in
bit tables of fixed size, three for each class of block lengths, which only err towards more windows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoutline.llm.words import hashed_words, in_blocks, mixed, small_batches
from scoutline.session import stored

_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """An item is found where at most ``edits`` of its words differ. Items of fewer than ``min_words``
    words are found where all their words are; each of their lengths is a class. A key samples ``sampled`` steps of
    a walk, and walks are repeated for ``recall``. A key of more than ``bucket`` blocks asks for a rare word as well.
    ``slots`` bounds what is broadcast to keep texts that are not wanted from moving."""

    edits: float = 0.2
    min_words: int = 8
    block: int = 20
    sampled: int = 3
    recall: float = 0.97
    class_ratio: float = 1.25
    table_bits: int = 20
    bucket: int = 16
    slots: int = 1 << 20

    def allowed(self, words: int) -> int:
        return math.floor(self.edits * words + 1e-9) if words >= self.min_words else 0

    def blocks(self, words: int) -> list[tuple[int, int]]:
        """Places and ends of the blocks of an item."""
        number = -(-words // self.block)
        ends = [words * j // number for j in range(number + 1)]
        return list(zip(ends, ends[1:]))

    def piece(self, words: int) -> int:
        """Words of a piece of a block: one more piece than edits."""
        return words // (self.allowed(words) + 1)

    def pieces(self, number: int) -> list[int]:
        """All lengths of pieces in a class."""
        return sorted({self.piece(n) for n in range(self.shortest(number), self.longest(number) + 1)})

    def class_of(self, words: int) -> int:
        if words < self.min_words:
            return words - self.min_words
        return math.floor(math.log(words / self.min_words) / math.log(self.class_ratio) + 1e-9)

    def shortest(self, number: int) -> int:
        if number < 0:
            return self.min_words + number
        return math.ceil(self.min_words * self.class_ratio**number - 1e-9)

    def longest(self, number: int) -> int:
        return self.shortest(number + 1) - 1


def _pairs(hashes: np.ndarray) -> np.ndarray:
    return mixed(hashes[:-1] * _ODD + hashes[1:])


def _grams(words: np.ndarray, size: int, number: int) -> np.ndarray:
    """Hashes of all stretches of so many words, in a class."""
    found = np.full(max(0, len(words) - size + 1), 100 * number + size, dtype=np.int64).view(np.uint64)
    for i in range(size):
        found = mixed(found * _ODD + words[i : i + len(found)])
    return found


def _walks(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, number: int, repetitions: int, settings: Settings) -> np.ndarray:
    """Keys (start, repetition) of walks over ``words`` from the starts; what lies beyond the ends reads as 0.

    A walk has as many steps as the shortest block of its class has words, so equal blocks have equal keys.
    """
    steps = settings.shortest(number)
    draw = np.random.default_rng((11, number + 100))
    odds = draw.integers(0, 1 << 63, size=(steps, 512), dtype=np.uint64)[:, :repetitions, None] * np.uint64(2) + np.uint64(1)
    chosen = np.stack([draw.choice(steps, size=min(settings.sampled, steps), replace=False) for _ in range(repetitions)])
    padded = np.append(words, np.uint64(0))
    keys = np.repeat(mixed(np.arange(repetitions, dtype=np.uint64) + np.uint64(1000 * (number + 100)))[:, None], len(starts), axis=1)
    at = np.repeat(starts[None, :], repetitions, axis=0)
    for t in range(steps):
        symbol = padded[np.where(at < ends, at, len(words))]
        taken = (chosen == t).any(axis=1)
        if taken.any():
            keys[taken] = mixed(keys[taken] * _ODD + symbol[taken])
        at = at + (mixed(symbol * odds[t]) >> np.uint64(63)).astype(np.int64)
    return keys.T


def edited(words: np.ndarray, kind: str, number: int, draw: np.random.Generator) -> np.ndarray:
    """The words with so many of them changed or deleted, or so many inserted, at random places."""
    places = np.sort(draw.choice(len(words), size=number, replace=False))
    fresh = draw.integers(1, 1 << 62, size=number, dtype=np.uint64)
    if kind == "delete":
        return np.delete(words, places)
    if kind == "insert":
        return np.insert(words, places, fresh)
    changed = words.copy()
    changed[places] = fresh
    return changed


@lru_cache
def repetitions(number: int, settings: Settings, trials: int = 200, most: int = 512) -> int:
    """How many walks give the wanted recall for blocks of a class at the most edits, for every kind of edit.

    Measured on random sequences: of each trial the share of walks whose keys agree tells how likely it is
    that one of so many does.
    """
    length = settings.longest(number)
    k = settings.allowed(length)
    if not k:
        return 1
    draw, tried = np.random.default_rng((13, number + 100)), min(most, 64)
    shares = []
    for kind in ("change", "insert", "delete"):
        own = draw.integers(1, 1 << 62, size=(trials, length), dtype=np.uint64)
        agree = np.empty(trials)
        for i in range(trials):
            copy = np.append(edited(own[i], kind, k, draw), draw.integers(1, 1 << 62, size=length, dtype=np.uint64))
            both = np.concatenate((own[i], copy))
            starts, ends = np.array([0, length]), np.array([length, len(both)])
            a, b = _walks(both, starts, ends, number, tried, settings)
            agree[i] = (a == b).mean()
        shares.append(agree)
    for n in range(1, most):
        if all(np.mean(1 - (1 - s) ** n) >= settings.recall for s in shares):
            return n
    return most


def edit_distance(item: np.ndarray, window: np.ndarray, most: int) -> int:
    """Least number of word edits between the item and any prefix of the window, ``most + 1`` if more.

    Bit-parallel over the item: one big integer holds a column of the table.
    """
    n = len(item)
    masks: dict[int, int] = {}
    for i, word in enumerate(item.tolist()):
        masks[word] = masks.get(word, 0) | (1 << i)
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score = full, 0, n
    best = n
    for word in window.tolist()[: n + most]:
        equal = masks.get(word, 0)
        diagonal = ((((equal & plus) + plus) ^ plus) | equal | minus) & full
        up = minus | (~(diagonal | plus) & full)
        down = plus & diagonal
        score += bool(up & top) - bool(down & top)
        # The first row counts words of the window, as the window starts where the item does.
        up = ((up << 1) | 1) & full
        down = (down << 1) & full
        plus = (down | (~(diagonal | up) & full)) & full
        minus = up & diagonal
        best = min(best, score)
    return min(best, most + 1)


def _slots(hashes: np.ndarray, settings: Settings) -> np.ndarray:
    return (hashes >> np.uint64(64 - settings.table_bits)).astype(np.int64)


BLOCKS = (
    "item_id string, item_words int, place int, class_no int, n int, words binary, walks array<bigint>, pieces array<bigint>, slots array<bigint>"
)


def _block_rows(settings: Settings, walks: dict[int, int]):
    """The blocks of every item with their keys, and their places in the bit tables."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = hashed_words(batch.text.tolist(), fold=True)
            out = []
            for i, item_id in enumerate(batch.item_id):
                whole = words.hash[words.first[i] : words.first[i + 1]]
                if not len(whole):
                    continue
                for place, end in settings.blocks(len(whole)):
                    own = whole[place:end]
                    number = settings.class_of(len(own))
                    keys = _walks(own, np.zeros(1, np.int64), np.array([len(own)]), number, walks[number], settings)[0]
                    size = settings.piece(len(own))
                    pieces = _grams(own, size, number)[: size * (settings.allowed(len(own)) + 1) : size]
                    heads = own[: settings.allowed(len(own)) + 1]
                    # One table after the other: the slots of pairs, those of first words, those of pieces.
                    slots = np.append(_slots(_pairs(own), settings), _slots(heads, settings) + (1 << settings.table_bits))
                    slots = np.append(slots, _slots(pieces, settings) + (2 << settings.table_bits))
                    out.append(
                        (
                            item_id, len(whole), place, number, len(own), own.tobytes(), np.unique(keys.view(np.int64)).tolist(),
                            np.unique(pieces.view(np.int64)).tolist(), np.unique(slots).tolist(),
                        )
                    )
            yield pd.DataFrame(out, columns=[c.split()[0] for c in BLOCKS.split(", ")])

    return rows


def _bit_tables(items: DataFrame, settings: Settings) -> dict[int, np.ndarray]:
    """By class, the bits of its items' pairs, first words and pieces: 2^table_bits * 3 / 8 bytes each."""

    def united(slots: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(3 << settings.table_bits, dtype=bool)
        bits[slots.slot.to_numpy()] = True
        packed = np.packbits(bits, bitorder="little").tobytes()
        return pd.DataFrame({"class_no": [int(slots.class_no.iloc[0])], "bits": [packed]})

    slots = items.select("class_no", F.explode("slots").alias("slot")).distinct()
    rows = slots.groupBy("class_no").applyInPandas(united, "class_no int, bits binary").collect()
    return {r["class_no"]: np.frombuffer(r["bits"], dtype=np.uint8) for r in rows}


def _has(table: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (table[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1


#: Windows whose words a task remembers as sent; beyond that it starts anew.
REMEMBERED = 50_000

WINDOWS = "doc_id string, start int, content bigint, words binary, walks array<bigint>, pieces array<bigint>"


def _window_rows(settings: Settings, tables: dict[int, np.ndarray], walks: dict[int, int]):
    """Windows of every text. The words and keys of equal windows are sent once by a task."""

    def starts_of(words, owner, last, slots, number: int) -> np.ndarray:
        short, long = settings.shortest(number), settings.longest(number)
        k, table = settings.allowed(long), tables[number]
        known = _has(table, slots)
        known[owner[1:] != owner[:-1]] = 0
        before = np.concatenate(([0], np.cumsum(known, dtype=np.int64)))
        at = np.arange(len(owner))
        ahead = before[np.minimum(at + short - 1 + k, last)] - before[at]
        found = np.flatnonzero(ahead >= max(min(1, short - 1), short - 1 - 2 * k))
        heads = _slots(words.hash[found], settings) + (1 << settings.table_bits)
        return found[_has(table, heads).astype(bool)]

    def of_class(words, owner, starts, number: int, seen: set[int]) -> Iterator[tuple]:
        """(text, start, content, words, walks, pieces) of the windows of one class in a block of texts."""
        long = settings.longest(number)
        size = long + settings.allowed(long)
        ends = words.first[owner[starts] + 1]
        stops = np.minimum(starts + size, ends)
        grams = []  # of every length of pieces: (length, hashes, places of those that a block may have)
        for length in settings.pieces(number):
            hashes = _grams(words.hash, length, number)
            hit = _has(tables[number], _slots(hashes, settings) + (2 << settings.table_bits))
            places = np.flatnonzero(hit)
            low, high = np.searchsorted(places, starts), np.searchsorted(places, stops - length, "right")
            grams.append((hashes.view(np.int64), places, low, np.maximum(low, high)))
        some = np.flatnonzero(np.any([high > low for _, _, low, high in grams], axis=0))  # the others hold no whole piece
        for a in range(0, len(some), 4_000):
            part = some[a : a + 4_000]
            contents = [words.hash[starts[i] : stops[i]].tobytes() for i in part.tolist()]
            names = [xxhash.xxh64_intdigest(c, number & 0xFF) - (1 << 63) for c in contents]
            fresh = [n for n, name in enumerate(names) if name not in seen and not seen.add(name)]
            own = part[fresh]
            keys = dict(zip(fresh, _walks(words.hash, starts[own], stops[own], number, walks[number], settings).view(np.int64)))
            for n, i in enumerate(part.tolist()):
                at = int(starts[i]) - int(words.first[owner[starts[i]]])
                if n in keys:
                    pieces = np.unique(np.concatenate([h[p[low[i] : high[i]]] for h, p, low, high in grams]))
                    yield int(owner[starts[i]]), at, names[n], contents[n], np.unique(keys[n]).tolist(), pieces.tolist()
                else:
                    yield int(owner[starts[i]]), at, names[n], None, None, None
            if len(seen) > REMEMBERED:
                seen.clear()

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns, seen = [c.split()[0] for c in WINDOWS.split(", ")], set()
        for batch in batches:
            texts, ids, out = batch.text.tolist(), batch.doc_id.tolist(), []
            for a, b in in_blocks(texts):
                words = hashed_words(texts[a:b], fold=True)
                if not len(words):
                    continue
                owner = np.repeat(np.arange(b - a), np.diff(words.first))
                last = words.first[owner + 1] - 1
                slots = _slots(_pairs(words.hash), settings)
                for number in sorted(tables):
                    starts = starts_of(words, owner, last, slots, number)
                    for text, *row in of_class(words, owner, starts, number, seen):
                        out.append((ids[a + text], *row))
                        if len(out) == 2000:
                            yield pd.DataFrame(out, columns=columns)
                            out = []
            if out:
                yield pd.DataFrame(out, columns=columns)

    return rows


# ------------------------------------------------------------------------------------------- pairs


def _rare_words(blocks: DataFrame, settings: Settings) -> DataFrame:
    """(block, word) of each block's words that are in the fewest blocks, one more than edits are allowed in it."""

    def distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [np.unique(np.frombuffer(w, dtype=np.int64)) for w in batch.words]
            sizes = [len(f) for f in found]
            yield pd.DataFrame(
                {
                    "block": np.repeat(batch.block.to_numpy(), sizes),
                    "asked": np.repeat([settings.allowed(n) + 1 for n in batch.n], sizes).astype(np.int32),
                    "word": np.concatenate(found) if found else np.zeros(0, np.int64),
                }
            )

    words = blocks.select("block", "n", "words").mapInPandas(distinct, "block bigint, asked int, word bigint")
    counted = words.join(words.groupBy("word").agg(F.count("*").alias("spread")), "word")
    ranked = counted.groupBy("block", "asked").agg(F.sort_array(F.collect_list(F.struct("spread", "word"))).alias("words"))
    return ranked.select("block", F.explode(F.slice("words", F.lit(1), F.col("asked"))).alias("one")).select("block", "one.word")


def _window_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The distinct words of windows, for each key."""
    for batch in batches:
        found = [np.unique(np.frombuffer(w, dtype=np.int64)) for w in batch.words]
        sizes = [len(f) for f in found]
        yield pd.DataFrame(
            {
                "content": np.repeat(batch.content.to_numpy(), sizes),
                "key": np.repeat(batch.key.to_numpy(), sizes),
                "word": np.concatenate(found) if found else np.zeros(0, np.int64),
            }
        )


def pairs_of(kinds: DataFrame, blocks: DataFrame, rare: DataFrame, keys: str, settings: Settings) -> DataFrame:
    """Distinct (content, block) that have one of their ``keys`` in common, and for a key of more than ``bucket``
    blocks one of the block's rare words too."""
    of_blocks = blocks.select("block", F.explode(keys).alias("key"))
    sizes = of_blocks.groupBy("key").agg(F.count("*").alias("n"))
    sized = stored(of_blocks.join(sizes, "key"), "block-keys")
    of_windows = kinds.select("content", "words", F.explode(keys).alias("key"))
    few = sized.filter(F.col("n") <= settings.bucket).select("key", "block")
    hot = sized.filter(F.col("n") > settings.bucket).select("key", "block")
    plain = of_windows.select("content", "key").join(few, "key").select("content", "block")
    crowded = of_windows.join(stored(hot.select("key").distinct(), "hot-keys"), "key", "left_semi")
    worded = crowded.select("content", "key", "words").mapInPandas(_window_words, "content bigint, key bigint, word bigint")
    both = stored(hot.join(rare, "block"), "hot-blocks")
    return plain.unionByName(worded.join(both, ["key", "word"]).select("content", "block")).distinct()


def _verify(settings: Settings):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for block, own, window, content in zip(batch.block, batch.own, batch.words, batch.content):
                own = np.frombuffer(own, dtype=np.uint64)
                most = settings.allowed(len(own))
                found = edit_distance(own, np.frombuffer(window, dtype=np.uint64), most)
                if found <= most:
                    out.append((content, block, found))
            yield pd.DataFrame(out, columns=["content", "block", "distance"])

    return rows


def _verified(pairs: DataFrame, kinds: DataFrame, blocks: DataFrame, settings: Settings) -> DataFrame:
    """(content, block, distance) of the pairs in which the window begins with the block."""
    rows = pairs.join(kinds.select("content", "words"), "content").join(blocks.select("block", F.col("words").alias("own")), "block")
    return rows.select("content", "block", "own", "words").mapInPandas(
        _verify(settings), "content bigint, block bigint, distance int"
    )


# ------------------------------------------------------------------------------------- whole items


def _region_rows(settings: Settings):
    """Words of the wanted regions of every text."""
    columns = ["doc_id", "item_id", "place", "region"]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, out = batch.text.tolist(), []
            for a, b in in_blocks(texts):
                words = hashed_words(texts[a:b], fold=True)
                for i in range(a, b):
                    own = words.hash[words.first[i - a] : words.first[i - a + 1]]
                    for want in batch.wanted.iloc[i]:
                        first = max(0, int(want["place"]))
                        out.append((batch.doc_id.iloc[i], want["item_id"], first, own[first : int(want["stop"])].tobytes()))
                        if len(out) == 2000:
                            yield pd.DataFrame(out, columns=columns)
                            out = []
            yield pd.DataFrame(out, columns=columns)

    return rows


def _whole_rows(settings: Settings):
    """The least distance of each item in its region and the first place with it."""
    columns = ["doc_id", "item_id", "distance", "start", "item_words"]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, item_id, place, region, item in zip(batch.doc_id, batch.item_id, batch.place, batch.region, batch.item):
                own, region = np.frombuffer(item, dtype=np.uint64), np.frombuffer(region, dtype=np.uint64)
                most = settings.allowed(len(own))
                heads = np.isin(region, own[: most + 1])
                best = (most + 1, 0)
                for at in np.flatnonzero(heads[: max(1, len(region) - len(own) + most + 1)]).tolist():
                    best = min(best, (edit_distance(own, region[at:], most), at))
                if best[0] <= most:
                    out.append((doc_id, item_id, best[0], int(place) + best[1], len(own)))
            yield pd.DataFrame(out, columns=columns)

    return rows


FOUND = "doc_id string, item_id string, distance int, start int, item_words int"


def _whole_items(docs: DataFrame, hits: DataFrame, items: DataFrame, settings: Settings) -> DataFrame:
    """Whole items around the places where a block of theirs was found.

    ``hits`` are (doc_id, item_id, place) with the place where the item would begin without edits. Texts of documents
    without a hit stay where they are, but for those whose hashed id is in a slot of one with a hit.
    """
    named = lambda c: F.coalesce(F.col(c), F.lit("")).alias("name")  # noqa: E731  no id is the empty text
    edits = F.floor(F.col("item_words") * settings.edits + 1e-9).cast("int")
    regions = hits.distinct().select(
        named("doc_id"),
        F.struct(
            "item_id", (F.col("place") - edits).alias("place"), (F.col("place") + F.col("item_words") + 2 * edits).alias("stop")
        ).alias("want"),
    )
    wanted = stored(regions.groupBy("name").agg(F.collect_set("want").alias("wanted")), "wanted-regions")
    slot = F.pmod(F.xxhash64("name"), F.lit(settings.slots)).cast("int")
    slots = F.broadcast(wanted.select(slot.alias("slot")).distinct())
    texts = docs.select("doc_id", "text", named("doc_id"))
    near = texts.join(slots, slot == F.col("slot"), "left_semi").hint("merge").join(wanted, "name")
    parts = near.select("doc_id", "text", "wanted").mapInPandas(
        _region_rows(settings), "doc_id string, item_id string, place int, region binary"
    )
    same = F.col("item_id").eqNullSafe(F.col("of"))
    joined = parts.join(items.select(F.col("item_id").alias("of"), "item"), same)
    return joined.select("doc_id", "item_id", "place", "region", "item").mapInPandas(_whole_rows(settings), FOUND)


def contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, the least ``distance`` in
    words, the first ``start`` (word) with it, and ``item_words``.

    Words are runs of non-white-space, A-Z lower-cased. NULL and empty texts match nothing; items
    shorter than ``min_words`` words match where all their words are; items with equal texts are found alike; rows that share an id
    give one row per item. A NULL doc_id is a document of its own kind, all such rows together. Whole
    texts are searched. Equal windows, as of a passage that many documents share, are compared and
    verified once. Of the benchmark only bit tables of fixed size travel to every task.
    """
    small_batches(docs.sparkSession)
    # Ids travel as text: Pandas would turn whole numbers next to NULL into floating-point ones.
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    numbers = range(settings.class_of(1), settings.class_of(max(settings.block, settings.min_words)) + 1)
    walks = {n: repetitions(n, settings) for n in numbers}
    blocks = benchmark.select(F.col("item_id").cast("string"), "text").mapInPandas(_block_rows(settings, walks), BLOCKS)
    # Blocks of equal words are one; their items are joined back in the end.
    block = F.xxhash64("words", "n").alias("block")
    places = stored(blocks.select(block, "item_id", "item_words", "place", "class_no", "n", "words", "walks", "pieces", "slots"), "benchmark-blocks")
    first = F.min(F.struct("class_no", "n", "words", "walks", "pieces", "slots")).alias("b")
    kept = stored(places.groupBy("block").agg(first).select("block", "b.*"), "blocks")
    tables = _bit_tables(kept, settings)
    windows = stored(texts.mapInPandas(_window_rows(settings, tables, walks), WINDOWS), "windows")
    kinds = windows.filter("words is not null").groupBy("content").agg(F.min(F.struct("words", "walks", "pieces")).alias("w"))
    kinds = stored(kinds.select("content", "w.*"), "window-kinds")
    rare = stored(_rare_words(kept, settings), "rare-words")
    walked = stored(_verified(pairs_of(kinds, kept, rare, "walks", settings), kinds, kept, settings), "walked")
    left = kinds.join(walked.select("content").distinct(), "content", "left_anti")
    pieced = _verified(pairs_of(left, kept, rare, "pieces", settings), kinds, kept, settings)
    verified = stored(walked.unionByName(pieced), "verified-windows")
    met = (
        windows.select("content", "doc_id", "start")
        .join(verified, "content")
        .join(places.select("block", "item_id", "item_words", "place", "n"), "block")
    )
    met = stored(met.select("doc_id", "item_id", "item_words", "distance", "start", "place", "n"), "found-blocks")
    single = met.filter("n = item_words").select("doc_id", "item_id", "distance", "start", "item_words")
    hits = met.filter("n < item_words").select("doc_id", "item_id", "item_words", (F.col("start") - F.col("place")).alias("place"))
    items = stored(_items(benchmark), "benchmark-items")
    found = single.unionByName(_whole_items(texts, hits, items, settings))
    best = F.min(F.struct("distance", "start", "item_words")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("item_id").cast("bigint").alias("item_id"),
        "best.distance",
        "best.start",
        "best.item_words",
    )


def _items(benchmark: DataFrame) -> DataFrame:
    """(item_id, item): the word hashes of every item with words."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = hashed_words(batch.text.tolist(), fold=True)
            own = [words.hash[words.first[i] : words.first[i + 1]].tobytes() for i in range(len(batch))]
            yield pd.DataFrame({"item_id": batch.item_id, "item": own})

    named = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return named.mapInPandas(rows, "item_id string, item binary").filter(F.octet_length("item") > 0)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` in whose text no benchmark item was found, all columns kept."""
    found = contaminated(docs, benchmark, settings).select(F.col("doc_id").alias("_found")).distinct()
    return docs.join(stored(found, "contaminated"), F.col("doc_id").eqNullSafe(F.col("_found")), "left_anti")
