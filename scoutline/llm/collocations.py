"""Phrase collocation mining by stripes.

A stripe belongs to a word and counts the runs of words that follow it. Tasks combine the stripes
of a block of text before anything is shuffled; equal stripes are merged elementwise, and counters below
the least count are dropped. One such table per length gives everything: its counters are the phrases, those of
the shorter ones (and the vocabulary) the parts at every cut, its greatest counters what subsumes them.

Words are 64-bit keys (of language and word) while they are counted. The vocabulary is checked for two
words with one key, and the job starts anew with another seed if it has any, so counts are exact.
A phrase can be frequent only if the phrases in it are: bit tables of bounded size hold the frequent
words and runs, and whatever else follows is left out where it is met. A full table lets more
through and loses nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scoutline.llm.words import mixed, small_batches
from scoutline.session import stored

#: Words that a task combines before it sends their stripes, and bytes that are hashed at once.
TOGETHER = 2_000_000
BLOCK = 1 << 20
#: The key that no word has.
REST = 0

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
# What a byte is: 0 part of a word, 1 between words, 2 between pieces.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2


@dataclass(frozen=True)
class Settings:
    """``table_bits`` sizes the bit tables (2^25 bits are 4 MB, read by the driver as at most 2^19 rows).
    A word with more than one in ``hot`` of all words has its stripe split by the following run into
    ``parts``; there are at most ``hot`` of them."""

    shortest: int = 2
    longest: int = 3
    least: int = 10
    subsumed: int = 50
    table_bits: int = 25
    hot: int = 2048
    parts: int = 64


def _hashes(raw: np.ndarray, start: np.ndarray, stop: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hash of each word of ``raw``; the words lie in order and do not overlap."""
    base = mixed(np.array([seed + 1], dtype=np.uint64))[0] | np.uint64(1)
    out, at = np.empty(len(start), dtype=np.uint64), 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(stop, start[at] + BLOCK, side="right")))
        length = stop[at:to] - start[at:to]
        begin = np.concatenate(([0], np.cumsum(length)[:-1]))
        inside = np.arange(int(length.sum())) - np.repeat(begin, length)
        values = raw[np.repeat(start[at:to], length) + inside].astype(np.uint64) + np.uint64(1)
        powers = np.cumprod(np.full(int(length.max()), base, dtype=np.uint64))
        out[at:to] = np.add.reduceat(values * powers[inside], begin)
        at = to
    return mixed(out)


@dataclass
class _Words:
    """Words of a batch: key, piece number, language number and place in ``data``."""

    key: np.ndarray
    piece: np.ndarray
    lang: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    data: np.ndarray
    langs: list[str]


def _read(batch: pa.RecordBatch, seed: int, key_bits: int) -> _Words:
    """The words of a batch of (lang, text), neither of them NULL."""
    texts = batch.column("text").cast(pa.binary()).cast(pa.large_binary())
    if not len(texts):
        none = np.zeros(0, dtype=np.int64)
        return _Words(none.view(np.uint64), none, none, none, none, np.zeros(0, np.uint8), [])
    at = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8)[at[0] : at[-1]] if held and at[-1] > at[0] else np.zeros(0, np.uint8)
    at = at - at[0]
    raw = _FOLD[data]
    kind = _KIND[raw]
    word = np.concatenate(([False], kind == 0, [False]))
    # A text's first byte starts a word of its own and a piece of its own.
    first = np.zeros(len(raw) + 1, dtype=bool)
    first[at] = True
    start = np.flatnonzero(word[1:-1] & (~word[:-2] | first[:-1]))
    stop = np.flatnonzero(word[1:-1] & (~word[2:] | first[1:])) + 1
    pieces = np.cumsum((kind == 2) + first[:-1].astype(np.int64))
    owner = np.searchsorted(at, start, side="right") - 1
    encoded = batch.column("lang").dictionary_encode()
    langs = encoded.dictionary.to_pylist()
    number = encoded.indices.to_numpy(zero_copy_only=False)
    salts = np.array(
        [int.from_bytes(hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for x in langs],
        dtype=np.uint64,
    )
    lang = number[owner] if len(start) else np.zeros(0, dtype=np.int64)
    key = mixed(_hashes(raw, start, stop, seed) + (salts[lang] if len(start) else np.zeros(0, np.uint64)))
    if key_bits < 64:
        key &= np.uint64((1 << key_bits) - 1)
    key[key == REST] = 1
    return _Words(key, pieces[start], lang, start, stop, raw, langs)


def _vocabulary_rows(seed: int, key_bits: int):
    schema = pa.schema([("key", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, list] = {}
        for batch in batches:
            words = _read(batch, seed, key_bits)
            if not len(words.key):
                continue
            unique, where, inverse, counts = np.unique(words.key, return_index=True, return_inverse=True, return_counts=True)
            if _all_equal(words, where[inverse]):
                at = where
            else:  # two words share a key: list every occurrence
                unique, at, counts = words.key, np.arange(len(words.key)), np.ones(len(words.key), dtype=np.int64)
            data = words.data.tobytes()
            langs = [words.langs[i] for i in words.lang[at]]
            texts = [data[a:b] for a, b in zip(words.start[at].tolist(), words.stop[at].tolist())]
            for key, lang, text, n in zip(unique.view(np.int64).tolist(), langs, texts, counts.tolist()):
                known[key, lang, text] = known.get((key, lang, text), 0) + n
            if len(known) > TOGETHER // 4:
                yield _packed(known, schema)
                known = {}
        if known:
            yield _packed(known, schema)

    return rows


def _all_equal(words: _Words, other: np.ndarray) -> bool:
    """Whether every word is, byte by byte, the word of its language at the index in ``other``."""
    length = words.stop - words.start
    if (words.lang != words.lang[other]).any() or (length != length[other]).any():
        return False
    at = 0
    while at < len(length):
        to = max(at + 1, int(np.searchsorted(words.stop, words.start[at] + BLOCK, side="right")))
        size = length[at:to]
        inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        own, others = (words.data[np.repeat(words.start[i], size) + inside] for i in (slice(at, to), other[at:to]))
        if (own != others).any():
            return False
        at = to
    return True


def _packed(known: dict[tuple, int], schema: pa.Schema) -> pa.RecordBatch:
    keys, langs, texts = zip(*known)
    columns = [pa.array(keys, pa.int64()), pa.array(langs, pa.string()), pa.array(texts, pa.binary()).cast(pa.string())]
    return pa.RecordBatch.from_arrays([*columns, pa.array(list(known.values()), pa.int64())], schema=schema)


def _has(table: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    slots = (keys >> np.uint64(64 - bits)).astype(np.int64)
    return ((table[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1).astype(bool)


def joined_key(parts: list[np.ndarray]) -> np.ndarray:
    """One number for a run of word keys, for bit tables and splits only: equal runs have equal numbers."""
    return reduce(lambda a, b: mixed(a * np.uint64(0x9E3779B97F4A7C15) + b), parts)


def _ranked(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Dense numbers of equal rows, and one row of each number."""
    number = np.zeros(len(columns[0]), dtype=np.int64)
    for column in columns:
        unique, dense = np.unique(column, return_inverse=True)
        _, number = np.unique(number * len(unique) + dense, return_inverse=True)
    first = np.empty(int(number.max()) + 1, dtype=np.int64)
    first[number[::-1]] = np.arange(len(number) - 1, -1, -1)
    return number, first


def _stripes(runs: list[np.ndarray], hot: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    """The stripes of a block: per first word (and part, where it is hot) the runs that follow it with their counts."""
    if not len(runs[0]):
        return
    number, first = _ranked(runs)
    counts = np.bincount(number, minlength=len(first))
    word, *after = (r[first] for r in runs)
    part = np.where(np.isin(word, hot), 1 + mixed(joined_key(after)) % np.uint64(parts), 0).astype(np.int64)
    stripe, own = _ranked([word, part])
    order = np.argsort(stripe, kind="stable")
    at = np.searchsorted(stripe[order], np.arange(len(own) + 1))
    names = [*_names(len(runs) - 1)[1:], "after"]
    for a in range(0, len(own), 5_000):
        to = min(a + 5_000, len(own))
        held, offsets = order[at[a] : at[to]], pa.array((at[a : to + 1] - at[a]).astype(np.int32))
        lists = [*(c[held].view(np.int64) for c in after), counts[held].astype(np.int64)]
        columns = [pa.array(word[own[a:to]].view(np.int64)), pa.array(part[own[a:to]].astype(np.int32))]
        columns += [pa.ListArray.from_arrays(offsets, pa.array(c)) for c in lists]
        yield pa.RecordBatch.from_arrays(columns, names=["w0", "part", *names, "counts"])


def _names(size: int) -> list[str]:
    return [f"w{i}" for i in range(size)]


def _stripe_rows(size: int, tables: list[np.ndarray], hot: np.ndarray, seed: int, key_bits: int, settings: Settings):
    """Stripes of runs of ``size`` words and the one after them; ``tables`` are those of frequent words and frequent runs."""
    bits = settings.table_bits

    def block(read: list[_Words]) -> Iterator[pa.RecordBatch]:
        key = np.concatenate([w.key for w in read])
        shift = np.cumsum([0, *(int(w.piece[-1]) + 1 if len(w.piece) else 0 for w in read)])
        piece = np.concatenate([w.piece + s for w, s in zip(read, shift)])
        n = len(key) - size + 1
        if n < 1:
            return
        runs = [key[i : i + n] for i in range(size)]
        whole = piece[:n] == piece[size - 1 : size - 1 + n]
        known = whole & _has(tables[size - 1], joined_key(runs), bits)
        # A longer run can be frequent if the two runs in it are.
        at = np.flatnonzero(known[:-1] & known[1:] & (piece[: n - 1] == piece[1:n]))
        yield from _stripes([*(r[at] for r in runs), key[at + size]], hot, settings.parts)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words = [], 0
        for batch in batches:
            read = _read(batch, seed, key_bits)
            held.append(_Words(read.key, read.piece, read.lang, read.start[:0], read.stop[:0], read.data[:0], []))
            words += len(read.key)
            if words > TOGETHER:
                yield from block(held)
                held, words = [], 0
        if words:
            yield from block(held)

    return rows


def _bit_table(keys: DataFrame, number: Column, bits: int) -> np.ndarray:
    """A table of 2^bits bits with the leading bits of every number; at most 2^(bits - 6) rows reach the driver."""
    slot = F.shiftrightunsigned(number, 64 - bits)
    rows = (
        keys.select(F.shiftright(slot, 6).alias("at"), F.expr("1L").alias("one"), slot.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
        .groupBy("at")
        .agg(F.bit_or(F.call_function("shiftleft", F.col("one"), F.col("bit"))).alias("bits"))
        .toArrow()
    )
    table = np.zeros(1 << (bits - 6), dtype=np.int64)
    table[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return table.view(np.uint8)


def _joined(keys: DataFrame, names: list[str]) -> DataFrame:
    """Add ``run``, the number of joined_key, to the word keys of a run."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [batch.column(n).to_numpy(zero_copy_only=False).view(np.uint64) for n in names]
            yield pa.RecordBatch.from_arrays([pa.array(joined_key(parts).view(np.int64)), batch.column("n")], names=["run", "n"])

    return keys.select(*names, "n").mapInArrow(runs, "run bigint, n bigint")


def vocabulary(texts: DataFrame, settings: Settings = Settings(), key_bits: int = 64) -> tuple[DataFrame, int]:
    """(key, lang, word, n) of every word, as a written table, and the seed under which no two share a key."""
    for seed in range(64):
        counted = texts.mapInArrow(_vocabulary_rows(seed, key_bits), "key bigint, lang string, word string, n bigint")
        words = stored(counted.groupBy("key", "lang", "word").agg(F.sum("n").alias("n")), "vocabulary")
        if words.groupBy("key").count().where("count > 1").isEmpty():
            return words, seed
    raise RuntimeError("no seed tells all words apart")


def stripes(texts: DataFrame, settings: Settings = Settings(), key_bits: int = 64) -> tuple[DataFrame, dict[int, DataFrame]]:
    """The vocabulary, and per size the merged stripes as (w0, ..., after, n), written tables: the runs of ``size`` + 1
    words that occur at least ``least`` times.
    """
    bits = settings.table_bits
    words, seed = vocabulary(texts, settings, key_bits)
    total = words.agg(F.sum("n")).first()[0] or 0
    found: dict[int, DataFrame] = {}
    tables, frequent = [], words.where(F.col("n") >= settings.least).select(F.col("key").alias("w0"), "n")
    # At most ``hot`` words have more than one in ``hot`` of all.
    hot = frequent.where(F.col("n") * settings.hot > total).select("w0").toArrow().column("w0").to_numpy().view(np.uint64)
    for size in range(1, settings.longest):
        names = _names(size)
        tables.append(_bit_table(_joined(frequent, names), F.col("run"), bits))
        lists = [*names[1:], "after", "counts"]
        schema = "w0 bigint, part int, " + ", ".join(f"{n} array<bigint>" for n in lists)
        sent = texts.mapInArrow(_stripe_rows(size, tables, hot, seed, key_bits, settings), schema)
        # Merged where the stripes lie after one shuffle: the sums keep to its partitions.
        merged = (
            sent.repartition("w0", "part")
            .select("w0", "part", F.explode(F.arrays_zip(*lists)).alias("one"))
            .groupBy("w0", "part", *[F.col(f"one.{n}").alias(n) for n in lists[:-1]])
            .agg(F.sum("one.counts").alias("n"))
            .where(F.col("n") >= settings.least)
        )
        found[size] = stored(merged.select(*names, "after", "n"), f"stripes-{size}")
        frequent = found[size].withColumnRenamed("after", f"w{size}")
    return words, found


def _least_score(phrases: DataFrame, size: int, totals: dict[int, DataFrame]) -> DataFrame:
    """Add l, r and score of the lowest-scoring cut, the first of equal ones."""
    names, rows, cuts = _names(size), phrases, []
    for k in range(1, size):
        left = totals[k].select(*_names(k), F.col("n").alias("l"))
        right = totals[size - k].select(*[F.col(f"w{i}").alias(f"w{i + k}") for i in range(size - k)], F.col("n").alias("r"))
        rows = rows.join(left, _names(k)).join(right, names[k:])
        cuts.append(f"c{k}")
        rows = rows.withColumn(
            f"c{k}",
            F.expr(
                f"struct((cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0)))"
                f" div (cast(l as decimal(15,0)) * cast(r as decimal(15,0))) as score, {k} as k, l, r)"
            ),
        ).drop("l", "r")
    best = F.least(*cuts) if len(cuts) > 1 else F.col(cuts[0])
    return rows.select(*names, "a", best.alias("best")).select(*names, "a", "best.l", "best.r", "best.score")


def phrases(
    docs: DataFrame,
    settings: Settings = Settings(),
    *,
    top: int | None = 2000,
    lang: str = "lang",
    text: str = "text",
    key_bits: int = 64,
) -> DataFrame:
    """The phrases of each language by score, descending, then count, descending, then phrase.

    Returns lang, rank, phrase, a (its count), l and r (counts of the two parts at the lowest-scoring cut),
    n (words of the language) and score = floor(1000000 * a * a / (l * r)); with ``top`` only so many a language.
    A NULL text counts as empty, a NULL language as ``und``. Words are lower-cased in A-Z only. Equal rows
    count as often as they occur; an empty table has no phrases; other columns are not read.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    words, found = stripes(texts, settings, key_bits)
    known = words.where(F.col("n") >= settings.least)
    totals = {1: known.select(F.col("key").alias("w0"), "n")}
    totals |= {k + 1: v.withColumnRenamed("after", f"w{k}") for k, v in found.items()}
    out = []
    for size in range(settings.shortest, settings.longest + 1):
        names = _names(size)
        rows = found[size - 1].select(*_names(size - 1), F.col("after").alias(f"w{size - 1}"), F.col("n").alias("a"))
        if size < settings.longest:
            longer = found[size]
            ahead = longer.groupBy(*names).agg(F.max("n").alias("most"))
            behind = longer.select(*[F.col(f"w{i + 1}").alias(f"w{i}") for i in range(size - 1)], F.col("after").alias(f"w{size - 1}"), "n")
            most = ahead.unionByName(behind.groupBy(*names).agg(F.max("n").alias("most"))).groupBy(*names).agg(F.max("most").alias("most"))
            rows = (
                rows.join(most, names, "left")
                .where(F.col("most").isNull() | (100 * F.col("most") < settings.subsumed * F.col("a")))
                .drop("most")
            )
        rows = _least_score(rows, size, totals)
        for i in range(size):
            spelled = known.select(F.col("key").alias(f"w{i}"), F.col("word").alias(f"t{i}"), *(["lang"] if i == 0 else []))
            rows = rows.join(spelled, f"w{i}")
        out.append(rows.select("lang", F.concat_ws(" ", *[f"t{i}" for i in range(size)]).alias("phrase"), "a", "l", "r", "score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = reduce(DataFrame.unionByName, out).withColumn("rank", F.row_number().over(order).cast("bigint"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    sums = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(sums, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
