"""Words of many texts at once, as NumPy arrays over their UTF-8 bytes.

A word is a run of anything but the six ASCII white-space characters. All functions take plain lists
or Series of texts, in which NULL counts as empty, and work through them in blocks of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import SparkSession

#: Texts are joined up to so many bytes; a longer text is cut at white space.
BLOCK = 1 << 19
#: Rows that one Arrow batch carries to a Python worker: texts may be long.
BATCH_ROWS = 500

_SPACE = re.compile(rb"[ \t-\r]")
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)


def small_batches(spark: SparkSession) -> None:
    """Let no Arrow batch carry more than BATCH_ROWS texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit integers scattered over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """``first[i]`` to ``first[i + 1]`` are the words of text ``i``; ``start`` and ``stop`` are byte
    offsets into ``data``, ``hash`` a 64-bit hash of the word."""

    data: bytes
    first: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    hash: np.ndarray
    kinds: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.start)


def _hash_block(raw: np.ndarray, fold: bool, kinds: np.ndarray | None):
    space = IS_SPACE[raw]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    bounds = np.concatenate(([0] if not space[0] else [], edges, [len(raw)] if not space[-1] else []))
    bounds = bounds.astype(np.int64)
    start, stop = bounds[0::2], bounds[1::2]
    if not len(start):
        none = np.zeros(0, dtype=np.uint64)
        return start, stop, none, none
    length = stop - start
    at = np.flatnonzero(~space)
    begin = np.concatenate(([0], np.cumsum(length)[:-1]))
    inside = at - np.repeat(start, length)
    longest = int(length.max())
    powers = np.cumprod(np.full(longest, _BASE | np.uint64(1), dtype=np.uint64))
    letters = raw[at]
    values = (_FOLD[letters] if fold else letters).astype(np.uint64) + np.uint64(1)
    hashes = mixed(np.add.reduceat(values * powers[inside], begin))
    found = np.bitwise_or.reduceat(kinds[letters], begin) if kinds is not None else hashes[:0]
    return start, stop, hashes, found


def hashed_words(texts: Sequence[str | None], *, fold: bool = False, kinds: np.ndarray | None = None) -> Words:
    """All words of the texts. With ``fold`` A-Z hash like a-z. ``kinds`` maps bytes to bit masks,
    which are united over each word."""
    parts = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]
    data = b"\n".join(parts) + b"\n"
    ends = np.cumsum([len(p) + 1 for p in parts], dtype=np.int64) if parts else np.zeros(0, dtype=np.int64)
    whole = np.frombuffer(data, dtype=np.uint8)
    found, at = [], 0
    while at < len(data):
        cut = min(len(data), at + BLOCK)
        if cut < len(data):
            space = _SPACE.search(data, cut)
            cut = space.end() if space else len(data)
        start, stop, hashes, seen = _hash_block(whole[at:cut], fold, kinds)
        found.append((start + at, stop + at, hashes, seen))
        at = cut
    start, stop, hashes, seen = (np.concatenate(x) for x in zip(*found))
    first = np.concatenate(([0], np.searchsorted(start, ends))).astype(np.int64)
    return Words(data, first, start, stop, hashes, seen if kinds is not None else None)


def in_blocks(texts: Sequence[str | None], most: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` characters together; a longer text is alone."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        n = len(text) if isinstance(text, str) else 0
        if i > begin and size + n > most:
            yield begin, i
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield begin, len(texts)
