"""Token counts with the whole-token shortcut.

Before the job it is proved, string by string, which entries of the vocabulary the merges turn into
just that one token. A pre-token in this set counts 1 without any merging; only the rest is merged by
the tokenizer library. As no pre-token of this kind of tokenizer spans ASCII white space, a text is
counted word by word, and the count of a word is remembered.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scoutline.llm.words import small_batches

#: Words whose counts a worker remembers; beyond that it starts anew, but keeps those it had.
REMEMBERED = 200_000
#: Bytes of the longest word that is remembered, and words that are split in one call.
LONGEST = 64
TOGETHER = 2_000
#: White space that a normalizer or pre-tokenizer may see in a word: any but the ASCII kinds between words.
OWN_SPACE = re.compile(r"[\s\u180e\u200b\ufeff]")


@dataclass(frozen=True)
class Proven:
    """A tokenizer file, the pre-tokens proved to be one token, and its special strings."""

    definition: str
    whole: frozenset[str]
    special: tuple[str, ...]


def prove(path: str) -> Proven:
    """Read a ``tokenizers`` file of BPE with a regular pre-tokenizer and prove its whole tokens.

    The proof encodes every vocabulary string by the model itself: the string without its word-end
    mark must come back as exactly that entry. Files that can't be counted word by word are refused.
    """
    with open(path, encoding="utf-8") as file:
        definition = file.read()
    parsed = json.loads(definition)
    _refuse_others(definition, parsed)
    suffix = parsed["model"].get("end_of_word_suffix") or ""
    model = Tokenizer.from_str(definition).model
    whole = set()
    for entry in parsed["model"]["vocab"]:
        if not entry.endswith(suffix) or entry == suffix:
            continue
        text = entry[: len(entry) - len(suffix)]
        pieces = model.tokenize(text)
        if len(pieces) == 1 and pieces[0].value == entry:
            whole.add(text)
    special = tuple(t["content"] for t in parsed["added_tokens"] if t["special"])
    return Proven(definition, frozenset(whole), special)


#: Words of all kinds that a pre-tokenizer may tell apart, and the white space between words.
_KINDS_OF_WORDS = ("a", "Z", "1", ".", "'s", "é", "日", "_", "-a", "a'", "\u0301")
_BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r", "  ", " \n")


def _refuse_others(definition: str, parsed: dict) -> None:
    """Raise ValueError for a file under which the tokens of a text are not those of its words.

    Tried on pairs of words of every kind with every kind of white space between them: the pre-tokens of the pair must be
    those of the one and of the other.
    """
    if parsed["model"].get("type") != "BPE":
        raise ValueError("not a BPE model")
    if any(not t["special"] for t in parsed["added_tokens"]):
        raise ValueError("added tokens that are not special are matched inside words")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in parsed["added_tokens"]):
        raise ValueError("special tokens that look at what stands around them")
    tokenizer = Tokenizer.from_str(definition)
    if tokenizer.pre_tokenizer is None:
        raise ValueError("no pre-tokenizer: tokens may go over white space")

    def pieces(text: str) -> list[str]:
        normal = tokenizer.normalizer.normalize_str(text) if tokenizer.normalizer else text
        return [p for p, _ in tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    for left in _KINDS_OF_WORDS:
        for right in _KINDS_OF_WORDS:
            if any(pieces(left + blank + right) != pieces(left) + pieces(right) for blank in _BLANKS):
                raise ValueError("pre-tokens that hold white space, or depend on the word before")


class Counter:
    """Counts tokens of texts as the library gives them, without begin and end tokens."""

    def __init__(self, proven: Proven):
        self.tokenizer = Tokenizer.from_str(proven.definition)
        self.whole = proven.whole
        longest = sorted(proven.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.known: dict[bytes, int] = {}
        self.before: dict[bytes, int] = {}

    def of_piece(self, text: str) -> int:
        """Tokens of text without special strings."""
        normalizer, split, model = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer, self.tokenizer.model
        normal = normalizer.normalize_str(text) if normalizer else text
        pieces = split.pre_tokenize_str(normal)
        return sum(1 if p in self.whole else len(model.tokenize(p)) for p, _ in pieces)

    def of_word(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return self.of_piece(text)
        # Every second part is a special string, which is one token wherever it stands.
        parts = self.special.split(text)
        return len(parts) // 2 + sum(self.of_piece(p) for p in parts[0::2] if p)

    def of_words(self, texts: list[str]) -> list[int]:
        """Counts of words, split together in one call; those that hold white space of their own, which may
        vanish or split them, one by one, and all if a word holds a special string."""
        odd = {i for i, t in enumerate(texts) if OWN_SPACE.search(t)}
        if odd:
            plain = iter(self.of_words([t for i, t in enumerate(texts) if i not in odd]) if len(odd) < len(texts) else ())
            return [self.of_word(t) if i in odd else next(plain) for i, t in enumerate(texts)]
        joined = " ".join(texts)
        normalizer = self.tokenizer.normalizer
        normal = normalizer.normalize_str(joined) if normalizer else joined
        parts = normal.split(" ")
        if len(parts) != len(texts) or self.special is not None and self.special.search(joined):
            return [self.of_word(t) for t in texts]
        counts, at, end = [0] * len(parts), 0, len(parts[0])
        whole, model = self.whole, self.tokenizer.model
        for piece, (start, _) in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal):
            while start > end:
                at += 1
                end += 1 + len(parts[at])
            counts[at] += 1 if piece in whole else len(model.tokenize(piece))
        return counts

    def of_text(self, text: str | None) -> int:
        if not text:
            return 0
        known, total, unseen = self.known, 0, []
        for word in text.encode("utf-8").split():
            n = known.get(word)
            if n is None:
                unseen.append(word)
            else:
                total += n
        for begin in range(0, len(unseen), TOGETHER):
            total += self.of_unseen(unseen[begin : begin + TOGETHER])
        return total

    def of_unseen(self, words: list[bytes]) -> int:
        """Count words that were not met lately, and remember them. What was remembered before the last
        new start is looked up first."""
        counts = {w: self.before[w] for w in words if w in self.before}
        fresh = [w for w in dict.fromkeys(words) if w not in counts]
        if fresh:
            counts.update(zip(fresh, self.of_words([w.decode("utf-8") for w in fresh])))
        if len(self.known) >= REMEMBERED:
            self.before, self.known = self.known, {}
        self.known.update((w, n) for w, n in counts.items() if len(w) <= LONGEST)
        return sum(counts[w] for w in words)


def token_counter(spark: SparkSession, path: str):
    """A column function text -> number of tokens. The file is read on the driver and broadcast
    (a few MB), so executors need no copy of it."""
    proven = prove(path)
    shared = spark.sparkContext.broadcast((proven.definition, proven.whole, proven.special))

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(Proven(*shared.value))
        for texts in batches:
            yield pd.Series([counter.of_text(t) for t in texts.tolist()], dtype="int64")

    return count


def count_tokens(docs: DataFrame, path: str, *, text: Column | str = "text", limit: int = 2048) -> DataFrame:
    """Add n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit); columns of these names are
    replaced. NULL counts as empty. Rows are counted where they lie."""
    small_batches(docs.sparkSession)
    column = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    count = token_counter(docs.sparkSession, path)
    rows = docs.withColumns({"n_bytes": F.octet_length(column).cast("bigint"), "n_tokens": count(column)})
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
