"""Language identification of whole and mixed texts.

A word is a run of letters of one script. Its script narrows the languages that it may be of; under each
of these it has a score from its character n-grams. Viterbi over the words of a text, with a penalty for
every change of language, labels spans; the language with most letters in its spans is that of the text.

The model counts hashed n-grams of a bounded sample of labelled rows. Texts are scored where they lie.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoutline.llm.words import in_blocks, mixed, small_batches
from scoutline.session import stored

#: Rows whose checksum has this remainder are held out.
FOLDS, HELD_OUT = 3, 1
UNDETERMINED = "und"
#: Characters of the texts that are worked through side by side; a longer text is alone.
BLOCK = 1 << 21

# Script ranges (first and last code point of Unicode blocks, united by script).
SCRIPTS = (
    ("latin", 0x0041, 0x024F), ("latin", 0x0250, 0x02AF), ("greek", 0x0370, 0x03FF), ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x06FF), ("syriac", 0x0700, 0x074F),
    ("arabic", 0x0750, 0x077F), ("thaana", 0x0780, 0x07BF), ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF),
    ("gurmukhi", 0x0A00, 0x0A7F), ("gujarati", 0x0A80, 0x0AFF), ("oriya", 0x0B00, 0x0B7F), ("tamil", 0x0B80, 0x0BFF),
    ("telugu", 0x0C00, 0x0C7F), ("kannada", 0x0C80, 0x0CFF), ("malayalam", 0x0D00, 0x0D7F), ("sinhala", 0x0D80, 0x0DFF),
    ("thai", 0x0E00, 0x0E7F), ("lao", 0x0E80, 0x0EFF), ("tibetan", 0x0F00, 0x0FFF), ("myanmar", 0x1000, 0x109F),
    ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("ethiopic", 0x1200, 0x137F), ("khmer", 0x1780, 0x17FF),
    ("mongolian", 0x1800, 0x18AF), ("latin", 0x1E00, 0x1EFF), ("greek", 0x1F00, 0x1FFF), ("kana", 0x3040, 0x30FF),
    ("hangul", 0x3130, 0x318F), ("kana", 0x31F0, 0x31FF), ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF), ("han", 0xF900, 0xFAFF), ("arabic", 0xFB50, 0xFDFF), ("arabic", 0xFE70, 0xFEFF),
    ("latin", 0xFF21, 0xFF5A), ("kana", 0xFF66, 0xFF9D), ("han", 0x20000, 0x323AF),
)
#: Number of a script; 0 is no letter, the last one any other script.
SCRIPT_NAMES = tuple(dict.fromkeys(name for name, _, _ in SCRIPTS))
OTHER = len(SCRIPT_NAMES) + 1


@dataclass(frozen=True)
class Settings:
    """At most about ``rows_per_language`` labelled rows of each language are learned from, chosen by a hash of
    the id. The model has ``buckets`` numbers per language, so ``most_languages`` bounds what is broadcast (4 bytes a
    number). ``switch`` is the cost of a change of language, ``widest`` the greatest score difference that one word makes;
    a language is a candidate in a script that holds ``script_share`` of its letters."""

    rows_per_language: int = 3_000
    buckets: int = 1 << 16
    grams: tuple[int, ...] = (1, 2, 3, 4)
    smoothing: float = 0.5
    switch: float = 12.0
    widest: float = 8.0
    script_share: float = 0.01
    most_languages: int = 500


def held_out(doc_id: Column) -> Column:
    """Whether the CRC-32 of the id as text falls into the held-out fold; never for a NULL id."""
    remainder = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))
    return F.coalesce(remainder == HELD_OUT, F.lit(False))


def _kinds(points: np.ndarray) -> np.ndarray:
    """Script numbers of code points; 0 for all but letters and the marks in a script's own range."""
    out = np.zeros(len(points), dtype=np.int16)
    for i, point in enumerate(points.tolist()):
        category = unicodedata.category(chr(point))[0]
        if category not in "LM":
            continue
        for name, first, last in SCRIPTS:
            if first <= point <= last:
                out[i] = SCRIPT_NAMES.index(name) + 1
                break
        else:
            out[i] = OTHER if category == "L" else 0
    return out


class Alphabet:
    """Script and lower-case form of code points, worked out when they are first met."""

    def __init__(self):
        self.script = np.full(0x110000, -1, dtype=np.int16)
        self.lower = np.arange(0x110000, dtype=np.uint32)

    def read(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        scripts = self.script[points]
        if len(scripts) and scripts.min() < 0:
            new = np.unique(points[scripts < 0])
            self.script[new] = _kinds(new)
            for point in new.tolist():
                small = chr(point).lower()
                self.lower[point] = ord(small) if len(small) == 1 else point
            scripts = self.script[points]
        return scripts, self.lower[points]


@dataclass
class Words:
    """Words of a block of texts: ``first[i]`` to ``first[i + 1]`` are those of text ``i``; ``start`` and
    ``stop`` are places in their text; ``unique`` numbers equal words."""

    first: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    script: np.ndarray
    unique: np.ndarray
    points: np.ndarray
    at: np.ndarray

    def letters(self) -> np.ndarray:
        return self.stop - self.start


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def words_of(texts: list[str | None], alphabet: Alphabet) -> Words:
    parts = [_points(t) if isinstance(t, str) else np.zeros(0, np.uint32) for t in texts]
    sizes = np.array([len(p) + 1 for p in parts], dtype=np.int64)
    begins = np.cumsum(sizes) - sizes
    points = np.zeros(int(sizes.sum()) + 1, dtype=np.uint32)
    for begin, part in zip(begins.tolist(), parts):
        points[begin + 1 : begin + 1 + len(part)] = part
    scripts, lower = alphabet.read(points)
    edge = np.flatnonzero(scripts[1:] != scripts[:-1]) + 1
    start = edge[scripts[edge] > 0]
    stop = edge[scripts[edge - 1] > 0]
    first = np.append(np.searchsorted(start, begins), len(start))
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    shift = begins[owner] + 1 if len(start) else start
    length = stop - start
    inside = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    letters = lower[np.repeat(start, length) + inside]
    hashes = _runs(letters, inside, np.cumsum(length) - length)
    return Words(first, start - shift, stop - shift, scripts[start], hashes, letters, np.append(0, np.cumsum(length)))


_BASE = np.uint64(0x9E3779B97F4A7C15)


def _runs(letters: np.ndarray, inside: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word."""
    if not len(begin):
        return np.zeros(0, dtype=np.uint64)
    powers = np.cumprod(np.full(int(inside.max()) + 1, _BASE, dtype=np.uint64))
    return mixed(np.add.reduceat(mixed(letters.astype(np.uint64) + _BASE) * powers[inside], begin))


def n_grams(words: Words, which: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(index into ``which``, bucket) of every character n-gram of the words at ``which``, their edges included.

    The n-grams of each size lie in buckets of their own: of k sizes, size number i has a k-th part of them.
    """
    length = words.letters()[which] + 2
    begin = np.cumsum(length) - length
    owner = np.repeat(np.arange(len(which)), length)
    inside = np.arange(int(length.sum())) - np.repeat(begin, length)
    edge = (inside == 0) | (inside == np.repeat(length, length) - 1)
    letters = np.zeros(len(inside), dtype=np.uint64)
    letters[~edge] = words.points[(np.repeat(words.at[:-1][which], length) + inside - 1)[~edge]]
    letters = mixed(letters + _BASE)
    part = settings.buckets // len(settings.grams)
    owners, buckets = [], []
    for i, size in enumerate(settings.grams):
        n = len(letters) - size + 1
        if n < 1:
            continue
        run = np.zeros(n, dtype=np.uint64)
        for j in range(size):
            run = mixed(run * _BASE + letters[j : j + n])
        fits = owner[:n] == owner[size - 1 : size - 1 + n]
        if size == 1:
            fits &= ~edge[:n]
        owners.append(owner[:n][fits])
        buckets.append((run[fits] % np.uint64(part)).astype(np.int64) + i * part)
    return np.concatenate(owners) if owners else owner[:0], np.concatenate(buckets) if buckets else owner[:0]


@dataclass
class Model:
    """Languages in order; log-probabilities of the buckets (bucket, language); the letters of each language in
    each script (script, language); the rows it was learned from."""

    languages: list[str]
    logs: np.ndarray
    scripts: np.ndarray
    rows: int
    settings: Settings


def train(docs: DataFrame, settings: Settings = Settings(), *, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Model:
    """Count n-grams of labelled rows outside the held-out fold.

    Rows with a NULL id, language or text teach nothing. Every language keeps about ``rows_per_language`` rows, those
    chosen by a hash of id and length, or all if it has no more. Raises ValueError beyond ``most_languages``. Without
    labelled rows the model knows no language.
    """
    small_batches(docs.sparkSession)
    known = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text")).where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    )
    counts = known.groupBy("lang").agg(F.count("*").alias("rows")).orderBy("lang").limit(settings.most_languages + 1).collect()
    if len(counts) > settings.most_languages:
        raise ValueError(f"more than {settings.most_languages} languages")
    languages = [r["lang"] for r in counts]
    if not languages:
        return Model([], np.zeros((settings.buckets, 0), np.float32), np.zeros((OTHER + 1, 0)), 0, settings)
    # The share of each language's rows that is learned from, as a bound on a 32-bit hash.
    bounds = [
        (x, i, min(1 << 32, int((1 << 32) * settings.rows_per_language / r["rows"]))) for i, (x, r) in enumerate(zip(languages, counts))
    ]
    numbers = docs.sparkSession.createDataFrame(bounds, "lang string, number int, bound bigint")
    hashed = F.shiftrightunsigned(F.xxhash64("doc_id", F.length("text")), 32)
    sample = known.join(F.broadcast(numbers), "lang").where(hashed < F.col("bound")).select("number", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        alphabet, sums = Alphabet(), {}
        for batch in batches:
            for number, texts in batch.groupby("number").text:
                own = sums.setdefault(number, [np.zeros(settings.buckets, np.int64), np.zeros(OTHER + 1, np.int64), 0])
                values = texts.tolist()
                own[2] += len(values)
                for a, b in in_blocks(values, BLOCK):
                    words = words_of(values[a:b], alphabet)
                    _, where, times = np.unique(words.unique, return_index=True, return_counts=True)
                    owner, bucket = n_grams(words, where, settings)
                    own[0] += np.bincount(bucket, weights=times[owner], minlength=settings.buckets).astype(np.int64)
                    own[1] += np.bincount(words.script, weights=words.letters(), minlength=OTHER + 1).astype(np.int64)
        for number, (grams, scripts, rows) in sums.items():
            # After the buckets come the scripts, then the number of rows.
            values = np.concatenate((grams, scripts, [rows]))
            at = np.flatnonzero(values)
            yield pd.DataFrame({"number": np.full(len(at), number, np.int32), "place": at, "n": values[at]})

    parts = sample.mapInPandas(count, "number int, place bigint, n bigint").groupBy("number", "place").agg(F.sum("n").alias("n"))
    found = stored(parts, "language-counts").toArrow()  # at most languages * (buckets + scripts + 1) rows
    size = settings.buckets + OTHER + 2
    table = np.zeros((size, len(languages)))
    table[found.column("place").to_numpy(), found.column("number").to_numpy()] = found.column("n").to_numpy()
    grams = table[: settings.buckets].reshape(len(settings.grams), -1, len(languages)) + settings.smoothing
    logs = np.log(grams / grams.sum(axis=1, keepdims=True)).reshape(-1, len(languages))
    return Model(languages, logs.astype(np.float32), table[settings.buckets : -1], int(table[-1].sum()), settings)


def candidates(model: Model) -> np.ndarray:
    """Whether a language is a candidate for words of a script, by (script, language); a script that none of them uses
    rules none out."""
    share = model.scripts / np.maximum(1, model.scripts.sum(axis=0))
    allowed = share >= model.settings.script_share
    allowed[~allowed.any(axis=1)] = True
    return allowed


def word_scores(words: Words, logs: np.ndarray, allowed: np.ndarray, settings: Settings) -> np.ndarray:
    """Scores (word, language), 0 for the best language of each word and ``-widest`` at least."""
    unique, where, inverse = np.unique(words.unique, return_index=True, return_inverse=True)
    scores = np.zeros((len(where), logs.shape[1]), dtype=np.float32)
    for a in range(0, len(where), 20_000):
        part = where[a : a + 20_000]
        owner, bucket = n_grams(words, part, settings)
        for k in range(logs.shape[1]):
            scores[a : a + len(part), k] = np.bincount(owner, weights=logs[bucket, k], minlength=len(part))
    # n-grams of the sizes overlap, so each size has its share of the word.
    scores /= len(settings.grams)
    scores[~allowed[words.script[where]]] = -np.inf
    scores -= scores.max(axis=1, keepdims=True, initial=-np.inf) if len(scores) else 0
    return np.maximum(scores, -settings.widest)[inverse]


def viterbi(first: np.ndarray, scores: np.ndarray, switch: float) -> np.ndarray:
    """The best language of every word of every text: greatest sum of scores less ``switch`` a change; of equal
    ones the first language. All texts are worked through side by side, word number by word number."""
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    begin = first[:-1][order]
    active = len(order) - np.searchsorted(length[order][::-1], np.arange(int(length.max(initial=0))), side="right")
    came = np.zeros(scores.shape, dtype=bool)  # whether the best way to this language changes into it
    best = np.zeros(len(scores), dtype=np.int32)  # the best language of each word seen from its start
    values = np.zeros((len(order), scores.shape[1]), dtype=np.float64)
    for t, n in enumerate(active.tolist()):
        at = begin[:n] + t
        now = values[:n]
        if t:
            top = now.argmax(axis=1)
            changed = now[np.arange(n), top] - switch
            came[at] = changed[:, None] > now
            np.maximum(now, changed[:, None], out=now)
            best[at - 1] = top
        now += scores[at]
    some = order[length[order] > 0]
    best[first[1:][some] - 1] = values[: len(some)].argmax(axis=1)
    label = np.zeros(len(scores), dtype=np.int32)
    state = np.zeros(len(order), dtype=np.int32)
    for t in range(len(active) - 1, -1, -1):
        n = int(active[t])
        at = begin[:n] + t
        ends = length[order[:n]] == t + 1
        state[:n][ends] = best[at[ends]]
        label[at] = state[:n]
        if t:
            back = came[at, state[:n]]
            state[:n][back] = best[at[back] - 1]
    return label


def _labelled(texts: list[str | None], alphabet: Alphabet, logs: np.ndarray, allowed: np.ndarray, settings: Settings):
    """Per text: number of its language (-1: none), score, and spans as (starts, stops, languages)."""
    words = words_of(texts, alphabet)
    scores = word_scores(words, logs, allowed, settings)
    label = viterbi(words.first, scores, settings.switch)
    n, k = len(texts), logs.shape[1]
    owner = np.repeat(np.arange(n), np.diff(words.first))
    letters = words.letters()
    held = np.bincount(owner * k + label, weights=letters, minlength=n * k).reshape(n, k)
    lang = held.argmax(axis=1)
    share = held[np.arange(n), lang] / np.maximum(1, held.sum(axis=1))
    # How sure the words in spans of that language are of it.
    own = label == lang[owner]
    sums = np.stack([np.bincount(owner[own], weights=scores[own, j], minlength=n) for j in range(k)], axis=1)
    sums -= sums[np.arange(n), lang][:, None]
    sure = 1.0 / np.exp(np.minimum(sums, 30)).sum(axis=1)
    turn = np.flatnonzero(np.append(True, (label[1:] != label[:-1]) | (owner[1:] != owner[:-1]))) if len(owner) else owner
    last = np.append(turn[1:], len(owner))[: len(turn)] - 1
    cuts = np.searchsorted(owner[turn], np.arange(n + 1))
    lang = np.where(np.diff(words.first) > 0, lang, -1)
    return lang, share * sure, cuts, words.start[turn], words.stop[last], label[turn]


SPANS = T.ArrayType(
    T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()), T.StructField("lang", T.StringType())])
)
RESULT = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("spans", SPANS)])


def identifier(spark: SparkSession, model: Model):
    """A column function text -> (lang, score, spans). Spans are runs of words of one language, by code points."""
    settings, languages = model.settings, model.languages
    shared = spark.sparkContext.broadcast((model.logs, candidates(model)))  # 4 * buckets bytes a language

    @F.pandas_udf(RESULT)
    def identify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        alphabet = Alphabet()
        logs, allowed = shared.value
        for texts in batches:
            values, rows = texts.tolist(), []
            for a, b in in_blocks(values, BLOCK):
                if not languages:
                    rows += [(UNDETERMINED, 0.0, [])] * (b - a)
                    continue
                lang, score, cuts, start, stop, label = _labelled(values[a:b], alphabet, logs, allowed, settings)
                spans = [
                    {"start": x, "stop": y, "lang": languages[z]} for x, y, z in zip(start.tolist(), stop.tolist(), label.tolist())
                ]
                cuts = cuts.tolist()
                rows += [
                    (languages[k], s, spans[cuts[i] : cuts[i + 1]]) if k >= 0 else (UNDETERMINED, 0.0, [])
                    for i, (k, s) in enumerate(zip(lang.tolist(), score.tolist()))
                ]
            yield pd.DataFrame(rows, columns=["lang", "score", "spans"])

    return identify


def identified(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` (0 to 1) and ``spans``; columns of these names are replaced.

    ``lang_pred`` is the language with most letters in its spans, the first of equal ones, and ``und`` for a text that is
    NULL or has no letter, which has score 0 and no spans. The score is the share of those letters times how sure
    their words are of the language. Rows stay where they lie, repeated rows too.
    """
    small_batches(docs.sparkSession)
    found = identifier(docs.sparkSession, model)(F.col(text))
    names = ("lang_pred", "score", "spans")
    rows = docs.withColumn("_found", found)
    return rows.withColumns({n: F.col(f"_found.{f}") for n, f in zip(names, ("lang", "score", "spans"))}).drop("_found")
