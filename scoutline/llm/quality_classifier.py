"""Quality classifier: hashed word n-gram logistic regression, trained with FTRL-proximal updates.

Features are word n-grams of two kinds, unigrams and bigrams of the words themselves and of their
forms (the kinds of characters in a word, its length class, and whether it repeats the word before).
Every n-gram is hashed into a fixed number of buckets and weighs its share of the text's n-grams, so
a score is one sparse dot product, whatever the length of the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoutline.llm.words import Words, hashed_words, in_blocks, mixed, small_batches
from scoutline.session import stored

#: Rows whose checksum has this remainder are held out.
FOLDS, HELD_OUT = 4, 2


@dataclass(frozen=True)
class Settings:
    """``train_rows`` bounds the labelled rows used for fitting (chosen by a hash of the id). They are
    spread over shards of about ``shard_rows`` that learn side by side; the weights are averaged."""

    buckets: int = 1 << 18
    train_rows: int = 12_000
    shard_rows: int = 1_500
    epochs: int = 8
    alpha: float = 10.0
    beta: float = 1.0
    l1: float = 0.002
    l2: float = 0.01
    keep: float = 0.7


# Bits of the kinds of characters: letters, digits, bytes outside ASCII, and one for each ASCII symbol.
_KINDS = np.zeros(256, dtype=np.uint64)
for _byte in range(256):
    _char = chr(_byte)
    if _byte >= 128:
        _KINDS[_byte] = 1
    elif _char.islower():
        _KINDS[_byte] = 1
    elif _char.isupper():
        _KINDS[_byte] = 2
    elif _char.isdigit():
        _KINDS[_byte] = 4
    elif 33 <= _byte < 127:
        _KINDS[_byte] = 1 << (3 + _byte % 60)


def held_out(doc_id: Column) -> Column:
    """Whether the CRC-32 of the id as text falls into the held-out fold; never for a NULL id."""
    remainder = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))
    return F.coalesce(remainder == HELD_OUT, F.lit(False))


def _features(words: Words, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, weight) of every n-gram; weights of one text sum to 1 over each of four families."""
    per_text = np.diff(words.first)
    n = len(per_text)
    owner = np.repeat(np.arange(n), per_text)
    length = np.minimum(words.stop - words.start, 24).astype(np.uint64)
    again = np.zeros(len(words), dtype=np.uint64)
    pair = owner[1:] == owner[:-1] if len(words) else np.zeros(0, dtype=bool)
    if len(words):
        again[1:] = (words.hash[1:] == words.hash[:-1]) & pair
    form = mixed((words.kinds << np.uint64(1) | again) * np.uint64(31) + length)
    odd = np.uint64(0x9E3779B97F4A7C15)
    left, right = words.hash[:-1][pair], words.hash[1:][pair]
    form_left, form_right = form[:-1][pair], form[1:][pair]
    second = owner[1:][pair]
    families = (
        (owner, words.hash),
        (second, mixed(left * odd + right)),
        (owner, mixed(form + odd)),
        (second, mixed(form_left * odd ^ form_right)),
    )
    texts, places, weights = [], [], []
    for of, hashes in families:
        share = 1.0 / np.maximum(1, np.bincount(of, minlength=n))
        texts.append(of)
        places.append((hashes % np.uint64(buckets)).astype(np.int64))
        weights.append(share[of])
    return np.concatenate(texts), np.concatenate(places), np.concatenate(weights)


def _sparse(texts: pd.Series, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, weights) of each text, equal buckets united."""
    for a, b in in_blocks(texts.tolist()):
        of, place, weight = _features(hashed_words(texts.iloc[a:b].tolist(), kinds=_KINDS), buckets)
        key = of * buckets + place
        unique, inverse = np.unique(key, return_inverse=True)
        sums = np.bincount(inverse, weights=weight, minlength=len(unique))
        cuts = np.searchsorted(unique, np.arange(b - a + 1) * buckets)
        for i in range(b - a):
            part = slice(cuts[i], cuts[i + 1])
            yield unique[part] % buckets, sums[part]


def _learn(rows: pd.DataFrame, settings: Settings) -> np.ndarray:
    """Weights after ``epochs`` passes of FTRL-proximal over the rows; the last one is the bias."""
    z = np.zeros(settings.buckets + 1)
    n = np.zeros(settings.buckets + 1)
    bias = settings.buckets

    def weights(at: np.ndarray) -> np.ndarray:
        drawn, seen = z[at], n[at]
        shrunk = np.where(at == bias, drawn, np.sign(drawn) * np.maximum(0.0, np.abs(drawn) - settings.l1))
        return -shrunk / ((settings.beta + np.sqrt(seen)) / settings.alpha + settings.l2)

    examples = [
        (
            np.append(np.frombuffer(p, dtype=np.int32), bias).astype(np.int64),
            np.append(np.frombuffer(w, dtype=np.float32), 1.0).astype(np.float64),
            y,
        )
        for p, w, y in zip(rows.places, rows.weights, rows.quality)
    ]
    order = np.random.default_rng(7)
    for _ in range(settings.epochs):
        for i in order.permutation(len(examples)):
            at, x, y = examples[i]
            w = weights(at)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / settings.alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange(settings.buckets + 1))


@dataclass
class Model:
    """Averaged weights (buckets, then the bias) and the number of rows they were learned from."""

    weights: np.ndarray
    rows: int
    settings: Settings


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on at most ``train_rows`` labelled documents outside the held-out fold.

    A document with several labels counts as bad if one of them does; NULL labels and labels without
    a document are left out; rows that share an id are one example, the smallest text. Only
    the sampled ids are broadcast (at most ``train_rows`` of them), so no other text moves. Without
    labelled rows all weights are zero and every score is 0.5.
    """
    small_batches(docs.sparkSession)
    buckets = settings.buckets
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
    )
    sample = stored(
        known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.train_rows), "training-ids"
    )
    shards = -(-sample.count() // settings.shard_rows) or 1
    texts = (
        docs.select("doc_id", "text")
        .join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id", "quality")
        .agg(F.min("text").alias("text"))
    )

    def featurize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = list(_sparse(batch.text, buckets))
            yield pd.DataFrame(
                {
                    "doc_id": batch.doc_id,
                    "quality": batch.quality,
                    "places": [p.astype(np.int32).tobytes() for p, _ in rows],
                    "weights": [w.astype(np.float32).tobytes() for _, w in rows],
                }
            )

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id", ignore_index=True)
        learned = _learn(rows, settings).astype(np.float32)
        return pd.DataFrame({"shard": [int(rows.shard[0])], "rows": [len(rows)], "weights": [learned.tobytes()]})

    parts = (
        texts.mapInPandas(featurize, "doc_id bigint, quality int, places binary, weights binary")
        .withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int"))
        .groupBy("shard")
        .applyInPandas(fit, "shard int, rows bigint, weights binary")
        .collect()  # one row of 4 * buckets bytes per shard
    )
    total = sum(r["rows"] for r in parts)
    weights = np.zeros(buckets + 1)
    for r in sorted(parts, key=lambda r: r["shard"]):
        weights += np.frombuffer(r["weights"], dtype=np.float32).astype(np.float64) * (r["rows"] / total)
    return Model(weights.astype(np.float32), total, settings)


def scorer(spark: SparkSession, model: Model):
    """A column function text -> score; NULL and empty texts score as the bias alone."""
    buckets = model.settings.buckets
    shared = spark.sparkContext.broadcast(model.weights)  # 4 * buckets bytes

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = shared.value.astype(np.float64)
        for texts in batches:
            values, rows = texts.tolist(), []
            for a, b in in_blocks(values):
                of, place, weight = _features(hashed_words(values[a:b], kinds=_KINDS), buckets)
                sums = np.bincount(of, weights=weights[place] * weight, minlength=b - a) + weights[buckets]
                rows.append(1.0 / (1.0 + np.exp(-np.clip(sums, -35, 35))))
            yield pd.Series(np.concatenate(rows) if rows else np.zeros(0))

    return score


def scored(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """Add ``score`` and ``predicted`` (1 from the ``keep`` score on); columns of these names are
    replaced. Rows are scored where they lie."""
    small_batches(docs.sparkSession)
    score = scorer(docs.sparkSession, model)
    rows = docs.withColumn("score", score(F.col(text)))
    return rows.withColumn("predicted", (F.col("score") >= model.settings.keep).cast("int"))
