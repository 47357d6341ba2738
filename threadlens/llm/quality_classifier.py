"""Quality classifier: averaged subword embeddings, learned by stochastic gradient descent.

A document is the average of the vectors of its tokens: hashed words, their character
trigrams, a marker for a word that repeats the one before, and a marker for the order of
magnitude of its length.  A softmax layer over two classes follows.  Vectors and layer are
trained together with numpy on a bounded sample of labelled documents.

Averages and the layer are linear, so a token counts with one number, its vector times the
layer.  Scoring adds up these numbers per word and keeps those of words already seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NGRAM = 3
#: Words remembered by a scoring task before it starts anew.
CACHE_WORDS = 400_000
REPEAT = b"\x00repeat"
LENGTH = b"\x00length%d"


@dataclass(frozen=True)
class Settings:
    """``max_examples`` bounds the labelled documents that are learned from."""

    max_examples: int = 4_000
    bucket_bits: int = 15
    dimensions: int = 8
    epochs: int = 5
    batch: int = 32
    rate: float = 0.2
    held_out_fold: int = 0
    folds: int = 5
    seed: int = 42


def held_out(settings: Settings) -> Column:
    """Whether a document is in the fold that is never learned from; false without an id."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % settings.folds
    return F.coalesce(fold == settings.held_out_fold, F.lit(False))


def _buckets(word: bytes, mask: int) -> list[int]:
    """Hash buckets of a word and of its trigrams."""
    marked = b"<" + word + b">"
    return [crc32(word) & mask] + [
        crc32(marked[i : i + NGRAM], 1) & mask for i in range(len(marked) - NGRAM + 1)
    ]


def _markers(words: list[bytes], mask: int) -> tuple[int, float, int]:
    """(bucket of the repeat marker, share of repeating words, bucket of the length)."""
    repeats = sum(map(bytes.__eq__, words[1:], words))
    share = repeats / len(words) if words else 0.0
    return crc32(REPEAT) & mask, share, crc32(LENGTH % len(words).bit_length()) & mask


def _features(data: bytes, mask: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their weights; each word's tokens share its weight."""
    words = data.split()
    weights = np.zeros(mask + 1, np.float32)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    for w, n in counts.items():
        own = _buckets(w, mask)
        np.add.at(weights, own, n / (len(words) * len(own)))
    repeat, share, length = _markers(words, mask)
    weights[repeat] += share
    weights[length] += 0.1
    found = np.flatnonzero(weights)
    return found.astype(np.int32), weights[found]


@dataclass(frozen=True)
class Model:
    """One number per bucket and a bias: log-odds of label 1."""

    buckets: np.ndarray
    bias: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return _Scorer(self)(texts)


class _Scorer:
    def __init__(self, model: Model):
        self.values, self.bias = model.buckets.tolist(), model.bias
        self.mask = len(model.buckets) - 1
        self.known: dict[bytes, float] = {}

    def _word(self, word: bytes) -> float:
        own = _buckets(word, self.mask)
        value = sum(map(self.values.__getitem__, own)) / len(own)
        self.known[word] = value
        return value

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        logits = []
        for data in texts:
            if len(self.known) > CACHE_WORDS:
                self.known.clear()
            words = data.split()
            known = self.known
            for w in set(words).difference(known):
                self._word(w)
            repeat, share, length = _markers(words, self.mask)
            mean = sum(map(known.__getitem__, words)) / len(words) if words else 0.0
            logits.append(
                mean + self.bias + share * self.values[repeat] + 0.1 * self.values[length]
            )
        return 1.0 / (1.0 + np.exp(-np.clip(np.array(logits, np.float64), -500, 500)))


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], settings: Settings) -> Model:
    """Stochastic gradient descent over (buckets, weights, label); no examples: all scores 0.5."""
    rng = np.random.default_rng(settings.seed)
    size, dim = 1 << settings.bucket_bits, settings.dimensions
    vectors = rng.uniform(-0.5, 0.5, (size, dim)).astype(np.float32) / dim
    layer = rng.uniform(-0.5, 0.5, (dim, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    if not examples:
        return Model(np.zeros(size, np.float32), 0.0)
    step, total = 0, settings.epochs * -(-len(examples) // settings.batch)
    # steps shrink with the squared gradients a vector has seen, so rare tokens learn too
    seen, seen_layer, seen_bias = np.zeros(size, np.float32), 1e-6, 1e-6
    for _ in range(settings.epochs):
        order = rng.permutation(len(examples))
        for at in range(0, len(order), settings.batch):
            chosen = [examples[i] for i in order[at : at + settings.batch]]
            sizes = [len(b) for b, _, _ in chosen]
            ids = np.concatenate([b for b, _, _ in chosen])
            weights = np.concatenate([w for _, w, _ in chosen])[:, None]
            owner = np.repeat(np.arange(len(chosen)), sizes)
            means = np.add.reduceat(vectors[ids] * weights, np.cumsum([0, *sizes[:-1]]), axis=0)
            logits = means @ layer + bias
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = odds / odds.sum(axis=1, keepdims=True)
            error[np.arange(len(chosen)), [y for _, _, y in chosen]] -= 1.0
            error /= len(chosen)
            rate = settings.rate * (1 - step / total)
            back = error @ layer.T
            slope = means.T @ error
            seen_layer += float((slope**2).mean())
            layer -= rate * slope / seen_layer**0.5
            seen_bias += float((error.sum(axis=0) ** 2).mean())
            bias -= rate * error.sum(axis=0) / seen_bias**0.5
            buckets, inverse = np.unique(ids, return_inverse=True)
            slope = np.zeros((len(buckets), dim), np.float32)
            np.add.at(slope, inverse, weights * back[owner])
            seen[buckets] += (slope**2).mean(axis=1)
            vectors[buckets] -= rate * slope / np.sqrt(seen[buckets] + 1e-12)[:, None]
            step += 1
    direction = layer[:, 1] - layer[:, 0]
    return Model((vectors @ direction).astype(np.float32), float(bias[1] - bias[0]))


def fit_quality(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn ``labels.quality`` (0 or 1; other values are ignored) outside the held-out fold.

    The sample are the ``max_examples`` labelled ids first in a seeded random order, so
    what reaches the driver has a bound.
    """
    marked = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    sample = (
        marked.filter(~held_out(settings))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64(F.lit(settings.seed), "doc_id"), "doc_id")
        .limit(settings.max_examples)
    )
    mask = (1 << settings.bucket_bits) - 1
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    # at most max_examples narrow rows
    rows = rows.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "quality")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_features(t.as_py(), mask) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.string()),
                    pa.array([b.tobytes() for b, _ in found], pa.binary()),
                    pa.array([w.tobytes() for _, w in found], pa.binary()),
                    batch.column(2).cast(pa.int32()),
                ],
                names=["doc_id", "buckets", "weights", "quality"],
            )

    schema = "doc_id string, buckets binary, weights binary, quality int"
    collected = sorted(map(tuple, rows.mapInArrow(run, schema).collect()))
    examples = [
        (np.frombuffer(b, np.int32), np.frombuffer(w, np.float32), y) for _, b, w, y in collected
    ]
    return train(examples[: settings.max_examples], settings)


def score_quality(docs: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, held_out, score) of every row of ``docs``, by its whole text alone.

    A null or empty text is scored by its length marker; rows that repeat are scored
    alike; a row without a doc_id is scored and not held out.
    """
    # one number per bucket, whatever the input
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(
        "doc_id",
        held_out(settings).alias("held_out"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    schema = rows.drop("text").schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for batch in batches:
            scores = scorer(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores)], names=schema.names
            )

    return rows.mapInArrow(run, schema)
