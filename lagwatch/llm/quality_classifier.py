"""Supervised subword embeddings: a document is the mean of learnt vectors of hashed features.

Features are words, character n-grams of words with their ends marked, and an echo mark for a word that
equals the one before it. A linear layer with softmax follows. Vectors and layer are trained together by
stochastic gradient descent in numpy, on a bounded sample of labelled rows (``TRAINING_ROWS``) outside
the held-out fifth; executors turn those texts into feature counts.

Scoring needs no vectors: the mean of vectors times the layer is a mean of one number per feature, so each word
has one number (the sum over its features), remembered by the Python worker.

Nulls: a null or empty text has no features and gets the share of label 1 among the training rows. With
no labelled rows all scores are 1, with labels of one kind only the score is that label.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagwatch.llm import memory
from lagwatch.llm.common import batches, bytes_of, held_out, stage, training_rows

#: Bound on the rows that training sees, and so on what reaches the driver.
TRAINING_ROWS = 2_000
BUCKETS = 1 << 17
DIMENSIONS = 8
GRAMS = (2, 3, 4)
EPOCHS = 8
RATE = 2.0
#: Words remembered by one Python worker before older ones go.
MEMORY = 150_000
ECHO = 0
THRESHOLD = 0.3


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of each word laid end to end, and their number for each word.

    A word ``w`` has the n-grams of ``<w>`` in code points and the whole of it. Bucket 0 is the echo.
    """
    text = "".join([f"<{w.decode()}>" for w in words])
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(w.decode()) + 2 for w in words), np.int64, len(words))
    starts = np.cumsum(lengths) - lengths
    ends = np.repeat(starts + lengths, lengths)
    place = np.arange(len(points))
    word = np.repeat(np.arange(len(words)), lengths)
    hashes, owners = [], []
    step, rolled = np.uint64(0x100000001B3), np.zeros(len(points), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        valid = len(points) - n + 1
        rolled = rolled[:valid] * step + points[n - 1 :]
        if n in GRAMS:
            inside = place[:valid] + n <= ends[:valid]
            hashes.append(rolled[inside] + np.uint64(n))
            owners.append(word[:valid][inside])
    weights = points * np.cumprod(np.full(len(points), 0x9E3779B1, np.uint64))[place - np.repeat(starts, lengths)]
    hashes.append(np.add.reduceat(weights, starts) if len(words) else points)
    owners.append(np.arange(len(words)))
    flat, owner = np.concatenate(hashes), np.concatenate(owners)
    flat ^= flat >> np.uint64(29)
    flat *= np.uint64(0xBF58476D1CE4E5B9)
    flat ^= flat >> np.uint64(32)
    order = np.argsort(owner, kind="stable")
    return (1 + (flat % np.uint64(BUCKETS - 1)).astype(np.int64))[order], np.bincount(owner, minlength=len(words))


def echoes(words: list[bytes]) -> int:
    return sum(map(bytes.__eq__, words, words[1:]))


def document_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a document and their counts."""
    words = text.split()
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    distinct: dict[bytes, int] = {}
    for w in words:
        distinct[w] = distinct.get(w, 0) + 1
    buckets, sizes = word_features(list(distinct))
    times = np.repeat(np.fromiter(distinct.values(), np.int64, len(distinct)), sizes)
    found, inverse = np.unique(np.append(buckets, ECHO), return_inverse=True)
    # an echo weighs as much as the features of a word
    counts = np.bincount(inverse, np.append(times, echoes(words) * (times.sum() / len(words))))
    return found.astype(np.int32), counts.astype(np.float32)


@dataclass
class Model:
    """``gains``: what each bucket adds to the log odds of label 1; ``bias``; ``prior``."""

    gains: np.ndarray
    bias: float
    prior: float


def train(rows: list[tuple[bytes, bytes, int]], seed: int = 5) -> Model:
    """Gradient descent over (buckets, counts, label) rows, in a fixed random order."""
    labels = [r[2] for r in rows]
    if not rows or min(labels) == max(labels):
        prior = float(labels[0]) if rows else 1.0
        return Model(np.zeros(BUCKETS, np.float32), math.inf if prior else -math.inf, prior)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-0.5 / DIMENSIONS, 0.5 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer = np.zeros((2, DIMENSIONS), np.float32)
    bias = np.zeros(2, np.float32)
    data = []
    for buckets, counts, label in rows:
        b, c = np.frombuffer(buckets, np.int32), np.frombuffer(counts, np.float32)
        if len(b):
            data.append((b, (c / c.sum())[:, None], label))
    steps = EPOCHS * len(data)
    done = 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(data)):
            buckets, share, label = data[i]
            mean = (vectors[buckets] * share).sum(0)
            logits = layer @ mean + bias
            odds = np.exp(logits - logits.max())
            odds /= odds.sum()
            odds[label] -= 1
            rate = RATE * (1 - done / steps)
            done += 1
            back = odds @ layer
            layer -= rate * np.outer(odds, mean)
            bias -= 0.1 * rate * odds
            vectors[buckets] -= (rate * share) * back
    gains = vectors @ (layer[1] - layer[0])
    return Model(gains, float(bias[1] - bias[0]), sum(labels) / len(labels))


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS, name: str = "classifier") -> Model:
    """Train on at most ``most`` labelled rows; their feature counts reach the driver."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, 200):
            made = [document_features(t) for t in bytes_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([b.tobytes() for b, _ in made], pa.binary()),
                 pa.array([c.tobytes() for _, c in made], pa.binary()), batch.column(2)],
                ["doc_id", "b", "c", "label"],
            )

    rows = training_rows(docs, labels, "quality", most)
    rows = stage(rows.mapInArrow(run, "doc_id long, b binary, c binary, label int"), f"{name}-training")
    got = sorted((r["doc_id"], bytes(r["b"]), bytes(r["c"]), r["label"]) for r in rows.toLocalIterator())
    return train([r[1:] for r in got])


class Scorer:
    """Sum and number of features of each word, remembered in two generations."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[bytes, complex] = {}
        self.old: dict[bytes, complex] = {}

    def learn(self, words: list[bytes]) -> None:
        buckets, sizes = word_features(words)
        starts = np.cumsum(sizes) - sizes
        sums = np.add.reduceat(self.model.gains[buckets].astype(np.float64), starts)
        # one complex number holds sum and count, so that a document is one sum over its words
        self.known.update(zip(words, (sums + 1j * sizes).tolist(), strict=True))

    def __call__(self, texts: list[bytes]) -> list[float]:
        if len(self.known) > MEMORY:
            self.old, self.known = self.known, {}
        known, old, out = self.known, self.old, []
        for text in texts:
            words = text.split()
            if not words:
                out.append(self.model.prior)
                continue
            found = list(map(known.get, words))
            if None in found:
                new = {w for w, v in zip(words, found, strict=True) if v is None}
                known.update((w, old[w]) for w in new if w in old)
                new = [w for w in new if w not in known]
                if new:
                    self.learn(new)
                found = list(map(known.__getitem__, words))
            total = complex(np.array(found).sum())
            n, echo = total.imag, echoes(words)
            extra = echo * n / len(words)
            logit = (total.real + extra * float(self.model.gains[ECHO])) / (n + extra) + self.model.bias
            out.append(1 / (1 + math.exp(-min(max(logit, -500), 500))))
        return out


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 added; the model is broadcast (BUCKETS numbers)."""
    if column in docs.columns:
        docs = docs.drop(column)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    names = docs.columns

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.begin("classifier")
        judge = Scorer(shared.value)
        for batch in batches(source, 500):
            values = judge(bytes_of(batch.column(names.index("text"))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], [*names, column])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{column}` double"
    return docs.mapInArrow(run, schema)


def judge(docs: DataFrame, labels: DataFrame, name: str = "classifier") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, name=name)
    scored = score(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), model)
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, name: str = "classifier") -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all their columns."""
    model = fit(docs, labels, name=name)
    added = "_score"
    while added in docs.columns:
        added += "_"
    return score(docs, model, added).filter(F.col(added) >= THRESHOLD).drop(added)
