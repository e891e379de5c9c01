"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding: compatibility form, lower case, look-alike letters of other scripts and digits or signs that stand for
letters become Latin letters, accents and combining marks that split a word are dropped with invisible
characters, everything but letters becomes a space.

The lexicon is learnt: words and word beginnings that occur in toxic training documents and
hardly in others. An entry must be supported by more documents than chance explains: among all terms found
in k training documents, the number expected to be found in toxic ones only has to stay below
MOST_BY_CHANCE. Weights are log odds. Matches inside an exception phrase do not count.

The score is a logistic function of the total weight and of the weight per length. Training takes at most
TRAINING_ROWS labelled rows outside the held-out fifth. Null and empty texts match
nothing. With no labelled rows or labels of one kind only, nothing is toxic.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagwatch.llm.common import batches, held_out, stage, texts_of, training_rows

TRAINING_ROWS = 6_000
THRESHOLD = 0.5
#: Lengths of word beginnings that may become entries.
BEGINNINGS = range(4, 10)
LEAST_SUPPORT = 4
LEAST_PRECISION = 0.95
#: Terms found in equally many training documents that chance alone may put among the entries.
MOST_BY_CHANCE = 0.05
#: Words of usual length for a document; keeps very short texts from being judged on density alone.
USUAL = 50

# Letters of other scripts that look like Latin ones.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ո": "n", "ս": "u", "ɡ": "g", "ı": "i", "ӏ": "l",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
}
# Digits and signs used as letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}
# Phrases in which a word of abuse means something else.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "circus clown", "pond scum")

_SIGNS = re.compile(r"(?<=\w)[@$!|](?=\w)")
_DIGITS = re.compile(r"(?:(?<=[^\W\d_])[013457-8]+)|(?:[013457-8]+(?=[^\W\d_]))")
_HIDDEN = re.compile("[­​-‏⁠﻿]")
_OTHER = re.compile(r"[\W\d_]+")
_LETTERS = str.maketrans(LOOK_ALIKES)


def fold(text: str) -> str:
    """Folded words, one space before, between and after them."""
    if not text.isascii():
        text = _HIDDEN.sub("", unicodedata.normalize("NFKC", text))
    text = text.lower()
    if not text.isascii() and max(text) > "İ":
        text = text.translate(_LETTERS)
    if "@" in text or "$" in text or "!" in text or "|" in text:
        text = _SIGNS.sub(lambda m: SUBSTITUTES[m[0]], text)
    text = _DIGITS.sub(lambda m: "".join([SUBSTITUTES[c] for c in m[0]]), text)
    return " " + _OTHER.sub(" ", text).strip() + " "


@dataclass
class Model:
    """``entries``: folded pattern with its boundary spaces, and weight; ``layer``: bias and two factors."""

    entries: dict[str, float]
    layer: tuple[float, float, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    _built: list = field(default_factory=list, repr=False)

    def automaton(self) -> ahocorasick.Automaton:
        if not self._built:
            built = ahocorasick.Automaton()
            for pattern, weight in self.entries.items():
                built.add_word(pattern, (len(pattern), weight))
            for phrase in self.exceptions:
                folded = fold(phrase)
                built.add_word(folded, (len(folded), None))
            built.make_automaton()
            self._built.append(built)
        return self._built[0]

    def __getstate__(self):
        return {**self.__dict__, "_built": []}

    def weight(self, folded: str) -> float:
        """Total weight of matches outside exception phrases; one match for each place."""
        if not self.entries:
            return 0.0
        found, spared = [], []
        for end, (n, weight) in self.automaton().iter(folded):
            if weight is None:
                spared.append((end + 1 - n, end))
            else:
                found.append((end + 1 - n, end, weight))
        if spared:
            found = [f for f in found if not any(a <= f[0] and f[1] <= b for a, b in spared)]
        best: dict[int, float] = {}
        for begin, _, weight in found:
            best[begin] = max(best.get(begin, 0.0), weight)
        return sum(best.values())

    def features(self, folded: str) -> tuple[float, float]:
        total = self.weight(folded)
        words = folded.count(" ") - 1
        return math.log1p(total), math.log1p(100 * total / (USUAL + max(words, 0)))

    def score(self, text: str) -> float:
        a, b = self.features(fold(text))
        bias, fa, fb = self.layer
        return 1 / (1 + math.exp(-min(max(bias + fa * a + fb * b, -500), 500)))


def terms_of(folded: str) -> set[str]:
    """Words (with a space on both sides) and word beginnings (with one before) of a document."""
    out = set()
    for word in set(folded.split()):
        out.add(f" {word} ")
        out.update([f" {word[:n]}" for n in BEGINNINGS if n <= len(word)])
    return out


def choose(counts: list[tuple[str, int, int]], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Lexicon from (term, toxic documents, other documents) with enough evidence.

    Of nested terms with about the same support the longest is taken, a whole word before a beginning.
    """
    support = {t: p for t, p, _ in counts}
    chosen: dict[str, float] = {}
    roots = sorted(support, key=lambda t: (len(t.rstrip()), t))
    below = defaultdict(list)
    for t in roots:
        word = t.strip()
        for n in range(min(BEGINNINGS), len(word) + 1):
            if f" {word[:n]}" != t:
                below[f" {word[:n]}"].append(t)
    taken: set[str] = set()
    clean = {t: n for t, _, n in counts}
    for t in roots:
        if t in taken:
            continue
        like = [u for u in below.get(t, []) if support[u] >= 0.95 * support[t]]
        best = max(like, key=lambda u: (u.endswith(" "), len(u), u), default=t)
        taken.update(below.get(t, []))
        odds = (support[best] + 0.5) / (n_toxic + 1) * (n_clean + 1) / (clean[best] + 0.5)
        chosen[best] = math.log(odds)
    return chosen


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 50) -> tuple[float, ...]:
    """Newton steps for a small logistic regression with bias."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (p - y) / len(y) * 100 + ridge * w
        curve = (x.T * (p * (1 - p))) @ x / len(y) * 100 + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, w))


def sketch(folded: str) -> int:
    """Least hash of the 3-word runs: equal for copies, and mostly for copies with a few edits."""
    words = folded.split()
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    return min(map(xxhash.xxh3_64_intdigest, runs)) >> 1


def _distinct(rows: DataFrame, name: str) -> DataFrame:
    """One training row of each group of copies; copies would make chance words look supported."""

    names = ["doc_id", "text", "label", "sketch"]

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, 500):
            values = [sketch(fold(t)) for t in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.int64())], names)

    marked = stage(rows.mapInArrow(run, "doc_id long, text string, label int, sketch long"), f"{name}-sketches")
    first = marked.groupBy("label", "sketch").agg(F.min("doc_id").alias("doc_id"))
    return marked.join(first, ["doc_id", "label", "sketch"]).dropDuplicates(["doc_id"]).select("doc_id", "text", "label")


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS, exceptions: Sequence[str] = EXCEPTIONS, name: str = "toxicity") -> Model:
    """Learn lexicon and scale on at most ``most`` labelled rows."""
    rows = stage(_distinct(training_rows(docs, labels, "toxic", most), name), f"{name}-training")
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    never = Model({}, (-10.0, 0.0, 0.0), tuple(exceptions))
    if not n_toxic or not n_clean:
        return never

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, 500):
            found = (Counter(), Counter())
            for text, label in zip(texts_of(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                found[label].update(terms_of(fold(text)))
            terms = list(found[0].keys() | found[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), *(pa.array([found[i][t] for t in terms], pa.int64()) for i in (1, 0))],
                ["term", "toxic", "clean"],
            )

    counted = rows.mapInArrow(count, "term string, toxic long, clean long")
    counted = counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counted = stage(counted, f"{name}-terms")
    share = n_toxic / (n_toxic + n_clean)
    # of the terms found in k documents, so many are expected in toxic ones only by chance
    spread = counted.withColumn("k", F.col("toxic") + F.col("clean")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    spread = spread.withColumn("chance", F.col("n") * F.pow(F.lit(share), F.col("k")))
    unlikely = spread.filter((F.col("chance") < MOST_BY_CHANCE) & (F.col("k") >= LEAST_SUPPORT)).select("k")
    sure = (
        counted.withColumn("k", F.col("toxic") + F.col("clean"))
        .filter(F.col("toxic") >= LEAST_PRECISION * F.col("k"))
        .join(F.broadcast(unlikely), "k", "left_semi")
    )
    entries = choose([(r["term"], r["toxic"], r["clean"]) for r in sure.collect()], n_toxic, n_clean)
    model = Model(entries, (0.0, 0.0, 0.0), tuple(exceptions))

    def features(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, 500):
            made = [model.features(fold(t)) for t in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([m[i] for m in made], pa.float64()) for i in (0, 1)] + [batch.column(2)], ["a", "b", "label"]
            )

    got = rows.mapInArrow(features, "a double, b double, label int").collect()
    x, y = np.array([[r["a"], r["b"]] for r in got]), np.array([r["label"] for r in got], float)
    order = np.lexsort((y, x[:, 1], x[:, 0]))
    model.layer = logistic(x[order], y[order])
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of ``docs``."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, 500):
            values = [model.score(t) for t in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def judge(docs: DataFrame, labels: DataFrame, name: str = "toxicity") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, name=name)
    return score(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
