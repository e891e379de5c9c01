"""Spelling variants: words of a vocabulary that are one edit apart, grouped under their commonest form.

Counting: words are counted per document and batch inside the tasks, so a word of any frequency is a
few rows before the shuffle.

Neighbourhoods are found without pairs of words. Every word generates the words one deletion or one
replacement away (an insertion is a deletion seen from the other word) as hashes only, by adding to
or taking from the word's own polynomial hash. They are probed against Bloom filters of the
vocabulary, one per word length, in blocks of one 64-bit number. The filters are the only thing broadcast:
at most FILTER_BLOCKS blocks altogether (32 MB). A larger vocabulary makes them denser, which costs more
false positives and loses nothing. Only positives are shuffled, to an exact join with the vocabulary on
length and 128 hash bits; the two words of each match are then compared, so a hash decides nothing.

A form has at least RATIO times the occurrences of its word, so chains of forms are short: a chain of
2^6 steps would need more than 5^64 occurrences, and STEPS doublings follow every one to its end.

Defined results: a null text has no words; a null doc_id is written as no digits in the hashed key; repeated
rows count each; an empty table gives no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagwatch.llm.common import batches, stage

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Code points of which edits are made: those of a run after lower-casing A-Z.
LETTERS = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint64)
DELETE_EVERY = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
STEPS = 6
FILTER_BLOCKS = 1 << 22
#: Words in a block of 64 bits, while the bound allows it, and bits set for each.
WORDS_PER_BLOCK = 4
BITS = 4
#: Lengths from here on share a filter.
LONGEST = 64
#: Distinct words that one task counts before it hands them on.
HELD_WORDS = 200_000
#: Edits probed at once.
PROBES = 1 << 20
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def damaged(doc_id: object, run: str) -> str:
    """The run as it is counted: one code point less where 199 divides the key's crc32."""
    return _damaged(zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()), run)


def _damaged(prefix: int, run: str) -> str:
    h = zlib.crc32(run.encode(), prefix)
    if h % DELETE_EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of whole texts with at least that many code points and occurrences."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            words = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(words, ["word", "n"])

        for batch in batches(source, 500):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                prefix = zlib.crc32(f"{doc_id or ''}:".encode())
                for word, n in Counter(RUN.findall((text or "").translate(_LOWER))).items():
                    word = _damaged(prefix, word)
                    if len(word) >= least_length:
                        counts[word] += n
            if len(counts) > HELD_WORDS:
                yield out()
        yield out()

    rows = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= least_count)


def _code_points(words: list[str]) -> np.ndarray:
    """Words of equal length as rows of code points."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    return flat.reshape(len(words), -1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _hash(points: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash modulo 2^64 of each row."""
    return (points * _powers(base, points.shape[1])).sum(axis=1, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def _place(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block and bit mask of a hash in a filter of ``blocks`` blocks."""
    h = _mixed(h)
    block = (h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)
    mask = np.zeros_like(h)
    for i in range(BITS):
        mask |= np.uint64(1) << (h >> np.uint64(6 * i) & np.uint64(63))
    return block.astype(np.int64), mask


def _edits(points: np.ndarray, base: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of words of equal length: the length, the word's row and the hash of every edit, deletions first.

    Deleting either of two equal neighbours gives the same word, so only the last of them is deleted.
    """
    rows, n = points.shape
    powers = _powers(base, n)
    terms = points * powers
    whole = terms.sum(axis=1, dtype=np.uint64)
    before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
    after = (whole[:, None] - before - terms) * np.uint64(pow(base, -1, 1 << 64))
    once = np.ones((rows, n), bool)
    once[:, :-1] = points[:, :-1] != points[:, 1:]
    yield n - 1, np.nonzero(once)[0], (before + after)[once]
    for at in range(n):
        hashes = (whole - terms[:, at])[:, None] + LETTERS * powers[at]
        other = LETTERS != points[:, at : at + 1]
        yield n, np.nonzero(other)[0], hashes[other]


def _sizes(counts: dict[int, int], most: int) -> dict[int, int]:
    """Blocks of the filter of each length, ``most`` at most altogether."""
    wanted = {length: -(-n // WORDS_PER_BLOCK) for length, n in counts.items()}
    scale = min(1.0, (most - len(wanted)) / max(1, sum(wanted.values())))
    return {length: max(1, int(n * scale)) for length, n in wanted.items()}


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    held: dict[int, list[str]] = {}
    for word in batch.column(0).to_pylist():
        held.setdefault(len(word), []).append(word)
    yield from held.items()


def filters(words: DataFrame, most: int = FILTER_BLOCKS) -> dict[int, np.ndarray]:
    """Bloom filter of each length; bits are combined by Spark, ``most`` blocks at most come out."""
    shard = F.least(F.length("word"), F.lit(LONGEST)).alias("shard")
    counts = {r.shard: r.n for r in words.groupBy(shard).agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = _sizes(counts, most)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for length, same in _by_length(batch):
                shard = min(length, LONGEST)
                block, mask = _place(_hash(_code_points(same), _BASES[0]), sizes[shard])
                shards = pa.array(np.full(len(same), shard, np.int32))
                yield pa.RecordBatch.from_arrays([shards, pa.array(block), pa.array(mask.view(np.int64))], ["shard", "block", "bits"])

    bits = words.select("word").mapInArrow(run, "shard int, block long, bits long").groupBy("shard", "block").agg(F.bit_or("bits").alias("bits"))
    found = bits.toArrow()
    shards, block, mask = (found.column(i).to_numpy() for i in range(3))
    out = {}
    for length, size in sizes.items():
        out[length] = np.zeros(size, np.uint64)
        own = shards == length
        out[length][block[own]] = mask[own].view(np.uint64)
    return out


_EDIT = "length int, h1 long, h2 long, o1 long, o2 long, shorter boolean"


def positives(words: DataFrame, bloom: dict[int, np.ndarray]) -> DataFrame:
    """Edits that the filters do not rule out: length and hashes of the edit (h) and of its word (o)."""
    sent = words.sparkSession.sparkContext.broadcast(bloom)

    def probe(same: list[str]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        points = _code_points(same)
        own = [_hash(points, base) for base in _BASES]
        found: list[tuple[np.ndarray, ...]] = []
        for (length, rows, first), (_, _, second) in zip(*(_edits(points, base) for base in _BASES), strict=True):
            bits = known.get(min(length, LONGEST))
            if bits is None:
                continue
            block, mask = _place(first, len(bits))
            at = np.flatnonzero(bits[block] & mask == mask)
            at_rows = rows[at]
            size = np.full(len(at), length, np.int32)
            shorter = np.full(len(at), length < points.shape[1])
            found.append((size, first[at].view(np.int64), second[at].view(np.int64), own[0][at_rows].view(np.int64), own[1][at_rows].view(np.int64), shorter))
            if sum(len(f[0]) for f in found) > PROBES:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], ["length", "h1", "h2", "o1", "o2", "shorter"])
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], ["length", "h1", "h2", "o1", "o2", "shorter"])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for length, same in _by_length(batch):
                step = max(1, PROBES // (length + len(LETTERS)))
                for begin in range(0, len(same), step):
                    yield from probe(same[begin : begin + step])

    return words.select("word").mapInArrow(run, _EDIT)


def hashed(words: DataFrame) -> DataFrame:
    """(word, n, length, h1, h2)"""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            texts = np.array(batch.column(0).to_pylist(), object)
            sizes = np.fromiter(map(len, texts), np.int32, len(texts))
            hashes = np.zeros((2, len(texts)), np.uint64)
            for length in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == length)
                points = _code_points(texts[at].tolist())
                for i, base in enumerate(_BASES):
                    hashes[i, at] = _hash(points, base)
            columns = [*batch.columns[:2], pa.array(sizes), *(pa.array(h.view(np.int64)) for h in hashes)]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n", "length", "h1", "h2"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, length int, h1 long, h2 long")


def neighbours(words: DataFrame, most: int = FILTER_BLOCKS, name: str = "spelling") -> DataFrame:
    """(word, n, near, near_n) for every ordered pair of words that are one edit apart."""
    known = stage(hashed(words), f"{name}-words")
    candidates = positives(known, filters(known, most))
    near = known.select("length", "h1", "h2", F.col("word").alias("near"), F.col("n").alias("near_n"))
    matched = candidates.join(near, ["length", "h1", "h2"]).drop("h1", "h2")
    source = known.select(
        F.col("length").alias("own"), F.col("h1").alias("o1"), F.col("h2").alias("o2"), "word", "n"
    )
    own = (F.col("length") + F.col("shorter").cast("int")).alias("own")
    pairs = matched.select(own, "o1", "o2", "near", "near_n", "shorter").join(source, ["own", "o1", "o2"])
    pairs = pairs.filter(F.levenshtein("word", "near", 1) == 1)
    back = {"word": "near", "n": "near_n", "near": "word", "near_n": "n"}
    ways = F.array(
        F.struct(*back),
        F.when(F.col("shorter"), F.struct(*[F.col(other).alias(own) for own, other in back.items()])),
    )
    return pairs.select(F.inline(F.array_compact(ways)))


def roots(forms: DataFrame, steps: int = STEPS, name: str = "spelling") -> DataFrame:
    """(word, root) of the rows (word, form): where the chain of forms ends. Each step doubles the distance."""
    reached = stage(forms.select("word", F.col("form").alias("root")), f"{name}-reached")
    for _ in range(steps):
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        reached = stage(
            reached.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), f"{name}-reached"
        )
    return reached


def variants(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    most: int = FILTER_BLOCKS,
    name: str = "spelling",
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = stage(vocabulary(docs, least_length, least_count), f"{name}-vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("_best")
    around = neighbours(words, most, name).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    chosen = -F.col("_best.n") >= ratio * F.col("n")
    judged = words.join(around, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(chosen, F.col("_best.near")).alias("form"),
        F.when(chosen, -F.col("_best.n")).alias("form_n"),
    )
    judged = stage(judged, f"{name}-judged")
    ends = roots(judged.filter("form is not null"), name=name)
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
