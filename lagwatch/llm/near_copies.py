"""Near copies by exact Jaccard similarity of word shingles.

Two documents are linked if their sets of SHINGLE-word shingles have a Jaccard similarity of at least
4/5. Links are found by prefix filtering, which loses none: where all sets are sorted by one common order,
two sets so similar share an element among the first |x| - ceil(4|x|/5) + 1 of each, and the first one
they share leaves enough elements behind it on both sides. Any order is right; shingles that are common in a
sample of the documents come last, so that passages which many documents hold make few candidates.

Documents with equal sets are one node. A shingle at the front of at most BUCKET nodes makes pairs. A pair
is first held against the two sketches, counts of a set's shingles by their first byte: the sum of the lesser
counts is never below the overlap, so a pair that fails here is not similar. Pairs that pass are compared on their
whole sets. Only the nodes of such pairs send anything, and they send their texts, which are half as long as the sets. The nodes of a larger bucket are dealt over blocks; each pair of
blocks is compared at once, and of the links found only those of a spanning forest are kept, which has the
same components. No bucket is cut or skipped.

Documents whose SimHash fingerprints differ in at most two bits are linked as well (:mod:`simhash`: three-word
shingles with repeats, the ring of segments); :func:`near_copies` alone leaves that to its caller, :func:`keep_one`
does both, and a component is what the links of both reach.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagwatch.llm import memory, simhash
from lagwatch.llm.common import batches, bytes_of, connected_components, hot_keys, salted_join, stage

SHINGLE = 5
BUCKET = 32
#: Nodes and shingles of a block, on average; two blocks meet in a task.
BLOCK = 1_024
BLOCK_SHINGLES = 1_000_000
#: One document in SAMPLE is looked at for common shingles; those in at least SEEN of them are, MOST_COMMON at most.
SAMPLE = 4
SEEN = 5
MOST_COMMON = 100_000
#: Ids of documents that a broadcast may hold; more are joined by a shuffle of the texts.
BROADCAST_IDS = 1_000_000
_COLUMNS = 4_096
_SLOTS = 256
_FULL = 65_535


def shingle_set(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct shingle hashes of one UTF-8 text, ascending; of a shorter text the hash of all its words."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(line, 42)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(lengths + 1) - 1
    starts = (stops - lengths)[: len(words) - shingle + 1]
    cut = map(line.__getitem__, map(slice, starts.tolist(), stops[shingle - 1 :].tolist()))
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in cut), np.uint64, len(starts)))


def set_id(shingles: np.ndarray) -> int:
    """Hash of a whole set, as a signed long; zero for the empty set."""
    value = xxhash.xxh3_64_intdigest(shingles.tobytes()) if len(shingles) else 0
    return value - (1 << 64) if value >> 63 else value


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Number of shingles by first byte; a slot that is full may hold more."""
    counts = np.bincount((shingles >> np.uint64(56)).astype(np.int64), minlength=_SLOTS)
    return np.minimum(counts, _FULL).astype(np.uint16)


def may_be_similar(a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For rows of sketches: whether the overlap may be large enough for the sum of both sizes."""
    most = np.minimum(a, b).sum(axis=1, dtype=np.int64)
    return similar(most, sizes) | (a == _FULL).any(axis=1) | (b == _FULL).any(axis=1)


def similar(overlap: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Jaccard similarity of at least 4/5, from the size of the intersection and the sum of both sizes."""
    return 9 * overlap >= 4 * sizes


def prefix(shingles: np.ndarray, common: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The first |x| - ceil(4|x|/5) + 1 shingles, rare ones first; ``common`` ascends and has ``ranks`` from 1."""
    size = len(shingles)
    if not size:
        return shingles
    order = np.zeros(size, np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
        order = np.where(common[at] == shingles, ranks[at], 0)
    return shingles[np.argsort(order, kind="stable")[: size - (4 * size + 4) // 5 + 1]]


def _common(docs: DataFrame, shingle: int, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Common shingles of a sample and their ranks by count. Only the order of elements depends on them."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, 200):
            sets = [shingle_set(t, shingle) for t in bytes_of(batch.column(0))]
            found = np.concatenate([np.empty(0, np.uint64), *sets])
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["h"])

    text = F.col("text").cast("string")
    sample = docs.select(text.alias("text")).filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0)
    counts = sample.mapInArrow(run, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= SEEN)
    rows = counts.orderBy(F.desc("n"), "h").limit(MOST_COMMON).collect()
    hashes = np.array([r.h for r in rows], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], (len(rows) - np.arange(len(rows), dtype=np.int64))[order]


def _prints(docs: DataFrame, shingle: int, name: str) -> DataFrame:
    """(doc_id, text_id, fp, size, front, sketch): the set's id, size, prefix and sketch."""
    common, ranks = _common(docs, shingle, name)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory.begin("near copies")
        for batch in batches(source, 500):
            sets = [shingle_set(t, shingle) for t in bytes_of(batch.column(2))]
            fronts = [prefix(s, common, ranks).view(np.int64) for s in sets]
            offsets = np.cumsum([0, *map(len, fronts)])
            front = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *fronts]))
            )
            ids, sizes = pa.array([set_id(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int32())
            sketches = pa.array([sketch(s).tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), ids, sizes, front, sketches],
                ["doc_id", "text_id", "fp", "size", "front", "sketch"],
            )

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_id"), text.alias("text"))
    return stage(rows.mapInArrow(run, "doc_id long, text_id long, fp long, size int, front array<long>, sketch binary"), f"{name}-prints")


def _runs(source: Iterator[pa.RecordBatch], bucket: int) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token: pairs (null, a, b) of small buckets, members (token, a, size) of large ones."""

    def found(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        token, fp, size, place = rows
        starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        lengths = np.diff(np.concatenate([starts, [len(token)]]))
        pairs = [np.empty((2, 0), np.int64)]
        for n in np.unique(lengths[(lengths > 1) & (lengths <= bucket)]):
            at = starts[lengths == n][:, None] + np.arange(n)
            left, right = np.triu_indices(n, 1)
            for begin in range(0, len(at), max(1, 200_000 // len(left))):
                part = at[begin : begin + max(1, 200_000 // len(left))]
                i, j = part[:, left].ravel(), part[:, right].ravel()
                rest = np.minimum(size[i] - place[i], size[j] - place[j])
                near = similar(rest, size[i] + size[j]) & (5 * np.minimum(size[i], size[j]) >= 4 * np.maximum(size[i], size[j]))
                i, j = i[near & (fp[i] != fp[j])], j[near & (fp[i] != fp[j])]
                pairs.append(np.unique(np.sort(np.stack([fp[i], fp[j]]), axis=0), axis=1))
        a, b = np.concatenate(pairs, axis=1)
        large = np.repeat(lengths > bucket, lengths)
        none = np.zeros(len(a), np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([none, token[large]]), mask=np.repeat([True, False], [len(a), large.sum()])),
                pa.array(np.concatenate([a, fp[large]])),
                pa.array(np.concatenate([b, size[large]])),
            ],
            ["token", "a", "b"],
        )

    held = np.empty((4, 0), np.int64)
    for batch in source:
        rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
        rows = np.concatenate([held, rows], axis=1)
        if not rows.shape[1]:
            continue
        last = int(np.searchsorted(rows[0], rows[0, -1]))  # tokens ascend; the last run may go on
        held = rows[:, last:]
        if last:
            yield from found(rows[:, :last])
    if held.shape[1]:
        yield from found(held)


def _bound_pairs(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(source):
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, _SLOTS) for c in (2, 3))
        near = may_be_similar(a, b, batch.column(4).to_numpy().astype(np.int64))
        yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(near, pa.bool_()))


def _check_pairs(source: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    memory.begin("near copies")
    for batch in batches(source, 500):
        a, b = ([shingle_set(t, shingle) for t in bytes_of(batch.column(c))] for c in (2, 3))
        overlap = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(a, b, strict=True)], np.int64)
        sizes = np.array([len(x) + len(y) for x, y in zip(a, b, strict=True)], np.int64)
        checked = pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"])
        yield checked.filter(pa.array(similar(overlap, sizes), pa.bool_()))


def _forest(block: pd.DataFrame, shingle: int) -> pd.DataFrame:
    """Links of a spanning forest over all similar pairs of a block."""
    ids = block["a"].to_numpy()
    sets = [shingle_set((t or "").encode(), shingle) for t in block["text"]]
    sizes = np.array([len(s) for s in sets], np.int64)
    values, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    shared = counts[at] > 1
    column = (np.cumsum(counts > 1) - 1)[at[shared]]
    row, width = row[shared], int((counts > 1).sum())
    overlap = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, width, _COLUMNS):
        inside = (column >= low) & (column < low + _COLUMNS)
        part = np.zeros((len(sets), min(_COLUMNS, width - low)), np.float32)
        part[row[inside], column[inside] - low] = 1
        overlap += part @ part.T
    near = np.triu(similar(overlap.astype(np.int64), sizes[:, None] + sizes[None, :]), 1)
    parent = list(range(len(sets)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    kept = []
    for i, j in zip(*map(np.ndarray.tolist, np.nonzero(near)), strict=True):
        x, y = find(i), find(j)
        if x != y:
            parent[y] = x
            kept.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
    return pd.DataFrame(kept, columns=["a", "b"], dtype="int64")


def _texts(docs: DataFrame, needed: DataFrame, name: str) -> DataFrame:
    """(fp, text): one text of each node that candidates name."""
    ids = F.broadcast(needed) if needed.count() <= BROADCAST_IDS else needed
    text = F.col("text").cast("string")
    rows = docs.select(F.xxhash64(text).alias("text_id"), text.alias("text")).join(ids, "text_id").select("fp", "text")
    return stage(rows.dropDuplicates(["fp"]), f"{name}-texts")


def links(docs: DataFrame, prints: DataFrame, shingle: int, bucket: int, block: int, name: str) -> DataFrame:
    """Edges (a, b), a < b, over set ids, with the components of all pairs of similarity 4/5 or more."""
    front = prints.dropDuplicates(["fp"]) if prints.select("fp").distinct().count() < prints.count() else prints
    rows = front.select("fp", "size", F.posexplode("front").alias("place", "token")).select("token", "fp", "size", "place")
    met = rows.repartition("token").sortWithinPartitions("token").mapInArrow(
        lambda source: _runs(source, bucket), "token long, a long, b long"
    )
    met = stage(met, f"{name}-met")
    pairs = stage(met.filter("token is null").select("a", "b").distinct(), f"{name}-pairs")
    left, right = (
        front.select(F.col("fp").alias(n), F.col("sketch").alias(f"s{n}"), F.col("size").alias(f"n{n}")) for n in ("a", "b")
    )
    bounded = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb", (F.col("na") + F.col("nb")).alias("sizes"))
    pairs = stage(bounded.mapInArrow(_bound_pairs, "a long, b long"), f"{name}-close")
    members = met.filter("token is not null").select("token", "a", F.col("b").alias("size"))
    used = pairs.select(F.col("a").alias("fp")).union(pairs.select("b")).union(members.select("a")).distinct()
    needed = prints.groupBy("fp").agg(F.min("text_id").alias("text_id")).join(used, "fp")
    texts = _texts(docs, stage(needed, f"{name}-needed"), name)

    left = texts.select(F.col("fp").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("fp").alias("b"), F.col("text").alias("right"))
    compared = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    small = stage(compared.mapInArrow(lambda source: _check_pairs(source, shingle), "a long, b long"), f"{name}-small")

    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / block, F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    dealt = members.join(members.groupBy("token").agg(blocks), "token").withColumn("own", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.withColumn("other", other).select(
        "token", "a", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    )
    large = dealt.join(texts.withColumnRenamed("fp", "a"), "a").groupBy("token", "low", "high").applyInPandas(
        lambda members: _forest(members, shingle), "a long, b long"
    )
    return small.unionByName(stage(large.distinct(), f"{name}-large")).distinct()


def simhash_links(docs: DataFrame, prints: DataFrame, name: str) -> DataFrame:
    """Edges (a, b), a < b, over set ids of documents whose SimHash fingerprints differ in at most two bits.

    Documents with one fingerprint are linked to the least of their sets, the least sets of near fingerprints to each other.
    """
    text = F.col("text").cast("string")
    sets = prints.groupBy("text_id").agg(F.min("fp").alias("fp"))
    texts = docs.select(F.xxhash64(text).alias("doc_id"), text.alias("text"))
    marked = simhash.fingerprints(texts).select(F.col("doc_id").alias("text_id"), F.col("fp").alias("print")).distinct()
    marked = stage(marked.join(sets, "text_id").select("print", "fp").distinct(), f"{name}-marked")
    nodes = stage(marked.groupBy("print").agg(F.min("fp").alias("least"), F.count(F.lit(1)).alias("n")), f"{name}-marks")
    equal = marked.join(nodes.filter("n > 1"), "print").select(F.col("least").alias("a"), F.col("fp").alias("b"))
    near = simhash.links(nodes.select(F.col("print").alias("fp")), name=name)
    ends = [nodes.select(F.col("print").alias(n), F.col("least").alias(f"_{n}")) for n in ("a", "b")]
    near = near.join(ends[0], "a").join(ends[1], "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    edges = equal.unionByName(near).filter("a != b")
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_copies(
    docs: DataFrame, shingle: int = SHINGLE, bucket: int = BUCKET, block: int = BLOCK, name: str = "near-copies",
    fingerprints: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component_id (smallest doc_id that links reach).

    Null ids are treated as in :func:`simhash.near_duplicates`. With ``fingerprints`` SimHash links count as well.
    """
    prints = _prints(docs, shingle, name)
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), f"{name}-nodes")
    edges = links(docs, prints, shingle, bucket, block, name)
    if fingerprints:
        edges = edges.unionByName(simhash_links(docs, prints, f"{name}-simhash")).distinct()
    parts = connected_components(edges, f"{name}-components")
    parts = nodes.join(parts.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "n", "least", F.coalesce("component", "fp").alias("component")
    )
    parts = stage(parts, f"{name}-parts")
    least = parts.groupBy("component").agg(F.min("least").alias("component_id"))
    named = stage(parts.join(least, "component").select("fp", "n", "component_id"), f"{name}-named")
    hot = stage(hot_keys(named, ["fp"]), f"{name}-hot")
    return salted_join(prints.select("doc_id", "fp"), named.drop("n"), ["fp"], "inner", hot).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, name: str = "near-copies") -> DataFrame:
    """The rows of ``docs`` that stay: of each component of both kinds of links the one with the smallest doc_id."""
    return simhash.keep_one(docs, name, partial(near_copies, fingerprints=True))
