"""Substring deduplication by seed and extend on winnowed anchors.

The anchor of a window of ``length`` words is the least hash among its runs of SEED words. Windows
with equal words have equal anchors, so only windows whose anchor (the seed) is shared by two
documents can repeat. Neighbouring windows mostly share their anchor; such a stretch is one row
``(anchor, span hash, document, start, windows)``, about one for twenty words.

Seeds are joined and extended without pairs of documents:

1. A stretch whose whole span (all words that its windows touch) also lies in a document with a smaller
   id repeats as a whole: the match extends both ways over the span.
2. Where one anchor stands in different spans, the first document of each span extends window by window:
   windows meet on (anchor, window hash) and those whose first document is smaller repeat. Equal windows of
   one document that overlap or touch (a word or phrase said over and over) are one row from the first word
   to the last: they repeat together or not at all, and cover just these words.

Repeating windows of a document are merged into maximal repeats. A window hash and its anchor are
independent 64-bit values, so equality stands for equal words up to 2^-128.

Nulls: a null text has no words; a null doc_id sorts after all others. Rows with equal doc_id never
make each other's words repeats. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lagwatch.llm.common import batches, bytes_of, hot_keys, salted_join, stage
from lagwatch.llm.words import Rolling, grams, hash_texts, sliding_min

LENGTH = 50
SEED = 10
LAST = 2**63 - 1
KEY = ["doc", "mark"]


def _doc() -> list[Column]:
    """Key of a document: its id, and a mark of its text in case an id comes twice."""
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("mark"),
    ]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(*_doc(), F.col("text").cast("string").alias("text"))


class _Windows:
    """Anchors and hashes of all windows of a batch of texts."""

    def __init__(self, texts: list[bytes], length: int, seed: int):
        hashes, counts = hash_texts(texts)
        self.first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self.counts, self.length = counts, length
        self.anchors = sliding_min(grams(hashes, seed), length - seed + 1)
        self.rolling = Rolling(hashes)
        self.n = np.maximum(counts - length + 1, 0)  # windows of each text


def _emit(columns: dict[str, np.ndarray], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    arrays = [pa.array(columns[k].view(np.int64) if columns[k].dtype == np.uint64 else columns[k], t) for k, t in kinds.items()]
    return pa.RecordBatch.from_arrays(arrays, list(kinds))


def _stretches(length: int, seed: int):
    kinds = {"anchor": pa.int64(), "span": pa.int64(), "doc": pa.int64(), "mark": pa.int64(), "start": pa.int32(), "windows": pa.int32()}

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, 250):
            w = _Windows(bytes_of(batch.column(2)), length, seed)
            text = np.repeat(np.arange(len(w.n)), w.n)
            if not len(text):
                continue
            within = np.arange(len(text)) - np.repeat(np.cumsum(w.n) - w.n, w.n)
            at = w.first[text] + within
            anchor = w.anchors[at]
            new = np.ones(len(text), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
            head = np.flatnonzero(new)
            n = np.diff(np.append(head, len(text)))
            start = at[head]
            span = w.rolling(start, start + n - 1 + length) ^ (n.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            doc, mark = (batch.column(i).to_numpy(zero_copy_only=False)[text[head]] for i in (0, 1))
            yield _emit({"anchor": anchor[head], "span": span, "doc": doc, "mark": mark, "start": within[head], "windows": n}, kinds)

    return run, "anchor long, span long, doc long, mark long, start int, windows int"


def _windows(length: int, seed: int):
    kinds = {"anchor": pa.int64(), "hash": pa.int64(), "doc": pa.int64(), "mark": pa.int64(), "start": pa.int32(), "stop": pa.int32()}

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, 250):
            w = _Windows(bytes_of(batch.column(2)), length, seed)
            lists = batch.column(3)
            text = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            pairs = lists.flatten()
            begin, n = (pairs.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            row = np.repeat(np.arange(len(n)), n)
            start = begin[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            text = text[row]
            at = w.first[text] + start
            anchor, same = w.anchors[at], w.rolling(at, at + length)
            if not len(at):
                continue
            # starts ascend within a text, and the sort is stable
            order = np.argsort(same + text.astype(np.uint64) * np.uint64(Rolling.BASE), kind="stable")
            anchor, same, text, start = anchor[order], same[order], text[order], start[order]
            new = np.ones(len(at), bool)
            new[1:] = (same[1:] != same[:-1]) | (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
            new[1:] |= np.diff(start) > length
            head = np.flatnonzero(new)
            stop = start[np.append(head[1:], len(at)) - 1] + length
            doc, mark = (batch.column(i).to_numpy(zero_copy_only=False)[text[head]] for i in (0, 1))
            yield _emit(
                {"anchor": anchor[head], "hash": same[head], "doc": doc, "mark": mark, "start": start[head], "stop": stop},
                kinds,
            )

    return run, "anchor long, hash long, doc long, mark long, start int, stop int"


def _first_holder(rows: DataFrame, keys: list[str], name: str, *extra: Column) -> DataFrame:
    """Rows of keys that more than one document holds, with ``holder``, the smallest document."""
    stats = rows.groupBy(*keys).agg(
        F.min("doc").alias("holder"), F.max("doc").alias("_most"), F.count(F.lit(1)).alias("n"), *extra
    )
    shared = stage(stats.filter("holder < _most").drop("_most"), f"{name}-shared")
    hot = stage(hot_keys(shared, keys), f"{name}-hot")
    return salted_join(rows, shared.drop("n"), keys, "inner", hot)


def repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED, name: str = "substrings") -> DataFrame:
    """Maximal repeats ``(doc, mark, ranges)`` of the documents that have any.

    ``ranges`` lists (start, stop) in words, sorted and disjoint.
    """
    keyed = _keyed(docs)
    run, schema = _stretches(length, seed)
    stretches = stage(keyed.mapInArrow(run, schema), f"{name}-stretches")
    seeds = _first_holder(
        stretches, ["anchor"], f"{name}-seeds", F.min("span").alias("_a"), F.max("span").alias("_b")
    )
    seeds = stage(seeds.withColumn("alike", F.col("_a") == F.col("_b")).drop("_a", "_b"), f"{name}-seeds")
    stop = F.col("start") + F.col("windows") - 1 + length
    sure = seeds.filter("alike and doc > holder").select(*KEY, "start", stop.alias("stop"))
    unlike = seeds.filter("not alike").drop("holder", "alike")
    spans = unlike.groupBy("anchor", "span").agg(F.min("doc").alias("holder"), F.count(F.lit(1)).alias("n"))
    spans = stage(spans, f"{name}-spans")
    hot = stage(hot_keys(spans, ["anchor", "span"]), f"{name}-spans-hot")
    judged = stage(salted_join(unlike, spans.drop("n"), ["anchor", "span"], "inner", hot), f"{name}-judged")
    whole = judged.filter("doc > holder").select(*KEY, "start", stop.alias("stop"))

    asked = F.sort_array(F.collect_set(F.struct("start", "windows"))).alias("asked")
    asked = judged.filter("doc = holder").groupBy(*KEY).agg(asked)
    run, schema = _windows(length, seed)
    windows = keyed.join(asked, KEY).select(*KEY, "text", "asked").mapInArrow(run, schema)
    windows = stage(windows, f"{name}-windows")
    same = _first_holder(windows, ["anchor", "hash"], f"{name}-same")
    single = same.filter("doc > holder").select(*KEY, "start", "stop")
    ranges = (
        sure.unionByName(whole)
        .unionByName(single)
        .groupBy(*KEY)
        .agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("ranges"))
    )
    return stage(ranges, f"{name}-ranges")


def _cut(words: list[bytes], ranges: list[dict]) -> list[bytes]:
    """Words outside the ranges, which are sorted by start and may overlap."""
    kept, at = [], 0
    for r in ranges:
        if r["start"] > at:
            kept += words[at : r["start"]]
        at = max(at, r["stop"])
    return kept + words[at:]


def _with_ranges(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """Columns ``text`` and ``ranges`` (null: nothing repeats), then all columns of ``docs`` as c0, c1, ...

    The whole texts are shuffled once, here; the renaming keeps clashing names apart.
    """
    doc, mark = _doc()
    given = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    return docs.select(doc, mark, F.col("text").cast("string").alias("text"), *given).join(ranges, KEY, "left").select(
        "text", "ranges", *(f"c{i}" for i in range(len(given)))
    )


def digests(docs: DataFrame, length: int = LENGTH, seed: int = SEED, name: str = "substrings") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256."""
    ranges = repeats(docs, length, seed, name)

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, 500):
            split = [t.split() for t in bytes_of(batch.column(0))]
            kept = [_cut(w, r) if r else w for w, r in zip(split, batch.column(1).to_pylist(), strict=True)]
            n, left = (np.array([len(w) for w in side], np.int64) for side in (split, kept))
            sha = [hashlib.sha256(b" ".join(w)).hexdigest() for w in kept]
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), pa.array(n), pa.array(n - left), pa.array(sha, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return _with_ranges(docs.select(F.col("doc_id").cast("long"), "text"), ranges).drop("c1").mapInArrow(count, schema)


def rewrite(docs: DataFrame, length: int = LENGTH, seed: int = SEED, name: str = "substrings") -> DataFrame:
    """``docs`` with repeats cut from ``text``; texts that lose nothing stay as they are.

    All columns are kept; ``n_chars``, where there is one, follows the text.
    """
    ranges = repeats(docs, length, seed, name)
    others = [c for c in docs.columns if c != "text"]
    joined = _with_ranges(docs.select("text", *(f"`{c}`" for c in others)), ranges).drop("c0")

    def cut(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, 500):
            texts = [
                b" ".join(_cut(t.split(), r)).decode() if r else None
                for t, r in zip(bytes_of(batch.column(0)), batch.column(1).to_pylist(), strict=True)
            ]
            columns = [pa.array(texts, pa.string()), *batch.columns]
            del columns[2]  # the ranges
            yield pa.RecordBatch.from_arrays(columns, ["kept", *(n for n in batch.schema.names if n != "ranges")])

    schema = StructType([StructField("kept", StringType()), *(f for f in joined.schema if f.name != "ranges")])
    out = {c: F.col(f"c{i}") for i, c in enumerate(others, 1)}
    out["text"] = F.coalesce("kept", "text")
    if "n_chars" in out:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(F.col("kept").isNull(), out["n_chars"]).otherwise(F.length("kept").cast(kind))
    return joined.mapInArrow(cut, schema).select(*(out[c].alias(c) for c in docs.columns))
