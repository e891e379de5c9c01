"""SimHash near-duplicates with pigeonring filtering.

Fingerprints of 64 bits are cut into SEGMENTS segments laid in a ring. If two fingerprints differ in at
most ``most`` bits, some segment starts a chain whose first l segments together differ in at most
l * most / SEGMENTS bits, for every l up to the whole ring. The budgets that round down to zero
make the join key: with two bits and seven segments, three segments in a row (27 or 28 bits) must be
equal. Candidates of that join must keep the budgets of all longer chains before the full
Hamming check.

Fingerprints with equal value are one node, so copies cost nothing. A bucket of more than BUCKET
distinct fingerprints makes no pairs: two fingerprints differ in at most two bits exactly if some value
is within one bit of both, so each of its fingerprints goes to itself and its 64 one-bit
neighbours, and those that meet are linked to the least of them. That is linear in the bucket and
loses no link.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagwatch.llm.common import batches, bytes_of, connected_components, hot_keys, salted_join, stage

SHINGLE = 3
MOST = 2
SEGMENTS = 7
BUCKET = 64
BITS = 64
_BIT_OF_BYTE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_PLACE = np.arange(8) * 256


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of one UTF-8 text: a bit is set if it is set in over half of the shingle hashes."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, 42)]
    else:
        stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = (stops - np.fromiter(map(len, words), np.int64, len(words)))[: len(words) - shingle + 1]
        cut = map(line.__getitem__, map(slice, starts.tolist(), stops[shingle - 1 :].tolist()))
        hashes = list(map(partial(xxhash.xxh64_intdigest, seed=42), cut))
    column = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8) + _PLACE
    counts = np.bincount(column.ravel(), minlength=2048).reshape(8, 256) @ _BIT_OF_BYTE
    bits = (2 * counts.ravel() > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``. A null or empty text has fingerprint zero."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, 1_000):
            values = np.array([fingerprint(t, shingle) for t in bytes_of(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def segment_bounds(segments: int = SEGMENTS) -> list[tuple[int, int]]:
    cuts = [BITS * i // segments for i in range(segments + 1)]
    return list(zip(cuts, cuts[1:], strict=False))


def _mask(first: int, length: int, segments: int) -> int:
    """Bits of ``length`` segments in the ring from ``first``, as a signed long."""
    bounds = segment_bounds(segments)
    value = 0
    for i in range(first, first + length):
        low, high = bounds[i % segments]
        value |= ((1 << high) - 1) & ~((1 << low) - 1)
    return value - (1 << 64) if value >> 63 else value


def _within_ring(difference: Column, first: int, most: int, segments: int) -> Column:
    """All chains from ``first`` keep their proportional budgets."""
    ok = F.lit(True)
    for length in range(1, segments + 1):
        part = F.bit_count(difference.bitwiseAND(F.lit(_mask(first, length, segments))))
        ok = ok & (part <= length * most // segments)
    return ok


def links(nodes: DataFrame, most: int = MOST, segments: int = SEGMENTS, bucket: int = BUCKET, name: str = "simhash") -> DataFrame:
    """Edges (a, b), a < b or a = b, over distinct fingerprints ``fp``; their components are those
    of the graph of all pairs that differ in at most ``most`` bits."""
    if most > 2:
        raise ValueError("large buckets are resolved for at most two differing bits")
    exact = max(length for length in range(1, segments + 1) if length * most // segments == 0)
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(_mask(i, exact, segments))) for i in range(segments)])
    rows = stage(nodes.select("fp", F.posexplode(keys).alias("ring", "key")), f"{name}-keys")
    sizes = rows.groupBy("ring", "key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    met = stage(rows.join(sizes, ["ring", "key"]), f"{name}-met")
    small = met.filter(F.col("size") <= bucket).drop("size")
    other = small.withColumnRenamed("fp", "b")
    pairs = small.withColumnRenamed("fp", "a").join(other, ["ring", "key"]).filter("a < b")
    difference = F.col("a").bitwiseXOR(F.col("b"))
    chain = F.lit(False)
    for first in range(segments):
        chain = chain | ((F.col("ring") == first) & _within_ring(difference, first, most, segments))
    pairs = pairs.filter(chain).filter(F.bit_count(difference) <= most).select("a", "b")

    large = met.filter(F.col("size") > bucket).select("fp").distinct()
    near = F.array(F.col("fp"), *[
        F.col("fp").bitwiseXOR(F.lit((1 << i) - (1 << 64) if i == 63 else 1 << i)) for i in range(BITS)
    ])
    around = large.select("fp", F.explode(near).alias("middle"))
    least = around.groupBy("middle").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    stars = around.join(least, "middle").select("a", F.col("fp").alias("b")).filter("a < b").distinct()
    return pairs.distinct().unionByName(stars)


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, most: int = MOST, segments: int = SEGMENTS, bucket: int = BUCKET, name: str = "simhash"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component_id (smallest doc_id that links reach).

    A null doc_id is reported as null and counts as larger than all others; a component of such
    rows alone has a null component_id. Repeated rows share a fingerprint and so a component.
    """
    prints = stage(fingerprints(docs, shingle), f"{name}-prints")
    nodes = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), f"{name}-nodes")
    parts = connected_components(links(nodes, most, segments, bucket, name), f"{name}-components")
    parts = nodes.join(parts.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "n", "least", F.coalesce("component", "fp").alias("component")
    )
    parts = stage(parts, f"{name}-parts")
    least = parts.groupBy("component").agg(F.min("least").alias("component_id"))
    named = stage(parts.join(least, "component").select("fp", "n", "component_id"), f"{name}-named")
    hot = stage(hot_keys(named, ["fp"]), f"{name}-hot")
    return salted_join(prints, named.drop("n"), ["fp"], "inner", hot).select("doc_id", "fp", "component_id")


def hex_digits(fp: Column | str) -> Column:
    """16 lowercase hexadecimal digits of a long."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, name: str = "simhash", judge: Callable[..., DataFrame] = near_duplicates) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest doc_id.

    Rows without doc_id stay only where no other row of the component has one. Rows that share
    the doc_id of a kept row are reduced to one.
    """
    judged = judge(docs, name=name)
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    ids = judged.groupBy(F.col("doc_id").alias("id")).agg(F.max(stays).alias("stays"), F.count(F.lit(1)).alias("n"))
    ids = stage(ids.filter("not stays or n > 1"), f"{name}-ids")  # the others need no join partner
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    marked = rows.join(ids, F.col("row.doc_id").cast("long").eqNullSafe(F.col("id")), "left")
    once = marked.filter("n is null").select("row.*")
    if ids.filter("stays and n > 1").isEmpty():
        return once
    return once.unionByName(marked.filter("stays and n > 1").dropDuplicates(["id"]).select("row.*"))
