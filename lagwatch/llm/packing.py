"""Bound-certified best-fit packing of documents into sequences.

1. ``tokenize_pieces`` turns texts into pieces of at most ``capacity`` tokens.
2. ``pack`` deals the pieces over partitions by a salted hash. Each partition packs its own by
   best-fit decreasing and works out a lower bound from dual-feasible functions. If the number of
   bins equals the bound, the partition is certified: no other packing of it needs fewer bins.
3. A partition with a gap gives up the documents of its emptiest bins, a certified one only those of
   its single emptiest bin. These documents meet those of other partitions, in an eighth as many
   partitions, and best-fit decreasing runs again, until one round fits in one partition.

What a partition gives up is bounded (``most_released`` bins), so each round is smaller than the one
before by a fixed factor and the last task never holds more than a few hundred bins.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagwatch.llm.common import batches, bytes_of, stage
from lagwatch.llm.word_bpe import word_bpe

CAPACITY = 4096
END_ID = 1
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Pieces that one task packs; partitions follow the number of pieces.
PER_TASK = 20_000
#: Partitions of one round that meet in one partition of the next.
FAN_IN = 8


def tokenize_pieces(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """One row per piece of each document (doc_id, text; other columns are ignored).

    A null text is empty and gives one piece that holds ``end_id`` alone. Only documents of more than
    ``capacity`` tokens are cut. ``with_ids`` adds the ids as unsigned little-endian 32-bit numbers.
    A null doc_id stays null; repeated rows give repeated pieces.
    """
    tail = np.array([end_id], "<u4").tobytes()
    names = [c.split()[0] for c in PIECE_SCHEMA.split(", ")] + ["ids"] * with_ids

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_bpe(vocabulary)
        for batch in batches(source, 500):
            out: list[tuple] = []
            encoded = encoder.encode(bytes_of(batch.column(1)))
            for doc, ids in zip(batch.column(0).to_pylist(), encoded, strict=True):
                data = ids + tail
                for n, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    row = (doc, n, at // 4, len(part) // 4, zlib.crc32(part))
                    out.append((*row, part) if with_ids else row)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=False)], names
            )

    schema = PIECE_SCHEMA + (", ids binary" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin number and offset of each item, in time linear in items.

    Bins are stacked by the room they have left; a bit mask of the rooms in use finds the least
    sufficient one. Equal lengths keep their order, so the result is the same on every run.
    """
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    stacks: dict[int, list[int]] = {}
    used = 0
    n_bins = 0
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        rest = used >> size
        if rest:
            room = size + (rest & -rest).bit_length() - 1
            stack = stacks[room]
            at = stack.pop()
            if not stack:
                used &= ~(1 << room)
        else:
            room, at = capacity, n_bins
            n_bins += 1
        bins[item], offsets[item] = at, capacity - room
        room -= size
        if room:
            stacks.setdefault(room, []).append(at)
            used |= 1 << room
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Least number of bins that any packing needs, by two families of dual-feasible functions.

    Threshold family, for each t up to half the capacity: sizes over capacity - t count as the whole
    bin, sizes below t as nothing. Rounding family, for k up to 12: a size counts as the number of
    k+1-th parts of the bin that it exceeds, each worth a k-th. t = 0 is the plain sum.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    n_upto = np.concatenate([[0], np.cumsum(count)])
    sum_upto = np.concatenate([[0], np.cumsum(count * np.arange(capacity + 1))])
    t = np.arange(capacity // 2 + 1)
    middle = sum_upto[capacity - t + 1] - sum_upto[t]
    whole = n_upto[-1] - n_upto[capacity - t + 1]
    best = int((-(-(middle + whole * capacity) // capacity)).max())
    sizes = np.arange(capacity + 1)
    for k in range(1, 13):
        scaled = sizes * (k + 1)
        # in units of 1 / (k * capacity)
        value = np.where(scaled % capacity == 0, sizes * k, scaled // capacity * capacity)
        best = max(best, int(-(-int((count * value).sum()) // (k * capacity))))
    return best


def _pack_partition(lengths: np.ndarray, capacity: int, last: bool, most_released: int):
    """Bins, offsets, and which bins stay; a partition without a gap gives up one bin."""
    bins, offsets = best_fit(lengths, capacity)
    n_bins = int(bins.max()) + 1
    gap = n_bins - lower_bound(lengths, capacity)
    stays = np.ones(n_bins, bool)
    if not last:
        fill = np.bincount(bins, weights=lengths, minlength=n_bins)
        give = min(n_bins, most_released, 1 + 4 * gap)
        emptiest = np.argsort(fill, kind="stable")[:give]
        stays[emptiest[fill[emptiest] < capacity]] = False
    return bins, offsets, stays, gap


def _packer(columns: list[str], length: str, capacity: int, last: bool, turn: int, most_released: int):
    """The function that packs one partition, given as an Arrow table."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.select(columns)
        order = [f.name for f in table.schema if pa.types.is_integer(f.type) or pa.types.is_string(f.type)]
        table = table.sort_by([(c, "ascending") for c in order])
        lengths = table[length].to_numpy().astype(np.int64)
        bins, offsets, stays, gap = _pack_partition(lengths, capacity, last, most_released)
        first = (turn << 56) + (key[0].as_py() << 28)
        for name, values in (
            ("sequence_id", bins + first),
            ("offset", offsets),
            ("certified", np.full(len(bins), gap == 0)),
            ("_stays", stays[bins]),
        ):
            table = table.append_column(name, pa.array(values))
        return table

    return run


def pack(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    per_task: int = PER_TASK,
    most_released: int = 64,
    name: str = "packing",
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` (and ``certified``) to rows with a ``length``.

    ``certified`` tells whether the packing that placed the row met its partition's lower bound.
    Lengths must be from 1 to ``capacity``. All other columns are carried along; columns that are
    already called like the new ones are replaced. An empty input gives an empty result.
    """
    pieces = pieces.drop("sequence_id", "offset", "certified")
    names, columns = pieces.columns, [f"c{i}" for i in range(len(pieces.columns))]  # the caller's may clash
    length = columns[names.index("length")]
    waiting = stage(pieces.toDF(*columns), name)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in waiting.schema)
    schema += ", sequence_id long, offset long, certified boolean, _stays boolean"
    wrong = waiting.filter(f"{length} is null or {length} < 1 or {length} > {capacity}").limit(1).count()
    if wrong:
        raise ValueError(f"lengths must be from 1 to {capacity}")
    parts = max(1, -(-waiting.count() // per_task))
    done: list[DataFrame] = []
    turn = 0
    while True:
        last = parts == 1

        salt = F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(turn)), F.lit(parts)).cast("int")
        packed = waiting.withColumn("_part", salt).groupBy("_part").applyInArrow(
            _packer(columns, length, capacity, last, turn, most_released), schema
        )
        packed = stage(packed, f"{name}-{turn}")
        done.append(packed.filter("_stays").drop("_stays"))
        if last:
            break
        waiting = packed.filter("not _stays").select(*columns)
        parts, turn = -(-parts // FAN_IN), turn + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.toDF(*names, "sequence_id", "offset", "certified")


def assemble(packed: DataFrame) -> DataFrame:
    """Sequences as unsigned 32-bit ids end to end, from pieces packed with their ``ids``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts")
    joined = F.aggregate("parts", F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    return packed.groupBy("sequence_id").agg(parts).select("sequence_id", joined.alias("ids"))


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise and pack: the columns of PIECE_SCHEMA, sequence_id, offset, certified."""
    return pack(tokenize_pieces(docs, vocabulary, capacity), capacity)
