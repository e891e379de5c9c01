"""SentencePiece encoding with offsets, and decoding.

Normalisation takes, at each place, the longest prefix that the model's compiled character map
(a double-array trie followed by replacement texts) knows, else one character; every byte of the
normalised text keeps the byte of the source it came from. Merging then works on stretches ``▁*[^▁]*``,
which no piece crosses; stretches are remembered, new ones are merged many at once. Pieces are projected
to byte spans of the source.

The model must be a BPE model with byte fallback (as the named one is); others are refused.
Null and empty texts have no ids and decode to the empty text.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from lagwatch.llm.bpe import Merger, PairTable
from lagwatch.llm.common import batches, texts_of

SPACE = "▁"
#: Stretches remembered by one Python worker before older ones go.
MEMORY = 300_000
#: Longer stretches are merged one by one.
LONGEST = 48


class CharacterMap:
    """The compiled map of a model; ``longest`` finds what replaces a prefix of the source."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.texts = blob[4 + size :]

    def longest(self, source: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest known prefix of ``source[at:]`` and its replacement."""
        units = self.units
        if not units:
            return None
        found = None
        node = self._child(units[0])
        for i in range(at, len(source)):
            node ^= source[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != source[i]:
                break
            node ^= self._child(unit)
            if unit >> 8 & 1:
                found = (i + 1 - at, units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        return found[0], self.texts[found[1] : self.texts.index(b"\0", found[1])]

    @staticmethod
    def _child(unit: int) -> int:
        return unit >> 10 << (8 if unit & 0x200 else 0)


def character_length(lead: int) -> int:
    return 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


class PieceCodec:
    def __init__(self, path: str):
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec, training = model.normalizer_spec, model.trainer_spec
        if training.model_type != training.BPE or not training.byte_fallback or training.treat_whitespace_as_suffix:
            raise ValueError("a BPE model with byte fallback and leading spaces is needed")
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.tidy = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.plain = not spec.precompiled_charsmap and self.prefix and not self.tidy
        kind = sentencepiece_model_pb2.ModelProto.SentencePiece
        self.pieces = [p.piece for p in model.pieces]
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
        self.byte_id = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kind.BYTE}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.hidden = {i for i, p in enumerate(model.pieces) if p.type in (kind.CONTROL, kind.UNKNOWN)}
        long = [p for p in normal if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in long):
            raise ValueError("a piece crosses a space")
        # symbols: pieces, then characters that only occur inside pieces, then one for all others
        self.symbol = dict(normal)
        for c in {c for p in long for c in p}:
            self.symbol.setdefault(c, len(self.pieces) + len(self.symbol))
        self.other = max(self.symbol.values(), default=0) + 1
        self.score = {i: model.pieces[i].score for i in normal.values()}
        self.alone_newline = not any("\n" in p for p in long)
        order = sorted(long, key=lambda p: -self.score[normal[p]])
        pairs = [
            (self.symbol[p[:cut]], self.symbol[p[cut:]], rank)
            for rank, p in enumerate(order)
            for cut in range(1, len(p))
            if p[:cut] in self.symbol and p[cut:] in self.symbol
        ]
        left, right, rank = (np.array(c, np.int64) for c in zip(*pairs, strict=True))
        made = np.array([normal[p] for p in order], np.int32)
        self.pair = {(a, b): int(made[r]) for a, b, r in pairs}
        self.merge = Merger(PairTable(left, right, rank.astype(np.int32), self.other + 1), made)
        scores = [self.score[normal[p]] for p in order if not p.startswith(SPACE * 2)]
        self.ties = len(set(scores)) < len(scores)
        self.stretches = re.compile(r" *[^ \n]+|\n| +" if self.alone_newline else r" *[^ ]+| +").findall
        # by code point: symbol; by id: its number as text, bytes of the source, decoded text
        self.symbol_of = np.full(0x110000, self.other, np.int32)
        for c, i in self.symbol.items():
            if len(c) == 1:
                self.symbol_of[ord(c)] = i
        self.number = [str(i).encode() for i in range(len(self.pieces))]
        self.plain_text = [p.replace(SPACE, " ") for p in self.pieces]
        self.source_size = [min(len(p.encode()), 65535) for p in self.plain_text]
        self.known: dict[str, tuple[bytes, bytes, str]] = {}
        self.old: dict[str, tuple[bytes, bytes, str]] = {}

    # normalisation

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """Normalised text, and for each of its bytes and its end the byte of the source it came from."""
        source = text.encode()
        out, origin = bytearray(), []
        at, space = 0, SPACE.encode()
        chunks = []  # (normalised bytes, source byte of each)
        while at < len(source):
            found = self.map.longest(source, at)
            n, new = found if found else (character_length(source[at]), None)
            if new is None:
                new, places = source[at : at + n], range(at, at + n)
            else:
                places = [at] * len(new)
            chunks.append((new, places))
            at += n
        if self.tidy:
            while chunks and chunks[0][0] in (b" ", b""):
                chunks.pop(0)
        if self.prefix and chunks:
            out += space
            origin += [chunks[0][1][0]] * 3 if chunks[0][1] else [0] * 3
        blank = self.tidy
        for new, places in chunks:
            if self.tidy and blank:
                places = places[len(new) - len(new.lstrip(b" ")) :]
                new = new.lstrip(b" ")
            if not new:
                continue
            for byte, place in zip(new, places, strict=True):
                if byte == 0x20:
                    out += space
                    origin += [place] * 3
                else:
                    out.append(byte)
                    origin.append(place)
            blank = new.endswith(b" ")
        end = len(source)
        if self.tidy:
            while out.endswith(space):
                end = origin[-3]
                del out[-3:], origin[-3:]
        return out.decode(), np.array([*origin, end], np.int64)

    # merging

    def _symbols(self, stretch: str) -> list[int]:
        return [self.symbol.get(c, self.other) for c in stretch]

    def _merge_one(self, stretch: str) -> list[tuple[int, str]]:
        """Best pair first, leftmost of equals, with a queue: for long stretches and equal scores."""
        text = list(stretch)
        ids: list[int | None] = self._symbols(stretch)
        following, before = list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
        queue: list[tuple[float, int, int, int, int, int]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < len(text) and (made := self.pair.get((ids[a], ids[b]))) is not None:
                heapq.heappush(queue, (-self.score[made], a, b, made, ids[a], ids[b]))

        for i in range(len(text) - 1):
            offer(i, i + 1)
        while queue:
            _, a, b, made, was_a, was_b = heapq.heappop(queue)
            if ids[a] != was_a or ids[b] != was_b or following[a] != b:
                continue
            text[a] += text[b]
            ids[a], ids[b] = made, None
            following[a] = following[b]
            if following[a] < len(text):
                before[following[a]] = a
            offer(before[a], a)
            offer(a, following[a])
        return [(i, t) for i, t in zip(ids, text, strict=True) if i is not None]

    def _finish(self, symbols: list[tuple[int, str]]) -> list[tuple[int, int]]:
        """(id, normalised bytes) with unknown characters spelt in bytes."""
        out = []
        for symbol, text in symbols:
            if symbol < len(self.pieces):
                out.append((symbol, len(text.encode())))
            else:
                out += [(self.byte_id[b], 1) for b in text.encode()]
        return out

    def _merge_many(self, stretches: list[str]) -> tuple[list[int], list[int]]:
        """Symbols of all stretches end to end, and their number in each."""
        points = np.frombuffer("".join(stretches).encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, stretches), np.int64, len(stretches))
        ids, counts = self.merge(self.symbol_of[points], lengths)
        return ids.tolist(), counts.tolist()

    def split_merge(self, stretches: list[str]) -> list[list[tuple[int, int]]]:
        """(id, normalised bytes) of the pieces of each stretch."""
        out: list = [None] * len(stretches)
        many = []
        for i, s in enumerate(stretches):
            if self.ties or len(s) > LONGEST or s.startswith(SPACE * 2):
                out[i] = self._finish(self._merge_one(s))
            elif s:
                many.append(i)
            else:
                out[i] = []
        if many:
            ids, counts = self._merge_many([stretches[i] for i in many])
            at = 0
            for i, n in zip(many, counts, strict=True):
                text, place, made = stretches[i], 0, []
                for symbol in ids[at : at + n]:
                    size = len(self.pieces[symbol]) if symbol < len(self.pieces) else 1
                    made.append((symbol, text[place : place + size]))
                    place += size
                out[i] = self._finish(made)
                at += n
        return out

    # the general interface

    def encode(self, text: str) -> list[tuple[int, int, int]]:
        """(id, begin, end) of each piece; begin and end are bytes of the source."""
        normal, origin = self.normalise(text)
        stretches = re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", normal)
        out, at = [], 0
        for pieces in self.split_merge(stretches):
            for i, n in pieces:
                out.append((i, int(origin[at]), int(origin[at + n])))
                at += n
        return out

    def decode(self, ids: list[int]) -> str:
        out, first, raw = [], True, bytearray()

        def flush() -> None:
            # each byte that is no part of a character stands for one replacement character
            while raw:
                try:
                    out.append(raw.decode())
                    raw.clear()
                except UnicodeDecodeError as e:
                    out.append(raw[: e.start].decode() + "�")
                    del raw[: e.start + 1]

        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                first = False
                continue
            flush()
            if i in self.hidden:
                continue
            piece = self.pieces[i]
            if first and (self.prefix or self.tidy) and piece.startswith(SPACE):
                piece = piece[1:]
            first = False
            out.append(piece.replace(SPACE, " "))
        flush()
        return "".join(out)

    # many texts

    def _learn(self, stretches: list[str]) -> None:
        """Remember (ids as text, source bytes of each piece, decoded text) of plain stretches."""
        slow, fast = [], []
        for s in stretches:
            (slow if self.ties or len(s) > LONGEST or s.startswith("  ") else fast).append(s)
        number, size, text = self.number.__getitem__, self.source_size.__getitem__, self.plain_text.__getitem__
        if fast:
            ids, counts = self._merge_many([s.replace(" ", SPACE) for s in fast])
            at, known, most = 0, self.known, len(self.pieces)
            for s, n in zip(fast, counts, strict=True):
                own = ids[at : at + n]
                at += n
                if max(own) >= most:
                    slow.append(s)
                else:
                    sizes = struct.pack(f"<{n}H", *map(size, own))
                    known[s] = (b",".join(map(number, own)), sizes, "".join(map(text, own)))
        for s, pieces in zip(slow, self.split_merge([s.replace(" ", SPACE) for s in slow]), strict=True):
            raw, at, sizes = s.replace(" ", SPACE).encode(), 0, []
            for _, n in pieces:
                sizes.append(n - 2 * raw.count(b"\xe2\x96\x81", at, at + n))
                at += n
            ids = [i for i, _ in pieces]
            # a piece before the stretch, so that decoding keeps the space of the stretch itself
            decoded = self.decode([self.symbol[SPACE], *ids])
            self.known[s] = (b",".join(map(number, ids)), np.array(sizes, "<u2").tobytes(), decoded)

    def digest(self, texts: list[str]) -> list[tuple[int, str, str, int]]:
        """(number of ids, digest of ids, digest of decoded text, CRC of piece ends) of each text."""
        if len(self.known) > MEMORY:
            self.old, self.known = self.known, {}
        known, old, get = self.known, self.old, self.known.get
        split, missing = [], set()
        for text in texts:
            if not self.plain or SPACE in text:
                split.append(None)
                continue
            stretches = self.stretches(" " + text) if text else []
            found, gaps, at = list(map(get, stretches)), [], -1
            try:
                while True:
                    at = found.index(None, at + 1)
                    s = stretches[at]
                    before = old.get(s)
                    if before is None:
                        missing.add(s)
                        gaps.append((at, s))
                    else:
                        found[at] = known[s] = before
            except ValueError:
                split.append((found, gaps))
        if missing:
            self._learn(list(missing))
        out = []
        for text, made in zip(texts, split, strict=True):
            if made is None:
                pieces = self.encode(text)
                ids = ",".join(str(i) for i, _, _ in pieces).encode()
                ends = np.array([e for _, _, e in pieces], "<u4")
                decoded = self.decode([i for i, _, _ in pieces])
            elif made[0]:
                found, gaps = made
                for at, s in gaps:
                    found[at] = known[s]
                parts, sizes, decoded = zip(*found, strict=True)
                ids = b",".join(parts)
                ends = (np.cumsum(np.frombuffer(b"".join(sizes), "<u2"), dtype=np.int64) - 1).astype("<u4")
                decoded = "".join(decoded)[1:]
            else:
                ids, ends, decoded = b"", np.zeros(0, "<u4"), ""
            out.append((
                len(ends), hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), zlib.crc32(ends.tobytes()),
            ))
        return out


_LOADED: dict[str, PieceCodec] = {}


def piece_codec(path: str) -> PieceCodec:
    """The codec of this Python worker."""
    if path not in _LOADED:
        _LOADED[path] = PieceCodec(path)
    return _LOADED[path]


def encode(docs: DataFrame, model: str) -> DataFrame:
    """One row per row of ``docs``: doc_id and ``pieces``, an array of (id, begin, end)."""
    kind = pa.list_(pa.struct([("id", pa.int32()), ("begin", pa.int32()), ("end", pa.int32())]))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec(model)
        for batch in batches(source, 200):
            rows = [[{"id": i, "begin": b, "end": e} for i, b, e in codec.encode(t)] for t in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["doc_id", "pieces"])

    schema = "doc_id long, pieces array<struct<id:int,begin:int,end:int>>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def digests(docs: DataFrame, model: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256, ends_crc32."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec(model)
        for batch in batches(source, 250):
            made = codec.digest(texts_of(batch.column(1)))
            columns = [pa.array([m[i] for m in made], t) for i, t in enumerate((pa.int64(), pa.string(), pa.string(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ends_crc32"]
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ends_crc32 long"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
