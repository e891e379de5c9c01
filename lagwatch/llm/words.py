"""Word hashes and rolling hashes over many documents at once."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import xxhash

from lagwatch.llm import memory

#: Word hashes remembered by one Python worker before older ones go.
MEMORY = 200_000


class WordHashes:
    """64-bit XXH3 of words, remembered in two generations."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}
        self.old: dict[bytes, int] = {}

    def __call__(self, words: Sequence[bytes]) -> np.ndarray:
        if len(self.known) > MEMORY:
            self.old, self.known = self.known, {}
        found = list(map(self.known.get, words))
        if None in found:
            at = -1
            try:
                while True:
                    at = found.index(None, at + 1)
                    word = words[at]
                    value = self.known.get(word)
                    if value is None:
                        value = self.old.get(word)
                    if value is None:
                        value = xxhash.xxh3_64_intdigest(word)
                    self.known[word] = found[at] = value
            except ValueError:
                pass
        return np.array(found, np.uint64)


    def forget(self) -> None:
        self.known, self.old = {}, {}


_HASHES = WordHashes()


def hash_texts(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts end to end, and the number of words of each text.

    ``bytes.split`` without argument cuts at exactly the six ASCII white-space characters.
    """
    memory.begin("words", _HASHES.forget)
    parts, counts = [], []
    for text in texts:
        words = text.split()
        parts.append(_HASHES(words))
        counts.append(len(words))
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return flat, np.array(counts, np.int64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Rolling:
    """Polynomial hashes modulo 2^64 of any stretch of words, from one running sum.

    The base is odd, hence invertible, so the sum of a stretch can be shifted back to exponent 0.
    """

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, hashes: np.ndarray, base: int = BASE):
        n = len(hashes)
        self.back = powers(pow(base, -1, 1 << 64), n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * powers(base, n), out=self.sums[1:])

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.back[start]


def grams(hashes: np.ndarray, k: int, base: int = 0xC2B2AE3D27D4EB4F) -> np.ndarray:
    """Mixed hash of each run of ``k`` words; index is the first word."""
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(base) + hashes[j : j + n]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0x9FB21C651E98DF25)
    out ^= out >> np.uint64(28)
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values, by doubling."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    have, out = 1, values
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:n], out[rest : rest + n])
