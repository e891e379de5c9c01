"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary is a trie with failure links. Where no edge fits the next character, the automaton
follows the failure link of its node, which stands for "emit the pieces that greedy matching would emit
here, and go on with the rest": how many pieces that pops is precomputed for each node. So a word is read once,
character by character, and its number of pieces comes out without any piece being built.

A word (a run of anything but ASCII white space) is matched as ``start`` + characters: pieces that
begin with ``start`` begin a word, all others continue one. A word that cannot be covered counts as one
unknown piece. Null and empty texts have no pieces.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagwatch.llm.common import batches, bytes_of

START = "▁"
#: Words remembered by one Python worker before older ones go.
MEMORY = 600_000


def pieces_of_model(path: str) -> list[str]:
    """Ordinary pieces of a sentencepiece model file (no control, unknown or byte pieces)."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return [model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


class LongestMatch:
    """``first`` is where a word begins, ``rest`` where its continuations begin."""

    def __init__(self, pieces: Iterable[str], start: str = START):
        self.edges: list[dict[str, int]] = [{}, {}]
        self.final = [False, False]
        first, rest = 0, 1
        for piece in pieces:
            begins = piece.startswith(start)
            body = piece[len(start) :] if begins else piece
            if not body or start in body:
                continue
            node = first if begins else rest
            for letter in body:
                if letter not in self.edges[node]:
                    self.edges[node][letter] = len(self.edges)
                    self.edges.append({})
                    self.final.append(False)
                node = self.edges[node][letter]
            self.final[node] = True
        n = len(self.edges)
        self.fail, self.pops = [-1] * n, [0] * n  # -1: no continuation exists
        waiting = deque((root, letter, child) for root in (first, rest) for letter, child in self.edges[root].items())
        while waiting:  # by depth, so that links of shorter strings are known
            parent, letter, node = waiting.popleft()
            if self.final[node]:
                self.fail[node], self.pops[node] = rest, 1
            else:
                at, popped = self.fail[parent], self.pops[parent]
                while at >= 0 and letter not in self.edges[at]:
                    at, popped = self.fail[at], popped + self.pops[at]
                if at >= 0:
                    self.fail[node], self.pops[node] = self.edges[at][letter], popped
            waiting.extend((node, letter, child) for letter, child in self.edges[node].items())

    def count(self, word: str) -> int:
        """Pieces of one word; 1 if it cannot be covered."""
        edges, fail, pops = self.edges, self.fail, self.pops
        node = total = 0
        for letter in word:
            while letter not in edges[node]:
                total += pops[node]
                node = fail[node]
                if node < 0:
                    return 1
            node = edges[node][letter]
        while node != 1:  # pop what is left until only the empty rest remains
            if node < 0 or fail[node] < 0:
                return 1
            total += pops[node]
            node = fail[node]
        return total


class Counter:
    """Counts of words with a memory in two generations."""

    def __init__(self, path: str):
        self.match = LongestMatch(pieces_of_model(path))
        self.known: dict[bytes, int] = {}
        self.old: dict[bytes, int] = {}

    def __call__(self, text: bytes) -> tuple[int, int]:
        if len(self.known) > MEMORY:
            self.old, self.known = self.known, {}
        words = text.split()
        found = list(map(self.known.get, words))
        if None in found:
            for at, (word, value) in enumerate(zip(words, found, strict=True)):
                if value is None:
                    value = self.old.get(word)
                    if value is None:
                        value = self.match.count(word.decode())
                    self.known[word] = found[at] = value
        return len(words), sum(found)


_LOADED: dict[str, Counter] = {}


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_pieces."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _LOADED:
            _LOADED[vocabulary] = Counter(vocabulary)
        counter = _LOADED[vocabulary]
        for batch in batches(source):
            counts = [counter(t) for t in bytes_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([c[i] for c in counts], pa.int64()) for i in (0, 1))],
                ["doc_id", "n_words", "n_pieces"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_words long, n_pieces long"
    )
