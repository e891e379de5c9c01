"""Ids of the public word-end BPE vocabulary, by white-space word with a bounded memory of words.

The library's own encoder is the authority. A word of Latin letters, digits and signs in
normal form is split and merged here, many at once; every other word goes through the library.
Words may be treated one by one because ASCII white space is dropped by the tokenizer, never joins a
piece, and stops canonical composition. A text that may hold one of the added tokens goes through the
library as a whole.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import regex
from tokenizers import Tokenizer

from lagwatch.llm import memory
from lagwatch.llm.bpe import Merger, PairTable

#: Words remembered by one Python worker before the memory is emptied.
MEMORY = 500_000
#: Longer words go through the library.
LONGEST = 64


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(printable) else chr(next(spare)) for b in range(256)]


class WordBpe:
    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        self.library = Tokenizer.from_file(path)
        #: Lower-cased, so that a token matched before or after normalisation is found.
        self.added = [t["content"].lower().encode() for t in spec["added_tokens"]]
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        pattern = next(
            p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"
        )
        self.split = regex.compile(pattern).findall
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int32)
        self.last = np.array([vocab[c + end] for c in letters], np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int32)
        rank = np.arange(len(merges), dtype=np.int32)
        self.merge = Merger(PairTable(left, right, rank, len(vocab)), made)
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _parts(self, word: bytes) -> list[bytes] | None:
        """Lower-cased parts that are merged apart, or None where the library has to do it."""
        if len(word) > LONGEST:
            return None
        text = word.decode()
        if text.isascii():
            if text.isalpha():
                return [word]
            if text[-1] in ",.;:!?" and text[:-1].isalpha():
                return [word[:-1], word[-1:]]
            if min(text) >= " ":
                return [p.encode() for p in self.split(text)]
            return None
        if max(text) >= "\u0250" or min(text) < " " or "\x85" in text or "\xa0" in text:
            return None
        if not unicodedata.is_normalized("NFC", text):
            return None
        text = text.lower()
        if text.isalpha():
            return [text.encode()]
        if text[-1] in ",.;:!?" and text[:-1].isalpha():
            return [text[:-1].encode(), text[-1].encode()]
        return [p.encode() for p in self.split(text)]

    def learn(self, words: list[bytes]) -> None:
        """Add the ids of ``words`` (lower-cased in ASCII, no ASCII white space) to the memory."""
        known, old = self.known, self.old
        apart: dict[bytes, list[bytes]] = {}
        new: dict[bytes, None] = {}
        for word in words:
            parts = self._parts(word)
            if parts is None:
                ids = self.library.encode(word.decode(), add_special_tokens=False).ids
                known[word] = np.array(ids, "<u4").tobytes()
            else:
                if len(parts) != 1 or parts[0] != word:
                    apart[word] = parts
                for part in parts:
                    if part not in known:
                        if part in old:
                            known[part] = old[part]
                        else:
                            new[part] = None
        if new:
            parts = list(new)
            flat = np.frombuffer(b"".join(parts), np.uint8)
            lengths = np.fromiter(map(len, parts), np.int64, len(parts))
            ends = np.cumsum(lengths) - 1
            symbols = self.inner[flat]
            symbols[ends] = self.last[flat[ends]]
            ids, counts = self.merge(symbols, lengths)
            data = ids.astype("<u4").tobytes()
            stops = (np.cumsum(counts) * 4).tolist()
            start = 0
            for part, stop in zip(parts, stops, strict=True):
                known[part] = data[start:stop]
                start = stop
        for word, parts in apart.items():
            known[word] = b"".join([known[p] for p in parts])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each UTF-8 text as unsigned little-endian 32-bit numbers."""
        if len(self.known) > MEMORY:  # words seen since the last turn stay, older ones go
            self.old, self.known = self.known, {}
        get, old = self.known.get, self.old
        found, open_at, missing = [], [], set()
        for text in texts:
            low = text.lower()
            if any(token in low for token in self.added):
                ids = self.library.encode(text.decode(), add_special_tokens=False).ids
                found.append([np.array(ids, "<u4").tobytes()])
                open_at.append([])
                continue
            words = low.split()
            ids = list(map(get, words))
            gaps = []
            if None in ids:
                at = -1
                try:
                    while True:
                        at = ids.index(None, at + 1)
                        word = words[at]
                        ids[at] = before = old.get(word)
                        if before is None:
                            missing.add(word)
                            gaps.append((at, word))
                        else:
                            self.known[word] = before
                except ValueError:
                    pass
            found.append(ids)
            open_at.append(gaps)
        if missing:
            self.learn(list(missing))
        for ids, gaps in zip(found, open_at, strict=True):
            for at, word in gaps:
                ids[at] = get(word)
        return [b"".join(ids) for ids in found]


_LOADED: dict[str, WordBpe] = {}


def word_bpe(path: str) -> WordBpe:
    """The tokenizer of this Python worker."""
    memory.begin("word_bpe", _LOADED.clear)
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]
