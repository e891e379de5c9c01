"""Byte-pair merging of many words at once in numpy.

All words of one length form a matrix with a row per word. Each step merges, in every row, the pair
of lowest rank (the leftmost of equals) and so shortens all rows by one symbol; rows without a
mergeable pair are finished and leave the matrix. Ranks of adjacent pairs are looked up in a
hash table held in two arrays.
"""

from __future__ import annotations

import numpy as np

NONE = np.int32(2**31 - 1)


class PairTable:
    """Map from (left id, right id) to rank; open addressing, at most a quarter full."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, space: int):
        self.space = np.int64(space)
        bits = max(8, int(np.ceil(np.log2(max(1, len(left)) * 4))))
        self.shift = np.uint64(64 - bits)
        self.mask = np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NONE, np.int32)
        keys = left.astype(np.int64) * self.space + right
        slots = self._slot(keys)
        waiting = np.arange(len(keys))
        while len(waiting):
            at = slots[waiting]
            free = self.keys[at] == -1
            first = np.zeros(len(waiting), bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = waiting[free & first]
            self.keys[slots[put]] = keys[put]
            self.ranks[slots[put]] = rank[put]
            waiting = waiting[~(free & first)]
            slots[waiting] = (slots[waiting] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * self.space + right
        slots = self._slot(keys)
        found = self.keys[slots]
        out = self.ranks[slots]
        wrong = np.flatnonzero((found != keys) & (found != -1))
        out[found != keys] = NONE
        while len(wrong):
            slots[wrong] = (slots[wrong] + 1) & self.mask
            found = self.keys[slots[wrong]]
            hit = found == keys[wrong]
            out[wrong[hit]] = self.ranks[slots[wrong[hit]]]
            wrong = wrong[~hit & (found != -1)]
        return out


class Merger:
    """Greedy merging by rank. ``made`` maps a rank to the symbol id that the merge makes."""

    def __init__(self, table: PairTable, made: np.ndarray, block: int = 4096):
        self.table, self.made, self.block = table, made.astype(np.int32), block

    def __call__(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge words laid end to end; returns the same layout with merged symbols."""
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        out = symbols.astype(np.int32, copy=True)
        left_over = lengths.astype(np.int64, copy=True)
        order = np.argsort(lengths, kind="stable")
        cuts = np.flatnonzero(np.diff(lengths[order])) + 1
        for same in np.split(order, cuts):
            if len(same) and lengths[same[0]] > 1:
                for at in range(0, len(same), self.block):
                    self._merge(out, starts, left_over, same[at : at + self.block], int(lengths[same[0]]))
        keep = np.arange(len(out)) - np.repeat(starts, lengths) < np.repeat(left_over, lengths)
        return out[keep], left_over

    def _merge(self, out, starts, left_over, words, n: int) -> None:
        rows = out[starts[words][:, None] + np.arange(n)]
        ranks = self.table(rows[:, :-1].ravel(), rows[:, 1:].ravel()).reshape(len(words), n - 1)
        while n > 1:
            best = ranks.argmin(1)
            at = np.arange(len(words))
            low = ranks[at, best]
            done = low == NONE
            if done.any():
                ends = words[done]
                out[starts[ends][:, None] + np.arange(n)] = rows[done]
                left_over[ends] = n
                on = ~done
                words, rows, ranks, best, low = words[on], rows[on], ranks[on], best[on], low[on]
                if not len(words):
                    return
                at = np.arange(len(words))
            n -= 1
            new = self.made[low]
            shift = np.arange(n) > best[:, None]
            rows = np.where(shift, rows[:, 1:], rows[:, :-1])
            rows[at, best] = new
            if n == 1:
                break
            ranks = np.where(shift[:, 1:] | (np.arange(n - 1) == best[:, None]), ranks[:, 1:], ranks[:, :-1])
            has = np.flatnonzero(best > 0)
            ranks[has, best[has] - 1] = self.table(rows[has, best[has] - 1], new[has])
            has = np.flatnonzero(best < n - 1)
            ranks[has, best[has]] = self.table(new[has], rows[has, best[has] + 1])
        out[starts[words]] = rows[:, 0]
        left_over[words] = 1
