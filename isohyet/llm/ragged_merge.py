"""Byte-pair merges over many short sequences held as ragged numpy arrays.

All sequences lie one after the other in flat arrays. In each round every
sequence applies its lowest-ranked pair, the leftmost one on ties, and all
sequences do so at once. A sequence without a ranked pair is finished.
"""

from __future__ import annotations

import heapq

import numpy as np

NO_PAIR = np.int64(1) << 62
# Longer sequences are merged one by one with a heap: their rounds would be many and small.
LONG = 400


class MergeTable:
    """Ranked pairs (left, right) -> merged symbol, looked up in a sorted array."""

    def __init__(self, left, right, merged, rank, n_symbols: int):
        self.n_symbols = np.int64(n_symbols)
        key = np.asarray(left, np.int64) * self.n_symbols + np.asarray(right, np.int64)
        order = np.argsort(key, kind="stable")
        self.keys = key[order]
        self.merged = np.asarray(merged, np.int64)[order]
        self.rank = np.asarray(rank, np.int64)[order]
        self.by_key: dict[int, tuple[int, int]] | None = None

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; NO_PAIR where there is none. Symbols below 0 never merge."""
        if not len(self.keys):
            return np.full(len(left), NO_PAIR), np.zeros(len(left), np.int64)
        key = np.where((left >= 0) & (right >= 0), left * self.n_symbols + right, -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NO_PAIR), self.merged[at]

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The surviving symbols of all sequences, one after the other, and their number per sequence."""
        n = len(lengths)
        lengths = np.asarray(lengths, np.int64)
        symbols = np.asarray(symbols, np.int64)
        owner = np.repeat(np.arange(n), lengths)
        done_symbols, done_owner = [], []
        for i in np.flatnonzero(lengths > LONG):
            start = int(lengths[:i].sum())
            kept = self.merge_long(symbols[start:start + lengths[i]])
            done_symbols.append(kept)
            done_owner.append(np.full(len(kept), i))
        short = (lengths <= LONG)[owner]
        symbols, owner = symbols[short], owner[short]
        rank, merged = self._pairs(symbols, owner)
        while len(symbols):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            size = np.diff(np.r_[first, len(owner)])
            # The lowest rank, and the leftmost place among equals, in one number.
            place = np.arange(len(symbols), dtype=np.int64)
            low = np.minimum.reduceat(np.where(rank == NO_PAIR, NO_PAIR, rank * (1 << 32) + place), first)
            open_ = low < NO_PAIR
            if not open_.all():
                closed = np.repeat(~open_, size)
                done_symbols.append(symbols[closed])
                done_owner.append(owner[closed])
            at = (low[open_] & 0xFFFFFFFF).astype(np.int64)
            symbols[at] = merged[at]
            keep = np.repeat(open_, size)
            keep[at + 1] = False
            shift = np.cumsum(keep) - 1
            symbols, owner, rank, merged = symbols[keep], owner[keep], rank[keep], merged[keep]
            at = shift[at]
            for spot in (at, at[at > 0] - 1):
                after = np.minimum(spot + 1, len(symbols) - 1)
                fresh_rank, fresh = self.look_up(symbols[spot], symbols[after])
                inside = (spot + 1 < len(symbols)) & (owner[after] == owner[spot])
                rank[spot] = np.where(inside, fresh_rank, NO_PAIR)
                merged[spot] = fresh
        if not done_symbols:
            return np.empty(0, np.int64), np.zeros(n, np.int64)
        owner = np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(done_symbols)[order], np.bincount(owner, minlength=n)

    def _pairs(self, symbols, owner):
        if not len(symbols):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        rank, merged = self.look_up(symbols[:-1], symbols[1:])
        rank = np.where(owner[:-1] == owner[1:], rank, NO_PAIR)
        return np.r_[rank, NO_PAIR], np.r_[merged, 0]

    def merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """One long sequence: a heap of (rank, place) over a linked list gives the same order of merges."""
        if self.by_key is None:
            self.by_key = {int(k): (int(r), int(m)) for k, r, m in zip(self.keys, self.rank, self.merged)}
        sym, n, base = [int(s) for s in symbols], len(symbols), int(self.n_symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def push(i: int) -> None:
            j = after[i]
            if j < n and sym[i] >= 0 and sym[j] >= 0:
                found = self.by_key.get(sym[i] * base + sym[j])
                if found:
                    heapq.heappush(heap, (found[0], i, sym[i], sym[j]))

        for i in range(n - 1):
            push(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue
            sym[i] = self.by_key[a * base + b][1]
            sym[j] = -2
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return np.array([s for s in sym if s != -2], np.int64)
