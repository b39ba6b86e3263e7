"""Suffix sorting by hashes, over many groups of byte strings at once.

Two suffixes are compared in logarithmic time: a binary search over prefix
polynomial hashes finds their common extension, the next byte decides. A
bottom-up mergesort runs in all groups together; each element finds its place
in the neighbouring run by binary search. At the end, neighbours are compared
byte by byte, and a group in which a hash collision has shown is sorted plainly.
"""

from __future__ import annotations

import numpy as np

_MUL = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BYTE_VALUES = np.random.default_rng(20250101).integers(1, 1 << 63, 256).astype(np.uint64)


class Powers:
    """Powers of the base and of its inverse, modulo 2^64; grown when needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> Powers:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            steps = np.full(size, _MUL)
            steps[0] = 1
            self.up = np.cumprod(steps)
            steps[1:] = _INVERSE
            self.down = np.cumprod(steps)
        return self


POWERS = Powers()


class Hashes:
    """Position-independent hashes of all substrings of `raw`."""

    def __init__(self, raw: np.ndarray):
        powers = POWERS.to(len(raw) + 1)
        self.down = powers.down
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[raw] * powers.up[:len(raw)], out=self.sums[1:])

    def of(self, begin: np.ndarray, length) -> np.ndarray:
        return (self.sums[begin + length] - self.sums[begin]) * self.down[begin]


def extension(hashes: Hashes, a, a_len, b, b_len) -> np.ndarray:
    """Common prefix length of the strings at a and b, by binary search."""
    low, high = np.zeros(len(a), np.int64), np.minimum(a_len, b_len)
    while (low < high).any():
        middle = (low + high + 1) >> 1
        same = hashes.of(a, middle) == hashes.of(b, middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def next_byte(raw: np.ndarray, begin, length, at) -> np.ndarray:
    """The byte at an offset, -1 at the string's end."""
    return np.where(at < length, raw[np.minimum(begin + at, len(raw) - 1)].astype(np.int64), -1)


def suffix_sort(raw: np.ndarray, begin: np.ndarray, length: np.ndarray, group: np.ndarray,
                hashes: Hashes | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings raw[begin : begin + length] within each group, and common prefix lengths.

    `group` is sorted. The second array has, per place of the order, the length
    that is common with the string before it in its group, -1 for the first.
    """
    n = len(begin)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    hashes = hashes or Hashes(raw)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[first, n])
    start, end = np.repeat(first, size), np.repeat(first + size, size)
    order, place = np.arange(n), np.arange(n)
    run_length = 1
    while run_length < size.max():
        local = place - start
        run = local // run_length
        other = start + (run ^ 1) * run_length
        high = np.clip(end - other, 0, run_length)
        low = np.zeros(n, np.int64)
        odd = (run & 1) == 1
        while True:
            todo = np.flatnonzero(low < high)
            if not len(todo):
                break
            middle = (low[todo] + high[todo]) >> 1
            x, y = order[todo], order[other[todo] + middle]
            same = extension(hashes, begin[x], length[x], begin[y], length[y])
            cx, cy = next_byte(raw, begin[x], length[x], same), next_byte(raw, begin[y], length[y], same)
            # An element of the second run comes after its equals of the first.
            behind = (cy < cx) | (odd[todo] & (cy == cx))
            low[todo] = np.where(behind, middle + 1, low[todo])
            high[todo] = np.where(behind, high[todo], middle)
        target = start + (run & ~1) * run_length + (local - run * run_length) + low
        new = np.empty_like(order)
        new[target] = order
        order = new
        run_length *= 2
    common = np.full(n, -1, np.int64)
    inner = np.flatnonzero(place > start)
    a, b = order[inner - 1], order[inner]
    common[inner] = extension(hashes, begin[a], length[a], begin[b], length[b])
    wrong = inner[~_in_order(raw, begin[a], length[a], begin[b], length[b], common[inner])]
    for low in np.unique(start[wrong]):
        high = end[low]
        texts = {i: raw[begin[i]:begin[i] + length[i]].tobytes() for i in order[low:high].tolist()}
        ranked = sorted(texts, key=texts.__getitem__)
        order[low:high] = ranked
        for k in range(1, len(ranked)):
            x, y = texts[ranked[k - 1]], texts[ranked[k]]
            m = min(len(x), len(y))
            differ = np.flatnonzero(np.frombuffer(x, np.uint8, m) != np.frombuffer(y, np.uint8, m))
            common[low + k] = differ[0] if len(differ) else m
    return order, common


def _in_order(raw, a, a_len, b, b_len, common) -> np.ndarray:
    """Byte by byte: the common part is equal, and what follows is in order."""
    good = next_byte(raw, a, a_len, common) <= next_byte(raw, b, b_len, common)
    good &= (next_byte(raw, a, a_len, common) != next_byte(raw, b, b_len, common)) | (common >= np.minimum(a_len, b_len))
    # Some strings at a time, so that the bytes compared stay few.
    for low in range(0, len(a), 1_000):
        part = common[low:low + 1_000]
        owner = np.repeat(np.arange(low, low + len(part)), part)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(part) - part, part)
        good[owner[raw[a[owner] + step] != raw[b[owner] + step]]] = False
    return good
