"""Sorting suffixes by hashed comparison, on arrays.

Prefix hashes are a polynomial modulo 2**64, so any substring's hash takes two look-ups.  A
common extension of two suffixes is found by binary search over its length, which makes a
comparison logarithmic; a bottom-up mergesort places all elements of a level at once, each by
binary search in its sibling run.  Hashes may collide: the common prefixes found are compared
byte by byte, and a group in which one differs is sorted again by its bytes.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
MIX = np.uint64(0xBF58476D1CE4E5B9)


@lru_cache(maxsize=4)
def powers(n: int):
    """(BASE**i, BASE**-i) modulo 2**64 for i up to n."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        p = np.ones(n + 1, np.uint64)
        filled, step = 1, base
        while filled <= n:
            more = min(filled, n + 1 - filled)
            p[filled : filled + more] = p[:more] * np.uint64(step)
            filled += more
            step = step * step % (1 << 64)
        out.append(p)
    return tuple(out)


class Hashes:
    """Hashes of any substring of a buffer."""

    def __init__(self, data):
        self.data = data
        size = 1 << max(10, (len(data)).bit_length())
        self.power, self.inverse = powers(size)
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[: len(data)], out=self.prefix[1:])

    def of(self, start, end):
        return (self.prefix[end] - self.prefix[start]) * self.inverse[start]

    def every(self, size: int):
        """Mixed hashes of all substrings of one size."""
        n = len(self.data) - size + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        x = (self.prefix[size:] - self.prefix[:n]) * self.inverse[:n]
        x ^= x >> np.uint64(32)
        x *= MIX
        x ^= x >> np.uint64(29)
        return x

    def extension(self, a, b, most):
        """Length of the longest common extension to the right, up to ``most``."""
        low, high = np.zeros(len(a), np.int64), most.astype(np.int64).copy()
        while (open_ := low < high).any():
            middle = (low + high + 1) >> 1
            same = self.of(a, a + middle) == self.of(b, b + middle)
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)
        return low

    def extension_left(self, a, b, most):
        """The same to the left of both places."""
        low, high = np.zeros(len(a), np.int64), most.astype(np.int64).copy()
        while (open_ := low < high).any():
            middle = (low + high + 1) >> 1
            same = self.of(a - middle, a) == self.of(b - middle, b)
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)
        return low

    def same_bytes(self, a, b, size):
        """Whether the ``size`` bytes from both places are equal, compared one by one."""
        out = np.ones(len(a), bool)
        for at in range(0, len(a), 8192):
            here = slice(at, at + 8192)
            most = int(size[here].max(initial=0))
            step = np.arange(most)
            last = len(self.data) - 1
            x = self.data[np.minimum(a[here, None] + step, last)]
            y = self.data[np.minimum(b[here, None] + step, last)]
            out[here] = ((x == y) | (step >= size[here, None])).all(1)
        return out


def _after(hashes: Hashes, a, b, end_a, end_b, or_equal: bool):
    """Whether suffix a is greater than suffix b (or equal to it)."""
    most = np.minimum(end_a - a, end_b - b)
    size = hashes.extension(a, b, most)
    out = (end_a - a) > (end_b - b)
    if or_equal:
        out |= (end_a - a) == (end_b - b)
    inside = size < most
    out[inside] = hashes.data[a[inside] + size[inside]] > hashes.data[b[inside] + size[inside]]
    return out


def suffix_sort(hashes: Hashes, start, end, group):
    """Sort the suffixes ``start`` to ``end`` inside each group.

    ``group`` holds equal neighbours for a group.  Returns (order, common): the places in
    sorted order, and how much each has in common with the one before it in its group, -1
    for a group's first.
    """
    n = len(start)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.empty(0, int)
    sizes = np.diff(np.r_[first, n])
    base, size = np.repeat(first, sizes), np.repeat(sizes, sizes)
    order = np.arange(n)
    width = 1
    while n and width < sizes.max():
        within = np.arange(n) - base
        run = within // width
        sibling = base + (run ^ 1) * width
        other = np.minimum(base + size, sibling + width) - sibling
        act = np.flatnonzero(other > 0)
        low, high = np.zeros(len(act), np.int64), other[act].astype(np.int64)
        left = (run[act] & 1) == 0
        x = order[act]
        while (todo := np.flatnonzero(low < high)).size:
            middle = (low[todo] + high[todo]) >> 1
            y = order[sibling[act[todo]] + middle]
            xs = x[todo]
            goes = np.empty(len(todo), bool)
            for side, or_equal in ((True, False), (False, True)):
                pick = left[todo] == side
                goes[pick] = _after(
                    hashes, start[xs[pick]], start[y[pick]], end[xs[pick]], end[y[pick]], or_equal
                )
            low[todo] = np.where(goes, middle + 1, low[todo])
            high[todo] = np.where(goes, high[todo], middle)
        pair = base[act] + (run[act] >> 1) * 2 * width
        placed = order.copy()
        placed[pair + (within[act] - run[act] * width) + low] = x
        order = placed
        width *= 2
    common = np.full(n, -1, np.int64)
    rest = np.flatnonzero(np.arange(n) != base)
    a, b = start[order[rest - 1]], start[order[rest]]
    most = np.minimum(end[order[rest - 1]] - a, end[order[rest]] - b)
    common[rest] = hashes.extension(a, b, most)
    wrong = rest[~hashes.same_bytes(a, b, common[rest])]
    for at in np.unique(base[wrong]):  # a collision: this group by its bytes
        members = sorted(range(at, at + size[at]), key=lambda i: hashes.data[start[i] : end[i]].tobytes())
        order[at : at + size[at]] = members
        for k in range(1, size[at]):
            p, q = (hashes.data[start[i] : end[i]] for i in members[k - 1 : k + 1])
            m = min(len(p), len(q))
            differs = np.flatnonzero(p[:m] != q[:m])
            common[at + k] = differs[0] if len(differs) else m
    return order, common
