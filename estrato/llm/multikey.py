"""Multikey three-way quicksort of suffix pointers, all segments of a depth at once.

A segment is a run of pointers whose suffixes agree in their first keys.  Each segment is split
by a pivot key into less, equal and greater; the equal part goes on one key deeper, and its size
is the count of that beginning.  A part that weighs less than the least count is abandoned, since
nothing in it can be frequent.
"""

from __future__ import annotations

import numpy as np


def _starts(lengths):
    return np.cumsum(lengths) - lengths


def _split(pointers, keys, weights, lengths):
    """The three parts of each segment, one after the other, and their lengths."""
    starts = _starts(lengths)
    n = len(lengths)
    thirds = np.stack([keys[starts], keys[starts + lengths // 2], keys[starts + lengths - 1]])
    pivot = np.sort(thirds, axis=0)[1]
    segment = np.repeat(np.arange(n), lengths)
    against = pivot[segment]
    part = 3 * segment + (keys >= against) + (keys > against)
    size = np.bincount(part, minlength=3 * n)
    weight = np.bincount(part, weights=weights, minlength=3 * n).astype(np.int64)
    return part, size, weight


def _kept(part, size, wanted, *columns):
    """The elements of the wanted parts, ordered by part, and the sizes of these."""
    sel = np.flatnonzero(wanted[part])
    order = sel[np.argsort(part[sel], kind="stable")]
    return [c[order] for c in columns], size[wanted]


def frequent_beginnings(keys, weights, least, depths=None):
    """For each depth d from 1: pointers to one suffix of each class of suffixes with equal first
    d keys, none 0, and weight ``least[d - 1]`` at least, and the weights of the classes.

    ``keys`` is a matrix with a suffix in each row, 0 after its end.
    """
    n, most = keys.shape
    pointers, lengths = np.arange(n), np.array([n] if n else [], np.int64)
    out = []
    for depth in range(min(most, depths or most)):
        column = keys[:, depth][pointers]
        ends = column == 0
        if ends.any():
            segment = np.repeat(np.arange(len(lengths)), lengths)
            lengths = np.bincount(segment[~ends], minlength=len(lengths))
            lengths = lengths[lengths > 0]
            pointers, column = pointers[~ends], column[~ends]
        weight = weights[pointers]
        done_pointers, done_sizes, done_weights = [], [], []
        while len(lengths):
            part, size, total = _split(pointers, column, weight, lengths)
            heavy = (size > 0) & (total >= least[depth])
            equal = np.arange(len(size)) % 3 == 1
            (p,), s = _kept(part, size, heavy & equal, pointers)
            done_pointers.append(p)
            done_sizes.append(s)
            done_weights.append(total[heavy & equal])
            (pointers, column, weight), lengths = _kept(part, size, heavy & ~equal, pointers, column, weight)
        pointers = np.concatenate([*done_pointers, np.zeros(0, np.int64)])
        lengths = np.concatenate([*done_sizes, np.zeros(0, np.int64)])
        totals = np.concatenate([*done_weights, np.zeros(0, np.int64)])
        out.append((pointers[_starts(lengths)], totals))
    return out
