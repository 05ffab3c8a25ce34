"""Corpus order of windows in a bucket of phrases, from the orders of what stands before
and after their triggers.

A bucket holds phrases whose windows may be equal. A window of ``length`` bytes that begins
``d`` bytes before its phrase's trigger is a suffix (of ``d`` bytes) of the phrase's part
before the trigger and a prefix of what the parse has from there on. Both sides are
sorted once: the dictionary's suffixes by their bytes from the trigger backwards, the
parse's suffixes by their bytes onwards, each with the longest common prefixes (LCP) of
neighbours. Cut at a depth, an order falls into classes of equal strings, so for each ``d``
the pairs of both classes put the bucket's windows in order; windows are equal if and only
if their pairs are, that is if neighbours have an LCP of ``length``.
"""

from __future__ import annotations

import numpy as np


def _sorted(rows: np.ndarray, group: np.ndarray):
    """The order of byte rows within their groups and the LCP of each with the row before (-1: another group)."""
    n, width = rows.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rows
    words = padded.view(">u8").astype(np.uint64)
    order = np.lexsort((*words.T[::-1], group))
    lcp = np.full(n, -1)
    if n > 1:
        now, last = rows[order[1:]], rows[order[:-1]]
        differ = now != last
        lcp[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        lcp[1:][group[order[1:]] != group[order[:-1]]] = -1
    return order, lcp


def _classes(order: np.ndarray, lcp: np.ndarray, depth: int) -> np.ndarray:
    """For each row the class of rows that are equal to a depth."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(lcp < depth)
    return out


def repeated_windows(group, data: list[bytes], x, n, count, lo: int, hi: int, length: int):
    """(row, first, last + 1): runs of windows, by their places in ``data``, that stand elsewhere too.

    ``data`` holds all bytes of a phrase's ``n`` windows, its trigger at ``x``, and stands
    ``count`` times; rows with another ``group`` share no window, equal rows come once. Only windows that
    begin ``lo`` to ``hi`` bytes before the trigger are looked at, and only rows that stand once are told."""
    m, free = len(data), hi - lo
    before, after = np.zeros((m, max(free, 1)), np.uint8), np.zeros((m, length), np.uint8)
    for i, (b, t) in enumerate(zip(data, x.tolist())):
        part = np.frombuffer(b, np.uint8)
        left = part[max(0, t - hi):max(0, t - lo)][::-1]
        right = part[t - lo if t >= lo else 0:t - lo + length] if t >= lo else part[:0]
        before[i, :len(left)] = left
        after[i, :len(right)] = right
    back, fore = _sorted(before, group), _sorted(after, group)
    flags = np.zeros((m, free + 3), np.int8)  # by d - lo, an empty column on both sides
    for d in range(lo, hi + 1):
        rows = np.flatnonzero((x >= d) & (x - n < d))
        if len(rows) < 2:
            continue
        key = _classes(*back, d - lo)[rows] * (m + 1) + _classes(*fore, length - (d - lo))[rows]
        _, which, times = np.unique(key, return_inverse=True, return_counts=True)
        flags[rows[times[which] > 1], d - lo + 1] = 1
    flags[count > 1] = 0
    edge = np.diff(flags, axis=1)
    row, begin = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    # d falls as the place rises
    return row, x[row] - (lo + end - 1), x[row] - (lo + begin) + 1
