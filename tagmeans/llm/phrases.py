"""Content-defined phrases of byte texts, for the repeated spans of ``spans.py``."""

from __future__ import annotations

import numpy as np
import xxhash

#: Bytes of the rolling hash that triggers a phrase.
ROLL = 8
_MIX = np.uint64(0x9E3779B97F4A7C15)  # an odd number near 2 ** 64 / golden ratio


def triggers(text: np.ndarray, reach: int) -> np.ndarray:
    """For each start of ``reach`` + ``ROLL`` - 1 bytes, the place of the least rolling
    hash among the next ``reach`` places (the first of equal ones).

    The place depends on those bytes only, so equal strings have it at equal
    offsets; ``reach`` is a power of two."""
    n = len(text) - ROLL + 1
    if n < reach:
        return np.zeros(0, np.int64)
    x = np.ndarray(n, "<u8", np.ascontiguousarray(text), strides=(1,)).copy()
    x *= _MIX
    x ^= x >> np.uint64(29)
    x *= _MIX
    key = (x & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    step = 1
    while step < reach:
        key = np.minimum(key[:-step], key[step:])
        step *= 2
    return (key & np.uint64(0xFFFFFFFF)).astype(np.int64)


def phrases(data: bytes, length: int, reach: int):
    """The windows of ``length`` bytes of a text, by phrase: (``at``, ``n``, ``anchor``) arrays.

    The ``n`` windows from ``at`` on all have their trigger at ``anchor``; phrases
    follow one another and cover every window once."""
    text = np.frombuffer(data, np.uint8)
    windows = len(text) - length + 1
    if windows <= 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    out, block = [], 1 << 17
    for a in range(0, windows, block):
        b = min(a + block, windows)
        out.append(triggers(text[a:b + reach + ROLL - 2], reach)[:b - a] + a)
    anchor = np.concatenate(out)
    at = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    return at, np.diff(np.r_[at, windows]), anchor[at]


def hashes(data, begin, end, seed: int = 0) -> np.ndarray:
    """Signed 64-bit hashes of parts of a text. They deal work out; equality is told by bytes."""
    view, h = memoryview(data), xxhash.xxh3_64_intdigest
    return np.array([h(view[a:b], seed) for a, b in zip(begin.tolist(), end.tolist())], np.uint64).view(np.int64)


def parsed(data: bytes, length: int, reach: int):
    """Arrays of a text's phrases: first window, windows, trigger, core's hash and how
    often in a row the phrase stands there (equal neighbours are one entry).

    The core is the bytes that every window of the phrase has after its trigger;
    equal windows have equal cores."""
    at, n, anchor = phrases(data, length, reach)
    core = hashes(data, anchor, anchor + (length - reach + 1))
    if not len(at):
        return at, n, anchor, core, n
    like = (core[1:] == core[:-1]) & (n[1:] == n[:-1]) & (anchor[1:] - at[1:] == anchor[:-1] - at[:-1])
    for i in np.flatnonzero(like).tolist():
        size = int(n[i]) + length - 1
        like[i] = data[at[i]:at[i] + size] == data[at[i + 1]:at[i + 1] + size]
    new = np.flatnonzero(np.r_[True, ~like])
    return at[new], n[new], anchor[new], core[new], np.diff(np.r_[new, len(at)])
