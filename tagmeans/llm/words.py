"""Words of many texts at once, in numpy and Arrow: no loop over words."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

WORD, SPACE, BREAK = 0, 1, 2

#: A-Z to a-z, all other bytes as they are.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def byte_kinds(spaces: bytes, breaks: bytes = b"") -> np.ndarray:
    """For each byte whether it belongs to a word, parts words, or ends a piece."""
    kinds = np.zeros(256, np.uint8)
    kinds[list(spaces)] = SPACE
    kinds[list(breaks)] = BREAK
    return kinds


@dataclass
class Words:
    """The words of some texts in order.

    ``codes``: each word's place in ``known``, the distinct words (binary); ``doc``: its
    text; ``left``: how many words its piece has from it on, itself included."""

    codes: np.ndarray
    known: pa.Array
    doc: np.ndarray
    left: np.ndarray


def words_of(texts: pa.Array, kinds: np.ndarray) -> Words:
    """Words (runs of bytes of kind ``WORD``, with A-Z lower-cased) of a string column; null: none."""
    column = texts.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0]:offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    kind = kinds[data]
    inside = kind == WORD
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]  # a text's first byte begins a word of its own
    first[edges] = inside[edges]
    last[edges[1:] - 1] = inside[edges[1:] - 1]
    at = np.flatnonzero(first)
    ends = np.r_[0, np.cumsum(np.flatnonzero(last) + 1 - at)].astype(np.int32)
    bytes_ = _FOLD[data[inside]]
    words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(bytes_)])
    coded = words.dictionary_encode()
    doc = (np.searchsorted(offsets, at, "right") - 1).astype(np.int32)
    piece = np.searchsorted(np.flatnonzero(kind == BREAK), at)
    new = np.flatnonzero(np.r_[True, (piece[1:] != piece[:-1]) | (doc[1:] != doc[:-1])]) if len(at) else at
    size = np.diff(np.r_[new, len(at)])
    left = np.repeat(new + size, size) - np.arange(len(at))
    return Words(coded.indices.to_numpy(), coded.dictionary, doc, left)


_MIX = np.uint64(0x9E3779B97F4A7C15)  # an odd number near 2 ** 64 / golden ratio


def mixed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers with their bits well mixed."""
    x = x * _MIX
    x ^= x >> np.uint64(29)
    x = x * _MIX
    return x ^ (x >> np.uint64(32))


def _sums(known: pa.Array):
    """Running sums that give the hash of any part of binary values, and where these begin."""
    offsets = np.frombuffer(known.buffers()[1], np.int32)[known.offset:known.offset + len(known) + 1].astype(np.int64)
    held = known.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0]:offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    each = (data.astype(np.uint64) + np.uint64(1)) * mixed(place.astype(np.uint64) + np.uint64(1))
    return np.r_[np.uint64(0), np.cumsum(each)], offsets


def word_hashes(known: pa.Array) -> np.ndarray:
    """A 64-bit hash of each binary value, the same in every task (not for telling values apart)."""
    if not len(known):
        return np.zeros(0, np.uint64)
    total, at = _sums(known)
    return mixed(total[at[1:]] - total[at[:-1]] + np.diff(at).astype(np.uint64))


def prefix_hashes(known: pa.Array, lengths) -> np.ndarray:
    """For each binary value a row of 64-bit hashes: of the whole and of its first bytes by
    ``lengths`` (0 where it has fewer)."""
    if not len(known):
        return np.zeros((0, 1 + len(lengths)), np.uint64)
    total, at = _sums(known)
    size = np.diff(at)
    out = [word_hashes(known) | np.uint64(1)]
    for n in lengths:
        part = mixed(total[at[:-1] + np.minimum(size, n)] - total[at[:-1]] + np.uint64(n << 32)) | np.uint64(1)
        out.append(np.where(size >= n, part, np.uint64(0)))
    return np.stack(out, axis=1)
