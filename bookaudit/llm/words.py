"""Words of a batch of texts as numpy arrays: bounds and 64-bit hashes without a Python loop over words.

Words are runs of bytes outside [\\x20\\x09-\\x0D]; letters A-Z count as a-z.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import batch_bytes, mix64

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n; kept for the next call of this process."""
    if len(_POWERS[0]) < n:
        n = max(n, 1 << 16)
        for k, b in enumerate((BASE, INVERSE)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0], _POWERS[1]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums: the hash of data[s:e] is (h[e] - h[s]) * INVERSE**s."""
    h = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[0][: len(data)], out=h[1:])
    return h


def slices(array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of pieces of an Arrow string array; a piece has at most `limit` bytes or one row."""
    data, offsets = batch_bytes(array)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each word; words never cross rows."""
    inside = ~SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True  # a row begins here
    first = first[:-1]
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | first))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:] & ~first[1:]
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For feature hashing only: texts can be made whose words collide."""
    h = prefix_hash(LOWER[data])
    inv = powers(len(data) + 1)[1]
    return mix64((h[ends] - h[starts]) * inv[starts] ^ (ends - starts).astype(np.uint64))


def codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Equal spans have equal codes, by comparison of their bytes; and the span of each code. Spans are in order and don't overlap."""
    size = ends - starts
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts[size > 0]] += 1
    edge[ends[size > 0]] -= 1
    offsets = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    held = np.ascontiguousarray(data[np.cumsum(edge[:-1], dtype=np.int8).astype(bool)])
    spans = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(held)]).dictionary_encode()
    return spans.indices.to_numpy().astype(np.int64), spans.dictionary


def keyed_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: bytes) -> np.ndarray:
    """64-bit keyed hashes of the words, over all of their bytes; different words meet by chance only, whatever the texts."""
    code, words = codes(LOWER[data], starts, ends)
    each = b"".join(hashlib.blake2b(w, digest_size=8, key=key).digest() for w in words.to_pylist())
    return np.frombuffer(each, np.uint64)[code]
