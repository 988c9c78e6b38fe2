"""Vectorised word and shingle hashes over the byte buffers of Arrow string columns.

A word is a maximal run of bytes other than space and 0x09-0x0D; A-Z count as
a-z. UTF-8 bytes of longer characters are never in that set, so the bytes can
be classed without decoding. A word's hash is a polynomial of its bytes modulo
2**64, taken from one running sum over the buffer and then mixed.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Text bytes handled at a time; a longer text is a chunk of its own.
CHUNK = 1 << 19

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_BYTE = np.random.default_rng(7).integers(1, 2 ** 63, 256, dtype=np.uint64)
_LOWERED = _BYTE[LOWER]
_POW = [np.ones(1, _U), np.ones(1, _U)]


def release_memory() -> None:
    """Give what the allocators keep back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable) -> Callable:
    """``run`` over batches, giving freed memory back when a task ends: Python workers live on from task to task,
    and what their allocators keep adds up beside the executor's heap."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()
    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) <= n:
        size = max(n + 1, CHUNK + 1)
        for k, b in enumerate((_BASE, _INV)):
            p = np.full(size, b, _U)
            p[0] = 1
            _POW[k] = np.cumprod(p, dtype=_U)
    return _POW[0], _POW[1]


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its texts; a null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    _, off, data = col.buffers()
    offs = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offs


def chunks(col: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) for runs of rows of at most ``limit`` bytes."""
    data, offs = buffers(col)
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


class Words:
    """Words of a run of texts: byte ``start`` and ``end``, ``hash`` and, for each text, ``first``:
    text d has the words first[d] to first[d + 1]."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.data, self.offs = data, offs
        n = len(data)
        ink = np.zeros(n + 2, bool)
        ink[1:-1] = ~SPACE[data]
        edge = ink[1:] != ink[:-1]
        cut = offs[(offs > 0) & (offs < n)]
        inner = cut[ink[cut] & ink[cut + 1]]  # texts that touch without a space
        start, end = np.flatnonzero(edge & ink[1:]), np.flatnonzero(edge & ink[:-1])
        if len(inner):
            inner = np.unique(inner)
            start, end = np.sort(np.concatenate([start, inner])), np.sort(np.concatenate([end, inner]))
        self.start, self.end = start, end
        self.first = np.searchsorted(start, offs)
        up, down = _powers(n)
        run = np.zeros(n + 1, _U)
        np.take(_LOWERED, data, out=run[1:])
        run[1:] *= up[:n]
        np.cumsum(run[1:], out=run[1:])
        self.hash = mix((run[end] - run[start]) * down[start])

    def shingles(self, k: int = 5) -> np.ndarray:
        """For each word, the hash of it and the next k - 1 (meaningful where they are in one text)."""
        return rolled(self.hash, k)

    def sets(self, k: int = 5) -> list[np.ndarray]:
        """Per text, its distinct shingle hashes in ascending order: with fewer than k words, one
        for the whole sequence; without words, none."""
        all_, out = self.shingles(k), []
        for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist()):
            if b - a >= k:
                out.append(distinct(all_[a:b - k + 1]))
            elif b > a:
                out.append(rolled(self.hash[a:b], b - a, b - a)[:1])
            else:
                out.append(np.zeros(0, _U))
        return out


def distinct(x: np.ndarray) -> np.ndarray:
    """The values of ``x`` once each, in ascending order."""
    x = np.sort(x)
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return x[new]


def rolled(w: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """For each word hash, the hash of it and the next k - 1, as far as there are so many."""
    x = np.full(len(w), _U(0x51ED270B + salt), _U)
    for j in range(k):
        x *= _U(0xD6E8FEB86659FD93)
        if j < len(w):
            x[:len(w) - j] += w[j:]
    return mix(x)
