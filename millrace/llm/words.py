"""Words of whole Arrow batches as numpy arrays: boundaries, 64-bit hashes, shingle hashes.

A word is a longest run of bytes outside ``\\x20\\x09-\\x0D``. Hashes are polynomials over the bytes modulo 2^64,
taken from one running sum per slice, so no Python loop runs per word. Equal words have equal hashes on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE_BYTES = 1 << 20
NULL_ID = 2**63 - 1  # ids that are null rank after all others

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over the word."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(29))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(32))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    return mix((np.arange(1, n + 1, dtype=U) + U(seed << 32)) * U(0x9E3779B97F4A7C15))


BYTES = stream(1, 256)
BASE = U(0x5851F42D4C957F2D)
BASE_INVERSE = U(pow(0x5851F42D4C957F2D, -1, 2**64))
STEPS = stream(2, 64) | U(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base`` to the powers 0..n-1; one slice's worth is kept."""
    kept = _powers.get(int(base))
    if kept is None or len(kept) < n:
        size = max(n, 1 << 16)
        kept = np.concatenate([np.ones(1, U), np.cumprod(np.full(size - 1, base, U), dtype=U)])
        if n <= 4 * SLICE_BYTES:
            _powers[int(base)] = kept
    return kept[:n]


class Words:
    """Words of several texts: ``start``/``end`` byte positions in ``data``, ``doc`` row numbers, ``offsets`` of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = LOWER[data] if lower else data
        self.offsets = offsets - offsets[0] if len(offsets) else offsets
        n = len(data)
        word = ~SPACE[self.data]
        cut = np.zeros(n + 1, bool)
        cut[self.offsets] = True
        before = np.ones(n, bool)
        after = np.ones(n, bool)
        if n:
            before[1:] = ~word[:-1]
            after[:-1] = ~word[1:]
        self.start = np.flatnonzero(word & (before | cut[:n]))
        self.end = np.flatnonzero(word & (after | cut[1:])) + 1
        self.doc = np.searchsorted(self.offsets, self.start, "right") - 1
        self.first = np.searchsorted(self.doc, np.arange(len(self.offsets)))  # word range of text i: first[i]:first[i + 1]

    def hashes(self, table: np.ndarray = BYTES) -> np.ndarray:
        n = len(self.data)
        total = np.zeros(n + 1, U)
        np.cumsum(table[self.data] * powers(BASE, n), out=total[1:])
        return mix((total[self.end] - total[self.start]) * powers(BASE_INVERSE, n)[self.start] + (self.end - self.start).astype(U)) if n else total[:0]

    def text(self, i: int, j: int) -> str:
        """Words i..j-1 as they stand, joined by one space."""
        data, s, e = self.data, self.start, self.end
        return b" ".join(data[s[k] : e[k]].tobytes() for k in range(i, j)).decode()


def windows(h: np.ndarray, k: int, doc: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of k words, and where it starts; windows that cross a text are left out."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    total = np.zeros(n, U)
    for j in range(k):
        total += h[j : n + j] * STEPS[j]
    at = np.arange(n) if doc is None else np.flatnonzero(doc[:n] == doc[k - 1 :])
    return mix(total if doc is None else total[at]), at


def winnow(h: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the place of its least one, the rightmost of ties."""
    n = len(h) - width + 1
    best, at = h[:n].copy(), np.arange(n)
    for j in range(1, width):
        less = h[j : n + j] <= best
        best = np.where(less, h[j : n + j], best)
        at = np.where(less, np.arange(j, n + j), at)
    return at


def buffers(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    col = col.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(col: pa.Array | pa.ChunkedArray, lower: bool = False) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) of consecutive slices of about SLICE_BYTES; a longer text is a slice of its own."""
    data, offsets = buffers(col)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE_BYTES, "right")) - 1)
        yield i, j, Words(data[offsets[i] : offsets[j]], offsets[i : j + 1], lower)
        i = j


def ids(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return col.fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype(np.int64) if isinstance(col, pa.Array) else col.combine_chunks().cast(pa.int64()).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
