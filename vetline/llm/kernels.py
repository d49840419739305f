"""Vectorised byte kernels that run inside tasks: words, their hashes, shingles.

Text is lower-cased A-Z only; a word is a run of bytes other than 0x20 and 0x09-0x0D.
Hashes are 64-bit: a polynomial over random byte codes, finished with a mixing function.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

SLICE_BYTES = 1 << 21
_BLOCK = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """The SplitMix64 finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


CODES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, _BLOCK + 1024)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running sums of code * base**i; with `window_hashes` they give the hash of any stretch."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(CODES[data] * _power(_BASE, len(data)), out=sums[1:])
    return sums


def window_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for each pair, the same wherever the bytes stand."""
    return (sums[ends] - sums[starts]) * _power(_INVERSE, len(sums))[starts]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string or binary column into runs of rows of about `limit` bytes (one row at least).

    Gives first row, last row + 1, the bytes, and where each row starts in them (one more at the end).
    """
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    held = column.buffers()[2] if n else None
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the index of each row's first word (one more at the end)."""
    solid = ~SPACE[data]
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = solid[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = solid[1:]
    after[inner - 1] = False
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, in blocks so that memory does not follow the text's length."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + _BLOCK, "right")))
        base = starts[first]
        sums = prefix_sums(data[base : ends[last - 1]])
        out[first:last] = window_hashes(sums, starts[first:last] - base, ends[first:last] - base)
        first = last
    return mix64(out + (ends - starts).astype(np.uint64))


def sequence_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n consecutive word hashes (rows are not told apart here)."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    factor = 1
    for i in range(n):
        total += hashes[i : i + count] * np.uint64(factor)
        factor = factor * 0xD6E8FEB86659FD93 % (1 << 64)
    return mix64(total + np.uint64(n))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its n-word shingles.

    With fewer words the whole sequence is the only shingle; without words the set is empty.
    """
    data = LOWER[data]
    starts, ends, first = words(data, offsets)
    hashes = word_hashes(data, starts, ends)
    runs = sequence_hashes(hashes, n)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            yield np.unique(runs[a : b - n + 1])
        elif b > a:
            yield sequence_hashes(hashes[a:b], b - a)
        else:
            yield np.zeros(0, np.uint64)
