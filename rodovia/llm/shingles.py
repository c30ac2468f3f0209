"""Word shingles of whole texts as 64-bit hashes, vectorised over slices of an Arrow batch.

A word is a maximal run of bytes outside space and 0x09-0x0D, with A-Z lower-cased. A text's set holds
the hashes of its distinct five-word shingles; a text of one to four words has its whole word sequence
as its only shingle; a text without words has the empty set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WIDTH = 5
SLICE_BYTES = 1 << 20

_U = np.uint64
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Odd multipliers and the byte table are random numbers of a fixed seed.
_RNG = np.random.default_rng(20240501)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
_BYTE[_BLANK] = 0
_P, _Q = (int(x) | 1 for x in _RNG.integers(1, 1 << 63, 2, dtype=np.uint64))
_powers = np.array([1], np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (in place)."""
    t = x >> _U(33)
    x ^= t
    x *= _U(0xFF51AFD7ED558CCD)
    np.right_shift(x, _U(33), out=t)
    x ^= t
    x *= _U(0xC4CEB9FE1A85EC53)
    np.right_shift(x, _U(33), out=t)
    x ^= t
    return x


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.ones(max(n, 256), np.uint64)
        _powers[1:] = _U(_P)
        np.multiply.accumulate(_powers, out=_powers)
    return _powers


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) of runs of rows with at most ``limit`` bytes, or of one longer row.

    Null texts have no bytes.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        yield i, raw[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def words(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and each row's first word (one more at the end)."""
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offs), np.int64)
    blank = _BLANK[raw]
    start = ~blank
    after_word = np.empty(n, bool)
    after_word[0], after_word[1:] = False, ~blank[:-1]
    heads = offs[:-1]
    after_word[heads[heads < n]] = False
    start &= ~after_word
    begins = np.flatnonzero(start)
    if len(begins) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offs), np.int64)
    place = np.arange(n)
    place[begins[0]:] -= np.repeat(begins, np.diff(np.append(begins, n)))
    place[:begins[0]] = 0
    power = _power_table(int(place.max()) + 1)
    parts = _BYTE[_LOWER[raw]]
    parts *= power[place]
    hashed = mix64(np.add.reduceat(parts, begins))
    return hashed, np.searchsorted(begins, offs)


def sequences(hashed: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all rows in text order (with repeats), and each row's first shingle."""
    n_words = np.diff(first)
    sizes = np.where(n_words >= WIDTH, n_words - WIDTH + 1, np.minimum(n_words, 1))
    begin = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(int(begin[-1]), np.uint64)
    if len(hashed) >= WIDTH:
        rolled = hashed[:len(hashed) - WIDTH + 1].copy()
        for j in range(1, WIDTH):
            rolled *= _U(_Q)
            rolled += hashed[j:len(hashed) - WIDTH + 1 + j]
    for r in np.flatnonzero((n_words > 0) & (n_words < WIDTH)):
        h = 0
        for w in hashed[first[r]:first[r + 1]]:
            h = (h * _Q + int(w)) & 0xFFFFFFFFFFFFFFFF
        out[begin[r]] = h ^ int(n_words[r])
    long = np.flatnonzero(n_words >= WIDTH)
    if len(long):
        count = sizes[long]
        shift = np.repeat(first[long] - begin[long], count)
        at = np.arange(int(count.sum())) + np.repeat(begin[long] - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
        out[at] = rolled[at + shift]
    return mix64(out), begin


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) for every row of a text column."""
    for row, raw, offs in text_slices(column):
        seq, begin = sequences(*words(raw, offs))
        for k in range(len(offs) - 1):
            part = np.sort(seq[begin[k]:begin[k + 1]])
            if len(part) > 1:
                keep = np.empty(len(part), bool)
                keep[0] = True
                np.not_equal(part[1:], part[:-1], out=keep[1:])
                part = part[keep]
            yield row + k, part


def intersection_size(a: np.ndarray, b: np.ndarray) -> int:
    """Common elements of two sorted arrays of distinct hashes."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == 0:
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))
