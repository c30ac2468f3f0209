"""Hashes of the words of whole texts for any set of separating bytes; a long text goes in pieces."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from rodovia.llm.shingles import _power_table, mix64, text_slices

PIECE_BYTES = 1 << 20
LONGEST = 1 << 12  # bytes of a word that one power table covers; a longer word is hashed in folds

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Splitter:
    """Words are maximal runs of bytes that do not separate; A-Z become a-z if ``lower``."""

    def __init__(self, separates: np.ndarray, lower: bool, seed: int):
        table = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
        table = table[_LOWER] if lower else table
        table[separates] = 0
        self.separates, self.table = separates, table

    def words(self, raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """64-bit hashes of all words in order, and each row's first word (one more at the end)."""
        if len(raw) == 0:
            return np.zeros(0, np.uint64), np.zeros(len(offs), np.int64)
        inside = ~self.separates[raw]
        start = inside.copy()
        start[1:] &= ~inside[:-1]
        heads = offs[:-1][offs[:-1] < len(raw)]
        start[heads] = inside[heads]
        begins = np.flatnonzero(start)
        if len(begins) == 0:
            return np.zeros(0, np.uint64), np.zeros(len(offs), np.int64)
        place = np.arange(len(raw), dtype=np.int64)
        place[begins[0]:] -= np.repeat(begins, np.diff(np.append(begins, len(raw))))
        fold, place = place // LONGEST, place % LONGEST
        parts = self.table[raw]
        parts *= _power_table(LONGEST)[place]
        if fold[begins[0]:].any():
            parts = np.where(fold > 0, mix64(parts + fold.astype(np.uint64)) * inside, parts)
        return mix64(np.add.reduceat(parts, begins)), np.searchsorted(begins, offs)

    def slices(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, bytes, row offsets) of runs of rows; a row above PIECE_BYTES comes in pieces cut between words."""
        for row, raw, offs in text_slices(column, PIECE_BYTES):
            if len(raw) <= 2 * PIECE_BYTES:
                yield row, raw, offs
                continue
            lo = 0
            while lo < len(raw):
                hi = lo + PIECE_BYTES
                while hi < len(raw) and not self.separates[raw[hi]]:
                    gap = np.flatnonzero(self.separates[raw[hi:hi + PIECE_BYTES]])
                    hi += int(gap[0]) if len(gap) else PIECE_BYTES
                hi = min(hi, len(raw))
                yield row, raw[lo:hi], np.array([0, hi - lo])
                lo = hi
