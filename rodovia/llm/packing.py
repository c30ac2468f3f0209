"""Packing whole documents into training sequences by best-two-fit.

Every document becomes its token ids and a closing id 0; a longer one than a sequence is cut into full pieces and a
rest. Packing decides on lengths alone: the histogram of lengths (at most as many entries as a sequence has tokens,
whatever the corpus) is packed on the driver into patterns that repeat, and every piece finds its place from its
rank among the pieces of its length. A bin is filled greedily with the longest pieces that fit; then its smallest
piece is exchanged for two unpacked pieces when these fill the gap that it leaves more tightly.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from rodovia.llm.tables import stored
from rodovia.llm.word_tokens import WordTokens

SEQUENCE = 2048
_PIECES = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary, "
           "block int, rank bigint")


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """(repetitions, lengths in a bin) that use up ``counts`` (length -> number of pieces) exactly."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out = []
    while True:
        open_ = np.flatnonzero(left)
        if len(open_) == 0:
            return out
        used: dict[int, int] = {}
        gap = capacity
        while gap:
            # Greedy: the longest piece that is left and fits.
            at = int(np.searchsorted(open_, gap, side="right")) - 1
            while at >= 0 and left[open_[at]] <= used.get(int(open_[at]), 0):
                at -= 1
            if at < 0:
                break
            length = int(open_[at])
            take = min(gap // length, int(left[length]) - used.get(length, 0))
            used[length] = used.get(length, 0) + take
            gap -= take * length
        if gap:
            smallest = min(used)
            used[smallest] -= 1
            pair = _best_pair(left, used, open_, gap + smallest)
            if sum(pair) > smallest:
                for length in pair:
                    used[length] = used.get(length, 0) + 1
            else:
                used[smallest] += 1
        used = {k: n for k, n in used.items() if n}
        times = min(int(left[k]) // n for k, n in used.items())
        for k, n in used.items():
            left[k] -= n * times
        out.append((times, [k for k in sorted(used, reverse=True) for _ in range(used[k])]))


def _best_pair(left: np.ndarray, used: dict[int, int], open_: np.ndarray, gap: int) -> tuple[int, ...]:
    """Two unpacked lengths whose sum fills ``gap`` best; () when no two fit."""
    free = left.copy()
    for k, n in used.items():
        free[k] -= n
    lengths = open_[(free[open_] > 0) & (open_ < gap)]
    if len(lengths) == 0:
        return ()
    at = np.searchsorted(lengths, gap - lengths, side="right") - 1
    partner = np.where(at >= 0, lengths[np.maximum(at, 0)], 0)
    same = (partner == lengths) & (free[lengths] < 2)  # the next smaller one instead
    partner = np.where(same, np.where(at > 0, lengths[np.maximum(at - 1, 0)], 0), partner)
    total = np.where(partner > 0, lengths + partner, 0)
    best = int(np.argmax(total))
    return (int(lengths[best]), int(partner[best])) if total[best] else ()


def _cut(file: str | None, size: int, with_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens(file)
        block = TaskContext.get().partitionId()
        seen = [0] * (size + 1)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids = tokens.encode(text.as_py() or "") + b"\0\0\0\0"
                doc_id = doc_id.as_py()
                for piece, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at:at + 4 * size]
                    n = len(part) // 4
                    rows.append((doc_id, piece, at // 4, n, zlib.crc32(part), part if with_ids else None, block, seen[n]))
                    seen[n] += 1
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "block", "rank"])
    return run


def _placer(plan: list[tuple[int, list[int]]]) -> Callable:
    """Give each piece (length, place among its length) its sequence and offset."""
    begin: dict[int, list[int]] = {}
    entry: dict[int, list[tuple[int, list[int]]]] = {}
    passed: dict[int, int] = {}
    number = 0
    for times, lengths in plan:
        offsets: dict[int, list[int]] = {}
        at = 0
        for length in lengths:
            offsets.setdefault(length, []).append(at)
            at += length
        for length, own in offsets.items():
            begin.setdefault(length, []).append(passed.get(length, 0))
            entry.setdefault(length, []).append((number, own))
            passed[length] = passed.get(length, 0) + times * len(own)
        number += times

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = {k: np.array(v) for k, v in begin.items()}
        for batch in batches:
            length, place = batch.column("length").to_numpy(), batch.column("place").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for k in np.unique(length):
                rows = np.flatnonzero(length == k)
                which = np.searchsorted(starts[int(k)], place[rows], side="right") - 1
                for w in np.unique(which):
                    first, own = entry[int(k)][w]
                    mine = rows[which == w]
                    q = place[mine] - starts[int(k)][w]
                    sequence[mine] = first + q // len(own)
                    offset[mine] = np.array(own)[q % len(own)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")]
                + [pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SEQUENCE,
         tokenizer_file: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, ids (if asked for), sequence_id, offset.

    Every row of ``docs`` is a document of its own, also if its doc_id is null or repeated. A null or empty text is
    the closing id alone. Sequences are filled from offset 0 without gaps; only the last place of a sequence may
    stay empty. Other columns are ignored. An empty table gives an empty table.
    """
    docs = docs.select(F.col(doc_id).cast("bigint"), F.col(text).cast("string"))
    pieces = stored(docs.mapInArrow(_cut(tokenizer_file, size, with_ids), _PIECES), "pieces")
    counts = stored(pieces.groupBy("block", "length").agg(F.count("*").alias("n")), "counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    # Rank in the corpus: rows of this length in earlier blocks, then the rank within the block.
    before = F.sum("n").over(Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("block", "length", F.coalesce(before, F.lit(0)).alias("before"))
    # Offsets grow with the number of blocks, so they are not to be broadcast.
    placed = pieces.join(offsets.hint("merge"), ["block", "length"]).withColumn("place", F.col("before") + F.col("rank"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "ids", "place").mapInArrow(
        _placer(patterns(histogram, size)),
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary, "
        "sequence_id bigint, offset bigint")
