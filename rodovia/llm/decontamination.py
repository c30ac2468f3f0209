"""Benchmark items inside documents: size-partitioned MinHash containment search, verified exactly.

Short items drown in the MinHash of a long document, so sizes are partitioned on both sides: items by the power of
two of their shingle count q, and a document's shingles, for each of these classes, into pieces of at most 2q. A
piece and an item then differ in size by a bounded factor, and 64 single-row bands find an item of which three
quarters lie in the document with probability 1 - exp(-16), wherever its shingles lie: the expected number of
agreeing coordinates depends on the number of shared shingles, not on how pieces cut them. Items below eight
shingles form a class whose pieces are single shingles, so their search is exact. Longer pieces' minima are minima of
shorter ones'. Each candidate is verified on the document's whole set.

Equal items are searched as one. They are taken in blocks of bounded size, each shipped to all tasks that scan the documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from rodovia.llm.near_dedup import _permute
from rodovia.llm.shingles import sequences, shingle_sets, text_slices, words
from rodovia.llm.tables import stored

COORDINATES = 64
CONTAINMENT = 75  # percent
SMALLEST = 8      # shingles; smaller items are looked up shingle by shingle
BLOCK_SHINGLES = 250_000
_FILTER_BITS = 20
_CHUNK = 1 << 16


def _item_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = list(shingle_sets(batch.column(1)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(s) for _, s in found], pa.int64()),
             pa.array([s.tobytes() for _, s in found], pa.binary())], ["item_id", "n", "hashes"])


def _minima(base: np.ndarray, width: int) -> np.ndarray:
    """Coordinates (rows) of pieces of ``width`` consecutive shingles (columns)."""
    pieces = -(-len(base) // width)
    padded = np.full(pieces * width, base[-1], np.uint32)
    padded[:len(base)] = base
    # All coordinates of some pieces at once; the places within a piece are the middle axis, so minima run along memory.
    across = np.ascontiguousarray(padded.reshape(pieces, width).T)
    shifts = np.arange(COORDINATES, dtype=np.uint32)[:, None, None]
    out = np.empty((COORDINATES, pieces), np.uint32)
    step = max(1, _CHUNK // (COORDINATES * width))
    for i in range(0, pieces, step):
        x = across[None, :, i:i + step] + shifts
        out[:, i:i + step] = _permute(x, np.empty_like(x), 0x21F0AAAD, 0xD35A2D97).min(axis=1)
    return out


def _base(hashes: np.ndarray) -> np.ndarray:
    base = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    return _permute(base, np.empty_like(base), 0x7FEB352D, 0x846CA68B)


class _Keys:
    """Sorted (key, item) pairs behind a small bit table."""

    def __init__(self, keys: np.ndarray, items: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, self.items = keys[order], items[order]
        self.bits = np.zeros(1 << _FILTER_BITS, bool)
        self.bits[keys & np.uint64((1 << _FILTER_BITS) - 1)] = True

    def find(self, probe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in probe, item) of all equal keys."""
        at = np.flatnonzero(self.bits[probe & np.uint64((1 << _FILTER_BITS) - 1)])
        lo = np.searchsorted(self.keys, probe[at], "left")
        n = np.searchsorted(self.keys, probe[at], "right") - lo
        pick = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum())) if len(n) else lo
        return np.repeat(at, n), self.items[pick]


def _coordinate_keys(minima: np.ndarray) -> np.ndarray:
    k = np.arange(len(minima), dtype=np.uint64)[:, None] << np.uint64(32)
    mixed = (minima.astype(np.uint64) | k) * np.uint64(0x9E3779B97F4A7C15)
    return mixed ^ (mixed >> np.uint64(29))


def _search(set_ids: list, sets: list[np.ndarray], clean: bool = False) -> Callable:
    """Find and verify the sets of one block in every document.

    ``clean``: give the first column of the rows that hold none of them, instead of pairs.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = np.array([len(s) for s in sets])
        small = np.flatnonzero(size < SMALLEST)
        lookup = _Keys(np.concatenate([sets[i] for i in small]), np.repeat(small, size[small])) if len(small) else None
        classes: dict[int, _Keys] = {}
        for q in sorted({1 << (int(n).bit_length() - 1) for n in size if n >= SMALLEST}):
            own = np.flatnonzero((size >= q) & (size < 2 * q))
            minima = np.concatenate([_minima(_base(sets[i]), len(sets[i])) for i in own], axis=1)
            classes[q] = _Keys(_coordinate_keys(minima).ravel(), np.tile(own, COORDINATES))
        for batch in batches:
            doc, item, common = [], [], []
            for row, raw, offs in text_slices(batch.column(1)):
                seq, begin = sequences(*words(raw, offs))
                heads = begin[:-1]
                candidates = []
                if lookup is not None and len(seq):
                    at, found = lookup.find(seq)
                    candidates.append((np.searchsorted(heads, at, "right") - 1, found))
                if classes and len(seq):
                    # Pieces may not cross documents: minima per document, from the shortest width on.
                    for k in np.flatnonzero(np.diff(begin) > 0):
                        minima, width = None, 2 * SMALLEST
                        base = _base(seq[begin[k]:begin[k + 1]])
                        minima = _minima(base, width)
                        for q, keys in classes.items():
                            while width < 2 * q and minima.shape[1] > 1:
                                if minima.shape[1] % 2:
                                    minima = np.concatenate([minima, minima[:, -1:]], axis=1)
                                minima = np.minimum(minima[:, 0::2], minima[:, 1::2])
                                width *= 2
                            _, found = keys.find(_coordinate_keys(minima).ravel())
                            candidates.append((np.full(len(found), k), found))
                if candidates:
                    pairs = np.unique(np.stack([np.concatenate([c[j] for c in candidates]) for j in (0, 1)]), axis=1)
                    for k, i in pairs.T:
                        n = int(np.isin(sets[i], seq[begin[k]:begin[k + 1]]).sum())
                        if 100 * n >= CONTAINMENT * len(sets[i]):
                            doc.append(row + k)
                            item.append(i)
                            common.append(n)
            if clean:
                keep = np.ones(batch.num_rows, bool)
                keep[doc] = False
                yield batch.select([0]).filter(pa.array(keep))
            elif doc:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(doc)), pa.array([set_ids[i] for i in item], pa.int64()),
                     pa.array([len(sets[i]) for i in item], pa.int64()), pa.array(common, pa.int64())],
                    ["doc_id", "set_id", "n_shingles", "n_common"])
    return run


def contained_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_shingles, n_common): at least 75 % of the item's distinct five-word shingles are in the text.

    Rows are judged one by one: repeated rows give repeated results, and ids may be null. Null texts and texts without
    words match nothing. Other columns are ignored. Empty tables give an empty table.
    """
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sets = _item_table(items, item_id, item_text)
    schema = "doc_id bigint, set_id bigint, n_shingles bigint, n_common bigint"
    found = docs.sparkSession.createDataFrame([], schema)
    for ids, own in _blocks(sets):
        # Written before the next block is fetched, so that one block at a time is held.
        found = found.unionByName(stored(docs.mapInArrow(_search(ids, own), schema), "found"))
    return found.join(sets.select("set_id", "item_id"), "set_id").select("doc_id", "item_id", "n_shingles", "n_common")


def without_items(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item; nothing is shuffled.

    Null texts and texts without words hold none. Ids play no part. Empty tables of documents or items leave all rows.
    """
    columns = docs.columns
    for ids, sets in _blocks(_item_table(items, item_id, item_text)):
        rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{text}`").cast("string").alias("t"))
        kept = rows.mapInArrow(_search(ids, sets, clean=True), T.StructType([rows.schema["row"]]))
        docs = kept.select(*[F.col("row").getField(c).alias(c) for c in columns])
    return docs


def _item_table(items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """(item_id, n, hashes, set_id): the items with words; equal sets of shingles have the same set_id."""
    return stored(items.select(F.col(item_id).cast("bigint"), F.col(item_text).cast("string"))
                  .mapInArrow(_item_sets, "item_id bigint, n bigint, hashes binary").filter("n > 0")
                  .withColumn("set_id", F.xxhash64("hashes")), "items")


def _blocks(sets: DataFrame) -> Iterator[tuple[list, list[np.ndarray]]]:
    """The distinct sets in blocks of about BLOCK_SHINGLES shingles: copies of an item are searched once."""
    distinct = stored(sets.groupBy("set_id").agg(F.first("n").alias("n"), F.first("hashes").alias("hashes")), "sets")
    blocks = -(-(distinct.agg(F.sum("n")).first()[0] or 0) // BLOCK_SHINGLES)
    for b in range(blocks):
        rows = distinct.filter(F.pmod(F.xxhash64(F.lit(1), "set_id"), F.lit(blocks)) == b).collect()
        if rows:
            yield [r["set_id"] for r in rows], [np.frombuffer(r["hashes"], np.uint64) for r in rows]
