"""Ranked lexical search by NRA: sequential reads of impact-sorted postings, without random access.

1. One scan counts, for every document, all its terms and the occurrences of the terms that the items ask for. Sums over
   that table give the number of documents, of terms, and each asked term's document frequency.
2. Documents stay where the scan has put them: a task gathers runs of them into shards of bounded size, each with one
   posting list per term in descending order of impact. For every item NRA reads the lists of its terms block by block. A
   document's lower bound is what has been read of it, its upper bound adds the impact at which each list that has not shown it
   stands. Documents that no list has shown are out once all these together are below the k-th lower bound, candidates once their
   upper bound is; reading goes on until the bounds of all remaining candidates meet, so membership, ties and scores are final.
   The k-th score of earlier shards is where the next one starts.
3. The best of each task are ranked per item.

Nothing but the k best of a task and item is shuffled. Items come in blocks of bounded size, each with a scan of its own. Terms are
compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rodovia.llm.tables import stored
from rodovia.llm.word_hashes import Splitter

K = 10
BLOCK_PAIRS = 1 << 18      # (item, term) pairs that travel to all tasks at once
SHARD_DOCS = 1 << 15
SHARD_POSTINGS = 1 << 22
READ = 256                 # postings of a list in the first round; four times as many in each later one

_SEPARATES = np.ones(256, bool)
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _SEPARATES[_low:_high + 1] = False
_TERMS = Splitter(_SEPARATES, lower=True, seed=20240513)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, term): distinct within a piece of an item's text."""
    for batch in batches:
        for row, raw, offs in _TERMS.slices(batch.column(1)):
            hashed, first = _TERMS.words(raw, offs)
            owner = np.repeat(np.arange(row, row + len(offs) - 1), np.diff(first))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner)), pa.array(hashed.view(np.int64))], ["item_id", "term"])


def _count(vocabulary: np.ndarray) -> Callable:
    """Per document: all its terms, and the asked ones (as places in ``vocabulary``) with their occurrences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(vocabulary)
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for row, raw, offs in _TERMS.slices(batch.column(1)):
                hashed, first = _TERMS.words(raw, offs)
                per_row = np.diff(first)
                n[row:row + len(per_row)] += per_row
                at = np.minimum(np.searchsorted(vocabulary, hashed), size - 1)
                asked = vocabulary[at] == hashed
                owner = np.repeat(np.arange(row, row + len(per_row)), per_row)
                key, count = np.unique(owner[asked] * size + at[asked], return_counts=True)
                keys.append(key)
                counts.append(count)
            # Pieces of one long text add up.
            key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            count = np.bincount(inverse, np.concatenate(counts), len(key)).astype(np.int64)
            offsets = pa.array(np.searchsorted(key, np.arange(batch.num_rows + 1) * size).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.ListArray.from_arrays(offsets, pa.array((key % size).astype(np.int32))),
                 pa.ListArray.from_arrays(offsets, pa.array(count))], ["doc_id", "n", "terms", "tfs"])
    return run


def nra(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int, floor: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of all documents whose score reaches the k-th best one and ``floor``; ties included.

    A list holds distinct documents (numbers below ``n_docs``) and their positive gains in descending order.
    """
    lists = [(d, g) for d, g in lists if len(d)]
    depth = [0] * len(lists)
    lower = np.zeros(n_docs, np.int64)
    step = READ

    def heads() -> np.ndarray:
        """The most that a document not yet shown by a list can still gain from it."""
        return np.array([int(g[at]) if at < len(g) else 0 for (_, g), at in zip(lists, depth)], np.int64)

    def bar(bounds: np.ndarray) -> int:
        return max(floor, int(np.partition(bounds, len(bounds) - k)[len(bounds) - k])) if len(bounds) >= k else floor

    # Unseen documents may still come in.
    while (rest := int((head := heads()).sum())) >= (least := bar(lower)) and rest:
        for t, (docs, gain) in enumerate(lists):
            part = slice(depth[t], depth[t] + step)
            lower[docs[part]] += gain[part]
            depth[t] = min(depth[t] + step, len(docs))
        step *= 4
    # From here on only candidates count.
    candidates = np.flatnonzero(lower + rest >= max(least, 1))
    number = np.full(n_docs, -1, np.int64)
    known = np.zeros((len(lists), len(candidates)), bool)
    number[candidates] = np.arange(len(candidates))
    for t, (docs, _) in enumerate(lists):
        own = number[docs[:depth[t]]]
        known[t, own[own >= 0]] = True
    score = lower[candidates]
    while len(candidates):
        head = heads()
        upper = score + np.where(known, 0, head[:, None]).sum(axis=0)
        keep = upper >= max(1, bar(score))
        if not keep.all():
            number[candidates[~keep]] = -1
            candidates, score, known = candidates[keep], score[keep], known[:, keep]
            number[candidates] = np.arange(len(candidates))
        unread = [t for t in range(len(lists)) if head[t] and not known[t].all()]
        if not unread:
            break
        for t in unread:
            docs, gain = lists[t]
            part = slice(depth[t], depth[t] + step)
            own = number[docs[part]]
            at = np.flatnonzero(own >= 0)
            score[own[at]] += gain[part][at]
            known[t, own[at]] = True
            depth[t] = min(depth[t] + step, len(docs))
        step *= 4
    return candidates, score


def _best(item_ids: np.ndarray, item_terms: list[np.ndarray], weight: np.ndarray, docs: int, terms: int, k: int) -> Callable:
    """The k best documents of a task for each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(item_ids)

        def search(ids: np.ndarray, m: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
            impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
            order = np.lexsort((doc, -impact, term))
            doc, term, gain = doc[order], term[order], weight[term[order]] * impact[order]
            cut = np.searchsorted(term, np.arange(len(weight) + 1))
            for i, own in enumerate(item_terms):
                had, scores = best[i]
                lists = [(doc[cut[t]:cut[t + 1]], gain[cut[t]:cut[t + 1]]) for t in own if weight[t] > 0]
                found, score = nra(lists, len(ids), k, int(scores[-1]) if len(had) == k else 1)
                if len(found):
                    had, scores = np.concatenate([had, ids[found]]), np.concatenate([scores, score])
                    top = np.lexsort((had, -scores))[:k]
                    best[i] = had[top], scores[top]

        held: list[tuple] = []
        for batch in batches:
            for lo in range(0, batch.num_rows, SHARD_DOCS // 8):
                part = batch.slice(lo, SHARD_DOCS // 8)
                held.append((part.column(0).to_numpy(), part.column(1).to_numpy(), part.column(2).value_lengths().to_numpy(),
                             part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy()))
                if sum(len(h[0]) for h in held) >= SHARD_DOCS or sum(len(h[3]) for h in held) >= SHARD_POSTINGS:
                    search(*_shard(held, docs, terms))
                    held = []
        if held:
            search(*_shard(held, docs, terms))
        rows = [(np.full(len(d), item), d, s) for item, (d, s) in zip(item_ids, best) if len(d)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows)], ["item_id", "doc_id", "score"])
    return run


def _shard(held: list[tuple], docs: int, terms: int) -> tuple:
    """Ids and length factors of the documents gathered, and their postings."""
    ids, n, lengths, term, tf = (np.concatenate(c) for c in zip(*held))
    return ids, 10 + (90 * n * docs) // terms, np.repeat(np.arange(len(ids)), lengths), term.astype(np.int64), tf


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", text: str = "text",
                     item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of highest positive score for each item, ties to the smaller id.

    Terms are maximal runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased. An item's terms
    count once each; rows that repeat an item_id are one item with the terms of all of them. Every row of ``docs`` with a
    doc_id is a document of its own, also if it repeats one. Rows with a null id take no part at all. Null texts and texts
    without terms are no documents and match nothing. Other columns are ignored. Empty tables give an empty table.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).filter("doc_id is not null")
    pairs = stored(items.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(item_text).cast("string").alias("text"))
                   .filter("item_id is not null").mapInArrow(_item_terms, "item_id bigint, term bigint").distinct(), "item_terms")
    blocks = -(-pairs.count() // BLOCK_PAIRS)
    schema = "item_id bigint, doc_id bigint, score bigint"
    found = [spark.createDataFrame([], schema)]
    for b in range(blocks):
        own = pairs.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).toArrow()  # about BLOCK_PAIRS rows
        if own.num_rows == 0:
            continue
        vocabulary, term = np.unique(own.column("term").to_numpy().view(np.uint64), return_inverse=True)
        ids, item = np.unique(own.column("item_id").to_numpy(), return_inverse=True)
        order = np.lexsort((term, item))
        item_terms = np.split(term[order], np.flatnonzero(np.diff(item[order])) + 1)
        counted = stored(docs.mapInArrow(_count(vocabulary), "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>")
                         .filter("n > 0"), "term_counts")
        n_docs, n_terms = counted.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            continue
        df = np.zeros(len(vocabulary), np.int64)
        for r in counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():
            df[r["t"]] = r["df"]
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) if x else 0 for x in df], np.int64)
        found.append(stored(counted.mapInArrow(_best(ids, item_terms, weight, n_docs, n_terms, k), schema), "best"))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return (reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
