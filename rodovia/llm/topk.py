"""Exact inner-product search by term-at-a-time accumulation.

Vectors become integer rows, packed into matrices. Within a task, candidates are turned into postings: for each component,
the places and weights of the candidates where it is not 0. Each non-zero component of a query scatters its weight
times these weights into the dense score row of the query; a partition selection keeps the best of some thousand candidates, and
the best of all are merged. Queries are cut into parts and candidates into blocks of bounded size; every part is dealt out
to every block, so each query meets each candidate once and results are exact. Nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window, functions as F

from rodovia.llm.tables import sorted_groups, stored

SCALE = 256
BLOCK_VALUES = 1 << 20  # numbers in a part of the queries, and in a block of candidates
PACKED = 1 << 15        # numbers of a row of the tables that are dealt out
CANDIDATES = 2048       # at once in a score array
QUERIES = 256


def _vectors(frame: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """Rows that take part: an id and a non-empty vector of finite numbers, as integers."""
    v = F.col("v")
    return (frame.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
            .filter(v.isNotNull() & F.col("vec_id").isNotNull() & (F.size(v) > 0))
            .filter(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))))


def _integers(values: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * values)


def _rows(column: pa.Array) -> list[np.ndarray]:
    offs = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    return [flat[offs[i]:offs[i + 1]] for i in range(len(column))]


def _accumulate(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Scores of all queries (rows) and candidates (columns), component by component."""
    most = np.abs(queries).max(initial=0) * np.abs(candidates).max(initial=0) * max(1, queries.shape[1])
    if most < 2 ** 24:
        kind = np.float32  # sums of integers below 2^24 are exact
    elif most < 2 ** 53:
        kind = np.float64
    else:  # beyond the integers of a double: Python's own
        exact = np.array([[sum(int(a) * int(b) for a, b in zip(q, c)) for c in candidates] for q in queries], object)
        return np.clip(exact, -2 ** 63, 2 ** 63 - 1).astype(np.int64).reshape(len(queries), len(candidates))
    scores = np.zeros((len(queries), len(candidates)), kind)
    queries, candidates = queries.astype(kind), candidates.astype(kind)
    for term in range(queries.shape[1]):
        posting = np.flatnonzero(candidates[:, term])
        weight = candidates[posting, term]
        asking = np.flatnonzero(queries[:, term])
        if len(posting) == len(candidates) and len(asking) == len(queries):
            scores += queries[:, term, None] * weight[None, :]
        elif len(posting) and len(asking):
            scores[np.ix_(asking, posting)] += queries[asking, term, None] * weight[None, :]
    return scores.astype(np.int64)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d, ids, vectors): matrices of integer rows of one length, of about PACKED numbers."""
    held: dict[int, list] = {}

    def packed(d: int) -> pa.RecordBatch:
        ids, vectors = zip(*held.pop(d))
        return pa.RecordBatch.from_arrays(
            [pa.array([d], pa.int32()), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
             pa.array([_integers(np.stack(vectors)).tobytes()], pa.binary())], ["d", "ids", "vectors"])

    for batch in batches:
        for vec_id, v in zip(batch.column(0).to_pylist(), _rows(batch.column(1))):
            own = held.setdefault(len(v), [])
            own.append((vec_id, v))
            if len(own) * len(v) >= PACKED:
                yield packed(len(v))
    for d in list(held):
        yield packed(d)


def _unpacked(rows: pa.Table, d: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.concatenate([np.frombuffer(b.as_py(), np.int64) for b in rows.column("ids")])
    return ids, np.concatenate([np.frombuffer(b.as_py(), np.float64) for b in rows.column("vectors")]).reshape(len(ids), d)


def _meet(k: int) -> Callable:
    """The best k candidates of each group for each query that meets it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["part", "block", "d"]):
            d = group.column("d")[0].as_py()
            asking = pa.compute.equal(group.column("asks"), True)
            queries, candidates = group.filter(asking), group.filter(pa.compute.invert(asking))
            if len(queries) and len(candidates):
                yield from _best(*_unpacked(queries, d), *_unpacked(candidates, d), k)
    return run


def _best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, candidates: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    kept_id = np.zeros((len(query_ids), 0), np.int64)
    kept_score = np.zeros((len(query_ids), 0), np.int64)
    kept_real = np.zeros((len(query_ids), 0), bool)
    for at in range(0, len(ids), CANDIDATES):
        matrix, own_ids = candidates[at:at + CANDIDATES], ids[at:at + CANDIDATES]
        new_id, new_score, new_real = [], [], []
        for q in range(0, len(query_ids), QUERIES):
            for row, score in enumerate(_accumulate(queries[q:q + QUERIES], matrix)):
                pick = np.flatnonzero(own_ids != query_ids[q + row])
                if len(pick) > k:
                    mine = score[pick]
                    bar = np.partition(mine, len(mine) - k)[len(mine) - k]
                    pick = pick[mine >= bar]
                pick = pick[np.lexsort((own_ids[pick], -score[pick]))[:k]]
                pad = k - len(pick)
                new_id.append(np.pad(own_ids[pick], (0, pad)))
                new_score.append(np.pad(score[pick], (0, pad)))
                new_real.append(np.pad(np.ones(len(pick), bool), (0, pad)))
        kept_id = np.concatenate([kept_id, np.stack(new_id)], axis=1)
        kept_score = np.concatenate([kept_score, np.stack(new_score)], axis=1)
        kept_real = np.concatenate([kept_real, np.stack(new_real)], axis=1)
        order = np.lexsort((kept_id, -kept_score, ~kept_real), axis=1)[:, :k]
        kept_id, kept_score, kept_real = (np.take_along_axis(x, order, 1) for x in (kept_id, kept_score, kept_real))
    row, col = np.nonzero(kept_real)
    if len(row):
        yield pa.RecordBatch.from_arrays([pa.array(query_ids[row]), pa.array(kept_id[row, col]), pa.array(kept_score[row, col])],
                                         ["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query with the other rows.

    Queries are the rows whose id is divisible by ``every``; all rows but those with the query's id are candidates.
    Components become floor(256 x); equal scores are ranked by the smaller id, and there are fewer than k rows if
    there are fewer candidates. Rows with a null id, and vectors that are null, empty or hold a null or non-finite number,
    take no part; vectors of different lengths have no inner product. A query id that is repeated asks once, with its
    first vector in order; repeated candidates rank as rows of their own. Scores beyond 64 bits are clipped to them.
    Other columns are ignored, whatever their names. An empty table gives an empty table.
    """
    spark = vectors.sparkSession
    rows = _vectors(vectors, vec_id, vector)
    asked = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    packed = "d int, ids binary, vectors binary"
    queries = stored(asked.mapInArrow(_pack, packed), "queries")
    candidates = stored(rows.mapInArrow(_pack, packed), "candidates")

    def numbers(df: DataFrame) -> int:
        return df.agg(F.sum(F.octet_length("vectors"))).first()[0] // 8 if not df.isEmpty() else 0

    # Every part of the queries meets every block of the candidates once, each pair in a place of its own.
    parts = max(1, -(-numbers(queries) // BLOCK_VALUES))
    blocks = max(1, -(-numbers(candidates) // BLOCK_VALUES), min(candidates.count(), spark.sparkContext.defaultParallelism))
    mine = F.xxhash64("ids")
    left = queries.select("*", F.lit(True).alias("asks"), F.pmod(mine, F.lit(parts)).cast("int").alias("part"),
                          F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = candidates.select("*", F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
                              F.pmod(mine, F.lit(blocks)).cast("int").alias("block"))
    pairs = left.unionByName(right).repartition(parts * blocks, "part", "block").sortWithinPartitions("part", "block", "d")
    found = pairs.mapInArrow(_meet(k), "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int"), "vec_id", "score"))
