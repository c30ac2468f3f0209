"""Intermediate tables in the shared folder, and iteration over sorted groups in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rodovia.session import release as release, scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write the rows once to the shared folder and read them back: a lost executor repeats a read."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Whole groups of rows with equal keys from a partition sorted by those (non-null integer) keys."""
    pending: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        values = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for v in values:
            change[1:] |= v[1:] != v[:-1]
        change[0] = last is None or any(v[0] != x for v, x in zip(values, last))
        last = [v[-1] for v in values]
        cuts = np.flatnonzero(change)
        begin = 0
        for cut in cuts:
            if cut > begin:
                pending.append(batch.slice(begin, cut - begin))
            if pending:
                yield pa.Table.from_batches(pending)
                pending = []
            begin = cut
        pending.append(batch.slice(begin))
    if pending:
        yield pa.Table.from_batches(pending)


def fixed_binary(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """A binary column whose values all have ``width`` bytes, as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    n = len(column)
    if n == 0:
        return np.zeros((0, width), np.uint8)
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offs = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + n + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offs[0]:offs[-1]].reshape(n, width)
