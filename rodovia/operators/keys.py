"""Dense surrogate keys without a single-partition sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rodovia.session import scratch_path

_ROW_BITS = 33  # monotonically_increasing_id: partition in the high bits, row in the low 33


def assign_keys(df: DataFrame, order: Sequence[str], key: str, start: int = 0) -> DataFrame:
    """Number the rows ``start + 1 ..`` in the order of the unique columns ``order``.

    One range shuffle puts the rows in order; the row's place (partition, position) is written once
    to the shared folder, so the counting pass and the final read see the same places even when an
    executor is lost in between. The driver only holds one count per partition.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "keys")
    placed = (df.repartitionByRange(*[F.col(c) for c in order])
              .sortWithinPartitions(*order)
              .withColumn("_place", F.monotonically_increasing_id()))
    placed.write.parquet(path)
    placed = spark.read.parquet(path)
    part = F.shiftright("_place", _ROW_BITS)
    row = F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1)
    sizes = sorted((r["part"], r["n"]) for r in placed.groupBy(part.alias("part"))
                   .agg(F.count("*").alias("n")).collect())
    first, offsets = start, []
    for number, n in sizes:
        offsets.append((number, first))
        first += n
    if not offsets:
        return placed.select("*", F.lit(None).cast("bigint").alias(key)).drop("_place")
    table = spark.createDataFrame(offsets, "_part bigint, _first bigint")
    # One row per partition of the range shuffle: the broadcast size does not depend on the rows.
    return (placed.withColumn("_part", part)
            .join(F.broadcast(table), "_part")
            .withColumn(key, F.col("_first") + row + 1)
            .drop("_place", "_part", "_first"))
