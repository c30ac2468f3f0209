"""Exact distinct counts of several expressions in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

SPLITS = 64


def distinct_counts(df: DataFrame, expressions: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """(``by``, expressao, qtd): distinct non-null values of every expression, over all rows or per group.

    The table is read once, whatever the number of expressions. Values meet by their hash, so a value that a third of the rows
    share leaves each map task as one row; the distinct values of an expression are then counted in SPLITS parts and these added
    up, so an expression with very many values fills no single task. A group that has no value of an expression counts 0.
    """
    values = F.explode(F.array(*[F.struct(F.lit(n).alias("expressao"), e.cast("string").alias("_v")) for n, e in expressions.items()]))
    found = df.select(*by, values.alias("x")).select(*by, "x.*").groupBy(*by, "expressao", "_v").agg(F.lit(1).alias("_one"))
    split = F.pmod(F.xxhash64("_v"), F.lit(SPLITS))
    parts = found.groupBy(*by, "expressao", split.alias("_split")).agg(F.count("_v").alias("_n"))
    counted = parts.groupBy(*by, "expressao").agg(F.sum("_n").alias("qtd"))
    if by:
        return counted
    # Without groups an empty table still has its zeros.
    names = df.sparkSession.createDataFrame([(n,) for n in expressions], "expressao string")
    return names.join(counted, "expressao", "left").select("expressao", F.coalesce("qtd", F.lit(0)).alias("qtd"))
