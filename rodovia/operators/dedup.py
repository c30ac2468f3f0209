"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: str = "dt_extracao",
                   tie_break: Sequence[str] | None = None) -> DataFrame:
    """Keep the newest row of each key.

    Ties are broken by every remaining column, so the result does not depend on row order. The
    ``= 1`` filter right above the window makes Spark plan a WindowGroupLimit: each map task keeps
    one row per key before the shuffle, so a key with a third of all rows is cut down in place.
    """
    rest = list(tie_break) if tie_break is not None else [
        c for c in df.columns if c not in keys and c != newest]
    order = [F.col(newest).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in rest]]
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rn = 1").drop("_rn")
