"""Mergeable partial aggregates of telemetry: counts, sums and extremes per period, which add up in any order.

A part may come from raw readings, from finer parts, or from parts of the same period that arrived separately (history and live
feed, an archive and a late delivery). Means are only formed when parts are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SPEED = "decimal(12,2)"
TOTAL = "decimal(28,2)"
START = "inicio"


def measures(slow: float = 10) -> list[Column]:
    """What a part holds, from raw readings."""
    return [F.count("*").alias("mensagens"), F.sum("speed").cast(TOTAL).alias("soma"),
            F.min("speed").alias("velocidade_min"), F.max("speed").alias("velocidade_max"),
            F.count_if("critical").alias("criticas"), F.count_if(F.col("speed") < slow).alias("lentas")]


def merged() -> list[Column]:
    """The same from parts."""
    return [F.sum("mensagens").alias("mensagens"), F.sum("soma").cast(TOTAL).alias("soma"),
            F.min("velocidade_min").alias("velocidade_min"), F.max("velocidade_max").alias("velocidade_max"),
            F.sum("criticas").alias("criticas"), F.sum("lentas").alias("lentas")]


def _started(grouped: DataFrame, by: Sequence[str]) -> DataFrame:
    rest = [c for c in grouped.columns if c not in ("window", *by)]
    return grouped.select(F.col("window.start").cast("timestamp_ntz").alias(START), *by, *rest)


def parts_of(rows: DataFrame, length: str, slide: str | None = None, by: Sequence[str] = ("vehicle",), slow: float = 10) -> DataFrame:
    """Parts per window and group, of a batch or (with a watermark) a stream of readings."""
    frame = F.window("ts", length, slide) if slide else F.window("ts", length)
    return _started(rows.groupBy(frame, *by).agg(*measures(slow)), by)


def coarser(parts: DataFrame, length: str, by: Sequence[str] = ("vehicle",)) -> DataFrame:
    """Parts of longer periods from parts of shorter ones that fit into them."""
    return _started(parts.groupBy(F.window(START, length), *by).agg(*merged()), by)


def united(parts: DataFrame, by: Sequence[str] = ("vehicle",)) -> DataFrame:
    """One part per period and group from parts that arrived separately."""
    return parts.groupBy(START, *by).agg(*merged())


def mean_speed() -> Column:
    return F.round(F.col("soma") / F.col("mensagens").cast("decimal(20,0)"), 2).cast(SPEED).alias("velocidade_media")
