"""Ordered per-key work cut into time slices, so that no task ever holds a whole key.

A vehicle may own a third of all telemetry. A window partitioned by vehicle alone would put those rows
in one task; here windows run per (key, slice) and only one summary row per slice is ordered per key.
A slice is bounded by the device's message rate times the slice width, whatever the key's total.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

HOUR = 3600


def slice_of(ts: str, seconds: int = HOUR) -> Column:
    return F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / (seconds * 1_000_000))


def with_previous(df: DataFrame, key: str, ts: str, tie: str, columns: Sequence[str],
                  prefix: str = "prev_", seconds: int = HOUR) -> DataFrame:
    """Add the values ``columns`` had on the key's previous row in (ts, tie) order.

    Inside a slice that is a plain lag. The first row of a slice takes the last row of the key's
    previous non-empty slice.
    """
    kept = F.struct(*[F.col(c) for c in columns])
    rows = df.withColumn("_slice", slice_of(ts, seconds))
    inside = Window.partitionBy(key, "_slice").orderBy(ts, tie)
    rows = rows.withColumn("_prev", F.lag(kept).over(inside))
    tails = (df.withColumn("_slice", slice_of(ts, seconds)).groupBy(key, "_slice")
             .agg(F.max_by(kept, F.struct(ts, tie)).alias("_tail")))
    carried = tails.select(key, "_slice", F.lag("_tail").over(
        Window.partitionBy(key).orderBy("_slice")).alias("_carried"))
    joined = rows.join(carried, [key, "_slice"], "left")
    previous = F.coalesce("_prev", "_carried")
    return joined.select(*df.columns, *[previous[c].alias(prefix + c) for c in columns])


def with_sequence(df: DataFrame, key: str, ts: str, tie: str, name: str = "seq",
                  seconds: int = HOUR) -> DataFrame:
    """Number each key's rows 1.. in (ts, tie) order: place in the slice plus rows before the slice."""
    rows = df.withColumn("_slice", slice_of(ts, seconds))
    place = F.row_number().over(Window.partitionBy(key, "_slice").orderBy(ts, tie))
    sizes = (df.withColumn("_slice", slice_of(ts, seconds)).groupBy(key, "_slice")
             .agg(F.count("*").alias("_n")))
    before = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(key, "_slice",
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (rows.withColumn("_place", place).join(starts, [key, "_slice"])
            .select(*df.columns, (F.col("_before") + F.col("_place")).alias(name)))


def with_latest(df: DataFrame, events: DataFrame, key: str, ts: str, at: str, name: str, seconds: int = HOUR) -> DataFrame:
    """Add to every row, as the struct ``name``, the latest of ``events`` of its key that is not after it; null without one.

    ``at`` is the time of an event; of events at the same time the greatest struct counts. Rows and events are swept together
    within (key, slice), and the last event of a slice is carried on to all later slices of the key, so events may reach as far
    as they like without being copied into every slice between.
    """
    columns = [c for c in events.columns if c != key]
    both = (df.withColumns({"_at": F.col(ts).cast("timestamp"), "_row": F.struct(*df.columns), "_event": F.lit(None)})
            .select(key, "_at", "_row", "_event").withColumn("_kind", F.lit(1)))
    shape = F.struct(F.col(at).cast("timestamp").alias("_at"), F.struct(*columns).alias("_value"))
    marks = events.filter(F.col(at).isNotNull() & F.col(key).isNotNull()).select(
        key, F.col(at).cast("timestamp").alias("_at"), F.lit(None).cast(both.schema["_row"].dataType).alias("_row"), shape.alias("_event"),
        F.lit(0).alias("_kind"))
    both = both.withColumn("_event", F.lit(None).cast(marks.schema["_event"].dataType)).unionByName(marks).withColumn("_slice", slice_of("_at", seconds))
    # Events come before rows of the same moment, equal ones in order of their value.
    inside = Window.partitionBy(key, "_slice").orderBy("_at", "_kind", "_event").rowsBetween(Window.unboundedPreceding, 0)
    swept = both.withColumn("_seen", F.last("_event", ignorenulls=True).over(inside))
    tails = both.groupBy(key, "_slice").agg(F.max("_event").alias("_tail"))
    before = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(key, "_slice", F.max("_tail").over(before).alias("_carried"))
    found = F.coalesce("_seen", "_carried")
    return (swept.filter("_kind = 1").join(carried, [key, "_slice"], "left")
            .select("_row.*", found["_value"].alias(name)))
