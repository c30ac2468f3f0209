"""Strict order per vehicle on a stream.

A vehicle's readings wait in keyed state until the watermark has passed them; a timer then releases them in order with their
numbers. What a vehicle holds is bounded by its message rate and the watermark delay. Readings that come later than that are not
dropped: they leave at once, without a number, for a table of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Spark drops rows older than the watermark in front of keyed state. The watermark therefore runs on the reading's time
#: plus this many seconds, with a delay longer by as much: the same watermark, but no row is ever older.
_AHEAD = 200 * 365 * 86400
_OUT = "vehicle bigint, event_id bigint, micros bigint, seq bigint, late boolean"
_STATE = "seen bigint, until bigint, micros binary, ids binary"


def _release(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    if state.exists:
        seen, until, micros, ids = state.get
        micros, ids = np.frombuffer(micros, np.int64), np.frombuffer(ids, np.int64)
    else:
        seen = until = None
        micros = ids = np.zeros(0, np.int64)
    known = max(0, state.getCurrentWatermarkMs()) * 1000
    late = []
    for part in rows:
        if seen is None:
            seen, until = int(part["base"].iloc[0]), int(part["until"].iloc[0])
        us, own = part["micros"].to_numpy(np.int64), part["event_id"].to_numpy(np.int64)
        on_time = us >= max(known, until)
        late += [(us[~on_time], own[~on_time])]
        micros, ids = np.concatenate([micros, us[on_time]]), np.concatenate([ids, own[on_time]])
    for us, own in late:
        if len(us):
            yield pd.DataFrame({"vehicle": key[0], "event_id": own, "micros": us, "seq": pd.array([None] * len(us), "Int64"), "late": True})
    order = np.lexsort((ids, micros))
    micros, ids = micros[order], ids[order]
    ready = int(np.searchsorted(micros, known, "left"))
    if ready:
        yield pd.DataFrame({"vehicle": key[0], "event_id": ids[:ready], "micros": micros[:ready],
                            "seq": pd.array(np.arange(seen + 1, seen + ready + 1), "Int64"), "late": False})
        seen, until = seen + ready, int(micros[ready - 1])
    state.update((seen, until, micros[ready:].tobytes(), ids[ready:].tobytes()))
    if ready < len(micros):
        state.setTimeoutTimestamp(int(micros[ready]) // 1000 + 1)


def in_order(stream: DataFrame, delay_seconds: int = 600, begun: DataFrame | None = None) -> DataFrame:
    """(vehicle, event_id, micros, seq, late) as readings become final; seq counts a vehicle's readings by (ts, event_id).

    ``begun`` (vehicle, base, until) continues a history: ``base`` readings of the vehicle are numbered already, the last of
    them at ``until`` microseconds, and readings before that are late. A reading without time or vehicle has no order and is
    left out.
    """
    rows = stream.filter("ts is not null and vehicle is not null").select("vehicle", "event_id", "ts", F.unix_micros("ts").alias("micros"))
    if begun is not None:
        rows = rows.join(begun, "vehicle", "left")
    else:
        rows = rows.withColumns({"base": F.lit(None).cast("bigint"), "until": F.lit(None).cast("bigint")})
    rows = rows.select("vehicle", "event_id", "micros", F.coalesce("base", F.lit(0)).alias("base"), F.coalesce("until", F.lit(0)).alias("until"),
                       (F.col("ts") + F.expr(f"make_dt_interval(0, 0, 0, {_AHEAD})")).alias("mark"))
    return (rows.withWatermark("mark", f"{_AHEAD + delay_seconds} seconds").groupBy("vehicle")
            .applyInPandasWithState(_release, _OUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout))
