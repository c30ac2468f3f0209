"""Storage tiers of telemetry: raw readings, and a ladder of second, minute, hour and day parts.

Each rung is computed from the one below. A delivery is rolled up once and added to the days it touches on every rung; other days
are not read. Parts add up, so a delivery may be as late as it likes: it still reaches the rungs whose finer data have expired.
All tables of a delivery are published together, and a delivery that is repeated changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from rodovia.operators.store import TableStore
from rodovia.streaming.parts import START, coarser, parts_of, united

RUNGS = {"segundo": "1 second", "minuto": "1 minute", "hora": "1 hour", "dia": "1 day"}
RAW, LEDGER, DAY = "bruto", "entregas", "_part"


def _day(ts: str):
    return F.col(ts).cast("timestamp_ntz").cast("date").cast("string")


class Tiers:
    """Tables of a store, one partition a day; raw readings one a day and delivery."""

    def __init__(self, store: TableStore):
        self.store = store

    def deliver(self, name: str, rows: DataFrame) -> bool:
        """Add readings under a delivery name; False, and no change, if that name has been delivered."""
        run = self.store.begin()
        if name in run.partitions(LEDGER):
            return False
        rows = rows.filter("ts is not null")
        raw = run.write("_entrega", rows)
        # Raw days of one delivery are partitions of their own: nothing stored before is rewritten.
        run.write_partitions(RAW, raw.withColumn(DAY, F.concat(_day("ts"), F.lit(f"+{name}"))), DAY, set())
        parts = raw
        for rung, length in RUNGS.items():
            parts = parts_of(parts, length) if parts is raw else coarser(parts, length)
            parts = run.write(f"_{rung}", parts)
            dirty = {r[0] for r in parts.select(_day(START)).distinct().collect()}  # bounded by the days of the delivery
            known = run.read(rung, dirty & run.partitions(rung))
            both = parts if known is None else united(parts.unionByName(known.select(parts.columns)))
            run.write_partitions(rung, both.withColumn(DAY, _day(START)), DAY, dirty)
        run.write(LEDGER, self.store.spark.createDataFrame([(name,)], "entrega string"), partition=name)
        for working in ("_entrega", *(f"_{r}" for r in RUNGS)):
            del run.changes[working]
        run.commit()
        return True

    def expire(self, keep_from: Mapping[str, dt.date]) -> dict[str, list[str]]:
        """Drop days before each table's date; the partitions dropped. Only the manifest is read and written."""
        run = self.store.begin()
        gone = {}
        for table, day in keep_from.items():
            gone[table] = sorted(p for p in run.partitions(table) if p[:10] < day.isoformat())
            run.changes[table] = {p: None for p in gone[table]}
        run.commit()
        return gone

    def read(self, table: str, days: set[str] | None = None) -> DataFrame | None:
        """A rung or the raw readings; with ``days`` (ISO dates) only their partitions are opened."""
        manifest = self.store.current()[1]
        wanted = None if days is None else {p for p in manifest.get(table, {}) if p[:10] in days}
        return self.store.read_manifest(manifest, table, wanted)
