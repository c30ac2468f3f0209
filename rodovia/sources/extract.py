"""Full and incremental extraction into staging, one source at a time."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from rodovia.operators.store import TableStore
from rodovia.schemas import EXTRACTION_LOG, STAGING, STAGING_KEYS, to_schema
from rodovia.sources.mappings import MAPPINGS, Options

log = logging.getLogger(__name__)

OVERLAP = dt.timedelta(hours=1)
FIRST_WINDOW = dt.timedelta(days=7)


class DuplicateKeys(Exception):
    """A mapping produced two rows for one staging key."""


@dataclass(frozen=True)
class Outcome:
    source: int
    ok: bool
    rows: Mapping[str, int]
    error: str | None = None


def marks_from_log(entries: DataFrame) -> DataFrame:
    """Latest successful load per (source, table): the only part of the log that sets a window."""
    return (entries.filter("status = 'OK'").groupBy("grupo_fonte", "tabela_stg")
            .agg(F.max("dt_extracao").alias("ultima")))


def high_water_marks(entries: DataFrame | None, source: int,
                     run_ts: dt.datetime) -> dict[str, dt.datetime]:
    """Lower bound per table with a successful load: that load's time less the overlap."""
    if entries is None:
        return {}
    rows = marks_from_log(entries.filter(F.col("grupo_fonte") == source)).collect()  # <= 10 tables
    return {r["tabela_stg"]: r["ultima"] - OVERLAP for r in rows}


def mark_for(table: str, marks: Mapping[str, dt.datetime], run_ts: dt.datetime) -> dt.datetime:
    return marks.get(table, run_ts - FIRST_WINDOW)


def staging_rows(df: DataFrame, entity: str, source: int, run_ts: dt.datetime) -> DataFrame:
    """Tag with the source and load time, and widen to the staging schema."""
    tagged = (df.withColumn("grupo_fonte", F.lit(source).cast("smallint"))
              .withColumn("dt_extracao", F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")))
    return to_schema(tagged, STAGING[entity])


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("ocorrencias")).filter("ocorrencias > 1")


def source_frames(source: int, tables, marks: Mapping[str, dt.datetime], run_ts: dt.datetime,
                  options: Options = Options()) -> dict[str, DataFrame]:
    """The staging rows of every entity of a source, not yet written."""
    return {
        m.entity: staging_rows(
            m.frame(tables, options, mark_for(m.entity, marks, run_ts) if m.incremental else None),
            m.entity, source, run_ts)
        for m in MAPPINGS[source]
    }


class Log:
    """Append-only extraction log next to the staging tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/log_extracao"

    def read(self) -> DataFrame | None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return None
        return self.spark.read.schema(EXTRACTION_LOG).parquet(self.path)

    def append(self, rows) -> None:
        (self.spark.createDataFrame(rows, EXTRACTION_LOG).coalesce(1)
         .write.mode("append").parquet(self.path))


def extract_source(store: TableStore, source: int, tables, run_ts: dt.datetime,
                   options: Options = Options()) -> Outcome:
    """Replace one source's slice of staging, or nothing at all when any of its tables fails."""
    history = Log(store.spark, store.root)
    try:
        marks = high_water_marks(history.read(), source, run_ts)
        run = store.begin()
        counts = {}
        for entity, frame in source_frames(source, tables, marks, run_ts, options).items():
            written = run.write(entity, frame, partition=str(source))
            counts[entity] = run.rows[entity]
            clash = duplicate_keys(written, STAGING_KEYS[entity])
            some = clash.limit(3).collect()
            if some:
                raise DuplicateKeys(f"{entity}: {clash.count()} repeated key(s), such as {[tuple(r) for r in some]}")
        run.commit()
    except Exception as failure:  # one source must not stop the others
        message = " ".join(str(failure).split())[:200]
        log.warning("extraction of source %s failed: %s", source, message)
        history.append([(source, f"GRUPO_{source}", run_ts, 0, "ERR", message)])
        return Outcome(source, False, {}, message)
    history.append([(source, t, run_ts, n, "OK", None) for t, n in counts.items()])
    return Outcome(source, True, counts)


def extract_all(store: TableStore, sources: Mapping[int, object], run_ts: dt.datetime,
                options: Options = Options()) -> list[Outcome]:
    return [extract_source(store, n, tables, run_ts, options) for n, tables in sources.items()]
