"""Running telemetry streams to durable tables, and retention."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rodovia.operators.dedup import latest_per_key
from rodovia.operators.store import TableStore
from rodovia.streaming.telemetry import latest_status, merge_trips, trips


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 1000) -> DataFrame:
    """The parquet files of a folder as they arrive, or of a table that is a single file.

    A path without any parquet file is an error: a stream over nothing would look complete.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if fs.exists(place) and fs.getFileStatus(place).isDirectory():
        found, names = fs.listFiles(place, True), []
        while found.hasNext() and not names:
            name = found.next().getPath().getName()
            names += [name] if not name.startswith(("_", ".")) else []
        folder = reader
    else:
        names = [place.getName()] if fs.exists(place) else []
        folder, path = reader.option("pathGlobFilter", place.getName()), place.getParent().toString()
    if not names:
        raise FileNotFoundError(f"no files to stream in {path}")
    return folder.parquet(path)


def append_table(stream: DataFrame, out: str, checkpoint: str):
    """Append-only sink: the file sink's own log makes it exactly-once across restarts.

    Windows still open when the input ends stay in state until later events close them.
    """
    return (stream.writeStream.format("parquet").outputMode("append")
            .option("path", out).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def update_table(stream: DataFrame, out: str, checkpoint: str):
    """Update-mode sink: each micro-batch overwrites its own folder, so a replay changes nothing."""
    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (stream.writeStream.outputMode("update").foreachBatch(save)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def current(spark: SparkSession, out: str, keys: Sequence[str]) -> DataFrame:
    """Final state of an update-mode table: the last version of each key."""
    updates = spark.read.option("basePath", out).parquet(out)
    return latest_per_key(updates, keys, newest="batch").drop("batch")


def keep_latest_status(stream: DataFrame, store: TableStore, checkpoint: str, table: str = "status_frota", buckets: int = 64):
    """Upsert the newest reading per vehicle after every micro-batch.

    The table is hashed into a fixed number of buckets, each published by itself: a micro-batch reads and rewrites only the
    buckets in which one of its vehicles has something newer. Taking the newest of old and new is idempotent, so a replayed
    batch rewrites nothing.
    """
    bucket = F.pmod(F.xxhash64("vehicle"), F.lit(buckets)).cast("int")

    def save(batch: DataFrame, number: int) -> None:
        run = store.begin()
        fresh = run.write("_novos", latest_status(batch).withColumn("_part", bucket))
        del run.changes["_novos"]
        held = {str(r[0]) for r in fresh.select("_part").distinct().collect()}  # at most ``buckets``
        known = run.read(table, held & run.partitions(table))
        if known is not None:
            before = known.select("vehicle", F.struct("ts", "event_id").alias("_known"))
            fresh = fresh.join(before, "vehicle", "left").filter("_known is null or struct(ts, event_id) > _known").drop("_known")
            touched = {str(r[0]) for r in fresh.select("_part").distinct().collect()}
            old = run.read(table, touched & run.partitions(table))
            fresh = fresh if old is None else fresh.unionByName(old.withColumn("_part", bucket))
        else:
            touched = held
        if touched:
            run.write_partitions(table, latest_status(fresh).withColumn("_part", bucket), "_part", touched)
            run.commit()

    return (stream.writeStream.outputMode("update").foreachBatch(save)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def route(stream: DataFrame, store: TableStore, checkpoint: str, routes: Mapping[str, Callable[[DataFrame], DataFrame]],
          ledger: str = "lotes", gather: int = 100):
    """Several tables from one reading of a stream, each micro-batch in all of them or in none.

    A micro-batch is read once into the store, the tables are written from there, and they are published together with the
    batch's entry in ``ledger``. A batch that broke off between two tables left nothing that anybody sees; one that is
    replayed after its publication is recognised by its entry. Every ``gather`` batches become one partition.
    """
    def save(batch: DataFrame, number: int) -> None:
        run = store.begin()
        done = run.read(ledger)
        if done is not None and not done.filter(F.col("lote") >= number).isEmpty():
            return
        rows = run.write("_lote", batch)
        del run.changes["_lote"]
        name = f"{number:012d}"
        for table, build in routes.items():
            run.write(table, build(rows), partition=name)
            small = sorted(p for p in run.partitions(table) if len(p) == 12)
            if len(small) >= gather:
                run.write(table, run.read(table, set(small)), partition=f"{small[0]}-{small[-1]}")
                run.changes[table].update({p: None for p in small})
        run.write(ledger, store.spark.createDataFrame([(number,)], "lote bigint"))
        run.commit()

    return (stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def open_trips(spark: SparkSession, checkpoint: str, gap: str = "30 minutes") -> DataFrame:
    """The trips in progress of a :func:`telemetry.trips` query, from its state: no reading is read again.

    The state of a session has its window, which ends ``gap`` after the last reading, and the buffers of the aggregates.
    """
    state = spark.read.format("statestore").load(checkpoint)
    fields = state.schema["value"].dataType.fields
    # Buffers are named after their functions, so names repeat: number them.
    value = F.col("value").cast(T.StructType([T.StructField(f"f{i}", f.dataType) for i, f in enumerate(fields)]))

    def buffer(name: str, kind: type) -> Column:
        at = next(i for i, f in enumerate(fields) if f.name == name and isinstance(f.dataType, kind))
        return value.getField(f"f{at}")

    window = buffer("session_window", T.StructType)
    return state.select(F.col("key.vehicle").alias("vehicle"), window["start"].cast("timestamp_ntz").alias("inicio"),
                        (window["end"] - F.expr(f"INTERVAL {gap}")).cast("timestamp_ntz").alias("fim"),
                        buffer("count", T.LongType).alias("mensagens"), buffer("max", T.DecimalType).alias("velocidade_max"))


def trip_table(stream: DataFrame, out: str, checkpoint: str, gap: str = "30 minutes"):
    """Trips of each micro-batch, one folder a batch, so a replay changes nothing.

    No row is ever late here: a micro-batch knows only parts of a trip, and :func:`finished_trips` unites parts.
    """
    def save(batch: DataFrame, number: int) -> None:
        trips(batch, gap).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def finished_trips(spark: SparkSession, out: str, gap: str = "30 minutes") -> DataFrame:
    """The trips of all micro-batches together, open ones included."""
    return merge_trips(spark.read.option("basePath", out).parquet(out).drop("batch"), gap)


def finish(query, timeout: int | None = None) -> None:
    """Wait for an available-now query, as long as it takes unless the caller sets a limit, and surface its failure."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError("stream did not finish in time")


def archive_by_day(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write telemetry partitioned by day, the unit retention drops."""
    (df.withColumn("dia", F.col("ts").cast("timestamp_ntz").cast("date")).hint("rebalance", "dia")
     .write.mode(mode).partitionBy("dia").parquet(path))


def expire_days(spark: SparkSession, path: str, keep_from: dt.date,
                before_drop: Callable[[DataFrame], None] | None = None) -> list[str]:
    """Drop day partitions older than ``keep_from``; ``before_drop`` may roll them up first.

    Only folder names are listed; nothing is rewritten.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    days = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith("dia=")]
    old = [p for p in days if p.getName()[len("dia="):] < keep_from.isoformat()]
    if old and before_drop is not None:
        before_drop(spark.read.option("basePath", path).parquet(*[p.toString() for p in old]))
    for p in old:
        fs.delete(p, True)
    return sorted(p.getName() for p in old)
