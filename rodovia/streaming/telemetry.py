"""Telemetry transformations. Each takes a batch or a streaming frame of the shape of
:func:`telemetry` and stays declarative, so both kinds share one code path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rodovia.functions import rules as R
from rodovia.operators.dedup import latest_per_key
from rodovia.operators.timeslice import with_latest, with_previous

WATERMARK = "10 minutes"
CRITICAL_EVENT = "error"
SPEED = "decimal(12,2)"


def telemetry(events: DataFrame) -> DataFrame:
    """(event_id, vehicle, ts, event_type, speed, critical). Watermarks need a zoned timestamp."""
    return events.select(
        "event_id", F.col("user_id").alias("vehicle"), F.col("ts").cast("timestamp").alias("ts"),
        "event_type", F.col("value").cast(SPEED).alias("speed"),
        (F.col("event_type") == CRITICAL_EVENT).alias("critical"))


def _watermarked(df: DataFrame, delay: str) -> DataFrame:
    return df.withWatermark("ts", delay) if df.isStreaming else df


def routine(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("critical"))


def critical(df: DataFrame) -> DataFrame:
    """The isolated alert path: stateless, so an alert never waits behind routine telemetry."""
    return df.filter("critical").select("event_id", "vehicle", "ts", "speed")


def _plain(ts: Column) -> Column:
    return ts.cast("timestamp_ntz")


def _mean(total: str, n: str) -> Column:
    return F.round(F.col(total) / F.col(n).cast("decimal(20,0)"), 2).cast(SPEED)


def per_second(df: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """One row per vehicle and second: the routine upload format."""
    return (_watermarked(df, delay)
            .groupBy(F.window("ts", "1 second"), "vehicle")
            .agg(F.count("*").alias("mensagens"), F.sum("speed").alias("_v"),
                 F.max("speed").alias("velocidade_max"),
                 F.count_if("critical").alias("criticas"))
            .select(_plain(F.col("window.start")).alias("segundo"), "vehicle", "mensagens",
                    _mean("_v", "mensagens").alias("velocidade_media"), "velocidade_max",
                    "criticas"))


def windows(df: DataFrame, length: str, slide: str | None = None, by: Sequence[str] = ("event_type",),
            slow: float = 10, delay: str = WATERMARK) -> DataFrame:
    """Tumbling or sliding traffic windows: messages, mean speed and slow readings per group."""
    frame = F.window("ts", length, slide) if slide else F.window("ts", length)
    return (_watermarked(df, delay).groupBy(frame, *by)
            .agg(F.count("*").alias("mensagens"), F.sum("speed").alias("_v"),
                 F.count_if(F.col("speed") < slow).alias("lentas"))
            .select(_plain(F.col("window.start")).alias("inicio"),
                    _plain(F.col("window.end")).alias("fim"), *by, "mensagens",
                    _mean("_v", "mensagens").alias("velocidade_media"), "lentas"))


def hourly_activity(df: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """(hora, vehicle, ...): seconds, minutes and readings of each hour, by windows over windows in one query.

    Readings become seconds, these minutes, and these hours; as a stream each step takes what the one before it has closed,
    so the steps after the first hold one row per vehicle and second or minute instead of readings.
    """
    def step(rows: DataFrame, length: str, units: str) -> DataFrame:
        frame = F.window(F.window_time("window"), length)
        return rows.groupBy(frame, "vehicle").agg(
            F.count("*").alias(units), F.sum("mensagens").alias("mensagens"), F.sum("soma").cast("decimal(28,2)").alias("soma"),
            F.max("velocidade_max").alias("velocidade_max"), *([F.sum("segundos").alias("segundos")] if units == "minutos" else []))

    seconds = (_watermarked(df, delay).groupBy(F.window("ts", "1 second"), "vehicle")
               .agg(F.count("*").alias("mensagens"), F.sum("speed").alias("soma"), F.max("speed").alias("velocidade_max")))
    hours = step(step(seconds, "1 minute", "segundos"), "1 hour", "minutos")
    return hours.select(_plain(F.col("window.start")).alias("hora"), "vehicle", "minutos", "segundos", "mensagens",
                        _mean("soma", "mensagens").alias("velocidade_media"), "velocidade_max")


def trips(df: DataFrame, gap: str = "30 minutes", delay: str = WATERMARK) -> DataFrame:
    """Trips as sessions: a vehicle silent for ``gap`` has ended its trip.

    Sessions are merged inside each map partition before the shuffle by vehicle, so a vehicle with a
    third of the rows sends its sessions, not its rows, to one task.
    """
    return (_watermarked(df, delay)
            .groupBy(F.session_window("ts", gap), "vehicle")
            .agg(F.count("*").alias("mensagens"), F.min("ts").alias("_a"), F.max("ts").alias("_b"),
                 F.max("speed").alias("velocidade_max"))
            .select("vehicle", _plain(F.col("_a")).alias("inicio"), _plain(F.col("_b")).alias("fim"),
                    "mensagens", "velocidade_max"))


def merge_trips(parts: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Unite parts of trips, found in any order: parts closer than ``gap`` belong together.

    Only parts are ordered per vehicle, never readings.
    """
    order = Window.partitionBy("vehicle").orderBy("inicio", "fim")
    before = F.max("fim").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = before.isNull() | (F.col("inicio") >= before + F.expr(f"INTERVAL {gap}"))
    number = F.sum(apart.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (parts.withColumn("_trip", number).groupBy("vehicle", "_trip")
            .agg(F.min("inicio").alias("inicio"), F.max("fim").alias("fim"), F.sum("mensagens").alias("mensagens"),
                 F.max("velocidade_max").alias("velocidade_max")).drop("_trip"))


def backlog_delay(events: DataFrame, reserve_seconds: int = 600) -> str:
    """A watermark delay under which no row of a stored backlog is late, whatever the order of its files.

    The delay is the backlog's own length in time: windows of that length stay in the state store.
    """
    low, high = events.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    seconds = 0 if low is None else (high - low) // 1_000_000 + 1
    return f"{seconds + reserve_seconds} seconds"


def without_replays(df: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """One copy per event id. A stream forgets ids the watermark has passed; a batch keeps all."""
    if df.isStreaming:
        return df.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])
    return df.dropDuplicates(["event_id"])


def latest_status(df: DataFrame) -> DataFrame:
    """Newest reading per vehicle (batch or micro-batch); partial maxima are combined map-side."""
    newest = F.max_by(F.struct("event_id", "event_type", "speed", "ts"), F.struct("ts", "event_id"))
    return df.groupBy("vehicle").agg(newest.alias("s")).select(
        "vehicle", F.col("s.event_id").alias("event_id"), F.col("s.event_type").alias("event_type"),
        F.col("s.speed").alias("speed"), F.col("s.ts").alias("ts"))


def daily_usage(df: DataFrame, max_gap_seconds: int = 300) -> DataFrame:
    """Batch consolidation: usage seconds and km per vehicle and day.

    Time between two readings counts as usage when the gap is at most ``max_gap_seconds``; the
    distance is the earlier speed over that time. A gap belongs to the day of the later reading.
    """
    rows = with_previous(df, "vehicle", "ts", "event_id", ["ts", "speed"])
    micros = F.unix_micros("ts") - F.unix_micros("prev_ts")
    used = F.when(micros <= max_gap_seconds * 1_000_000, micros).otherwise(0)
    # Speed times time summed exactly, divided once per vehicle and day.
    metres = F.coalesce(F.col("prev_speed"), F.lit(0).cast(SPEED)) * used.cast("decimal(18,0)")
    micros_per_hour = F.lit(3_600_000_000).cast("decimal(18,0)")
    return (rows.groupBy("vehicle", F.col("ts").cast("timestamp_ntz").cast("date").alias("dia"))
            .agg(F.count("*").alias("mensagens"), F.sum(used).alias("_us"),
                 F.sum(metres).cast("decimal(32,2)").alias("_ku"))
            .select("vehicle", "dia", "mensagens",
                    F.floor(F.coalesce("_us", F.lit(0)) / 1_000_000).alias("segundos_uso"),
                    F.round(F.col("_ku") / micros_per_hour, 2).cast("decimal(18,2)").alias("km")))


def downsample(df: DataFrame, unit: str = "hour") -> DataFrame:
    """Rollup of raw telemetry for the warm tier."""
    return (df.groupBy("vehicle", _plain(F.date_trunc(unit, "ts")).alias("periodo"))
            .agg(F.count("*").alias("mensagens"), F.sum("speed").alias("_v"),
                 F.min("speed").alias("velocidade_min"), F.max("speed").alias("velocidade_max"),
                 F.count_if("critical").alias("criticas"))
            .select("vehicle", "periodo", "mensagens",
                    _mean("_v", "mensagens").alias("velocidade_media"), "velocidade_min",
                    "velocidade_max", "criticas"))


def clip_context(df: DataFrame, seconds: int = 300) -> DataFrame:
    """Readings within ``seconds`` of any emergency of the same vehicle (batch).

    Time is cut into buckets of that width. A reading sharing a bucket with an emergency qualifies
    if either neighbour test or the bucket itself says so; of the bucket before only its latest
    emergency can reach it, of the bucket after only the earliest. So emergencies shrink to one
    (earliest, latest) pair per vehicle and bucket, and each reading meets one summary row: no pair
    of a reading with each emergency is ever built.
    """
    width = seconds * 1_000_000
    micros = F.unix_micros("ts")
    marks = (df.filter("critical").groupBy("vehicle", F.floor(micros / width).alias("_b"))
             .agg(F.min(micros).alias("_lo"), F.max(micros).alias("_hi")))
    reach = marks.select("vehicle", F.explode(F.array(
        F.struct((F.col("_b") - 1).alias("_b"), F.col("_lo").alias("_next"),
                 F.lit(None).cast("bigint").alias("_last"), F.lit(False).alias("_own")),
        F.struct(F.col("_b").alias("_b"), F.lit(None).cast("bigint").alias("_next"),
                 F.lit(None).cast("bigint").alias("_last"), F.lit(True).alias("_own")),
        F.struct((F.col("_b") + 1).alias("_b"), F.lit(None).cast("bigint").alias("_next"),
                 F.col("_hi").alias("_last"), F.lit(False).alias("_own")))).alias("x"))
    near = reach.select("vehicle", "x.*").groupBy("vehicle", "_b").agg(
        F.min("_next").alias("_next"), F.max("_last").alias("_last"), F.max("_own").alias("_own"))
    inside = (F.col("_own") | F.coalesce(F.col("_next") - micros <= width, F.lit(False))
              | F.coalesce(micros - F.col("_last") <= width, F.lit(False)))
    return (df.withColumn("_b", F.floor(micros / width)).join(near, ["vehicle", "_b"])
            .filter(inside).select(*df.columns))


def clip_context_stream(df: DataFrame, emergencies: DataFrame, seconds: int = 300,
                        delay: str = WATERMARK) -> DataFrame:
    """Streaming form: a left-semi interval join, state bounded by the two watermarks.

    The key holds a time bucket beside the vehicle, so a busy vehicle is spread over the state partitions and a reading
    meets the emergencies of its neighbourhood only. An emergency is put into its own bucket and both next to it.
    """
    bucket = lambda ts: F.floor(F.unix_micros(ts) / (seconds * 1_000_000))
    left = df.withColumn("_b", bucket("ts")).withWatermark("ts", delay)
    right = emergencies.select(
        F.col("vehicle").alias("c_vehicle"), F.col("ts").alias("c_ts"),
        F.explode(F.array(*[bucket("ts") + k for k in (-1, 0, 1)])).alias("c_b")).withWatermark("c_ts", delay)
    near = F.expr(f"vehicle = c_vehicle AND _b = c_b AND ts >= c_ts - INTERVAL {seconds} SECONDS "
                  f"AND ts <= c_ts + INTERVAL {seconds} SECONDS")
    return left.join(right, near, "left_semi").drop("_b")


def open_rentals(locacao: DataFrame, veiculo: DataFrame, grupo: DataFrame) -> DataFrame:
    """Latest open rental of each vehicle with its daily rate: the static side of the billing join."""
    rate = (veiculo.select("veiculo_nk", "grupo_veiculo_nk")
            .join(grupo.select("grupo_veiculo_nk", "diaria"), "grupo_veiculo_nk", "left")
            .select("veiculo_nk", "diaria"))
    rows = (locacao.filter("data_retirada IS NOT NULL AND data_devolucao IS NULL "
                           "AND veiculo_nk IS NOT NULL")
            .select("veiculo_nk", "locacao_nk", "data_retirada", "data_devolucao_prevista",
                    "km_entrega", "valor_atraso"))
    return (latest_per_key(rows, ["veiculo_nk"], newest="data_retirada", tie_break=["locacao_nk"])
            .join(rate, "veiculo_nk", "left"))


def rental_usage(df: DataFrame, rentals: DataFrame, max_gap_seconds: int = 300, hard_speed: float = 80) -> DataFrame:
    """(locacao_nk, leituras, segundos, km, pct_rapidas): what a vehicle did while a rental of it was open.

    ``rentals`` has vehicle, locacao_nk, inicio and fim (null: not returned). A reading belongs to the latest rental that began
    by then, unless that has ended (half-open intervals of any length). Time and distance between two readings count
    as in :func:`daily_usage`, if both belong to the same rental. pct_rapidas is the share of readings above ``hard_speed``.
    """
    tagged = with_latest(df, rentals.select("vehicle", "inicio", "locacao_nk", "fim"), "vehicle", "ts", "inicio", "_r")
    end = F.col("_r.fim").cast("timestamp")
    tagged = tagged.withColumn("_nk", F.when(end.isNull() | (F.col("ts") < end), F.col("_r.locacao_nk"))).drop("_r")
    rows = with_previous(tagged, "vehicle", "ts", "event_id", ["ts", "speed", "_nk"]).filter("_nk is not null")
    micros = F.unix_micros("ts") - F.unix_micros("prev_ts")
    used = F.when((F.col("prev__nk") == F.col("_nk")) & (micros <= max_gap_seconds * 1_000_000), micros).otherwise(0)
    metres = F.coalesce(F.col("prev_speed"), F.lit(0).cast(SPEED)) * used.cast("decimal(18,0)")
    micros_per_hour = F.lit(3_600_000_000).cast("decimal(18,0)")
    return (rows.groupBy(F.col("_nk").alias("locacao_nk"))
            .agg(F.count("*").alias("leituras"), F.sum(used).alias("_us"), F.sum(metres).cast("decimal(32,2)").alias("_ku"),
                 F.count_if(F.col("speed") > hard_speed).alias("_hard"))
            .select("locacao_nk", "leituras", F.floor(F.col("_us") / 1_000_000).alias("segundos"),
                    F.round(F.col("_ku") / micros_per_hour, 2).cast("decimal(18,2)").alias("km"),
                    R.percent("_hard", "leituras", 2).alias("pct_rapidas")))


def bill_returns(returns: DataFrame, rentals: DataFrame, source: int = 1) -> DataFrame:
    """Charges at return: the same day, lateness, km and fee rules as the warehouse.

    ``returns`` carries (event_id, vehicle, ts, speed) with the distance driven in ``speed``; it may be
    a stream, ``rentals`` is static.
    """
    back = returns.select(
        "event_id", R.natural_key(F.lit(source), "vehicle").alias("veiculo_nk"),
        F.col("ts").cast("timestamp_ntz").cast("date").alias("devolucao"),
        F.floor("speed").cast("int").alias("_km"))
    km_in = F.col("km_entrega") + F.col("_km")
    return back.join(rentals, "veiculo_nk").select(
        "event_id", "locacao_nk", "veiculo_nk", "devolucao",
        R.days_inclusive("data_retirada", "devolucao").alias("dias_realizados"),
        R.days_late("devolucao", "data_devolucao_prevista").alias("atraso_devolucao_dias"),
        R.km_driven("km_entrega", km_in).alias("km_rodado"),
        R.late_fee("valor_atraso", "devolucao", "data_devolucao_prevista", "diaria")
        .alias("valor_multa_atraso"))


def mask_personal(df: DataFrame, hashed: Sequence[str] = (), masked: Sequence[str] = (),
                  salt: str = "") -> DataFrame:
    """Pseudonymise: salted SHA-256 for identifiers that must still join, digits and letters hidden
    for values only shown."""
    out = df
    for c in hashed:
        out = out.withColumn(c, F.sha2(F.concat(F.lit(salt), F.col(c).cast("string")), 256))
    for c in masked:
        out = out.withColumn(c, F.mask(F.col(c)))
    return out
