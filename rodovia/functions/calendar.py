"""Calendar attributes and the continuous day dimension."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from rodovia.functions.rules import date_key

# ISO weekdays (Monday first) and months, spelled as the reports print them.
WEEKDAYS = ("Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira", "Sexta-feira", "Sábado",
            "Domingo")
MONTHS = ("Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho", "Julho", "Agosto", "Setembro",
          "Outubro", "Novembro", "Dezembro")


def iso_weekday(date: Column) -> Column:
    return F.weekday(date) + 1


def _name(names, position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def calendar_attributes(days: DataFrame, date: str = "data") -> DataFrame:
    d = F.col(date)
    return days.select(
        date_key(d).alias("sk_tempo"),
        d.alias("data"),
        F.year(d).alias("ano"),
        F.month(d).alias("mes"),
        _name(MONTHS, F.month(d)).alias("nome_mes"),
        F.quarter(d).alias("trimestre"),
        F.dayofmonth(d).alias("dia"),
        iso_weekday(d).alias("dia_semana"),
        _name(WEEKDAYS, iso_weekday(d)).alias("nome_dia_semana"),
        (iso_weekday(d) >= 6).alias("flag_fim_de_semana"),
    )


def observed_dates(frames: Iterable[tuple[DataFrame, list[Column]]]) -> DataFrame:
    """Distinct dates found in the given columns; each frame is scanned once.

    The row-wise array is de-duplicated by a hash aggregate with map-side combine, so the shuffle
    carries at most one row per day and map task.
    """
    days = None
    for df, columns in frames:
        part = df.select(F.explode(F.array(*[c.cast("date") for c in columns])).alias("data"))
        days = part if days is None else days.union(part)
    return days.filter("data IS NOT NULL").distinct()


def date_bounds(frames: Iterable[tuple[DataFrame, list[Column]]]) -> DataFrame:
    """One row with the earliest and latest date over all frames; no shuffle of dates at all."""
    bounds = None
    for df, columns in frames:
        dates = [c.cast("date") for c in columns]
        low = F.least(*dates) if len(dates) > 1 else dates[0]
        high = F.greatest(*dates) if len(dates) > 1 else dates[0]
        one = df.agg(F.min(low).alias("dt_min"), F.max(high).alias("dt_max"))
        bounds = one if bounds is None else bounds.union(one)
    return bounds.agg(F.min("dt_min").alias("dt_min"), F.max("dt_max").alias("dt_max"))


def continuous_days(bounds: DataFrame) -> DataFrame:
    """One row per day from dt_min to dt_max; no rows when there are no dates."""
    return (bounds.filter("dt_min IS NOT NULL")
            .select(F.explode(F.sequence("dt_min", "dt_max")).alias("data")))
