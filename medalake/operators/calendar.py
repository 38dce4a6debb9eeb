"""Generated calendar dimension."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from medalake.functions.dates import day, weekday

# High-season months.
HIGH_SEASON_MONTHS = (1, 7, 12)
# A longer span comes from a sentinel or a typing error. The bound is what lets a calendar be
# broadcast: four centuries.
MAX_DAYS = 146_097


def date_range(*sides: tuple[DataFrame, str, str]) -> DataFrame:
    """One row (lo, hi) covering every side ``(frame, low column, high column)``.

    Each side is reduced to one row before the sides meet, so no pairs are formed.
    """
    rows = [
        df.agg(F.min(day(F.col(low))).alias("lo"), F.max(day(F.col(high))).alias("hi"))
        for df, low, high in sides
    ]
    return reduce(DataFrame.union, rows).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def span_of(df: DataFrame, *columns: str) -> DataFrame:
    """One row (lo, hi) over several date columns of one frame, in a single pass."""
    days = [day(F.col(c)) for c in columns]
    low, high = (days[0], days[0]) if len(days) == 1 else (F.least(*days), F.greatest(*days))
    return df.agg(F.min(low).alias("lo"), F.max(high).alias("hi"))


def date_spine(bounds: DataFrame, name: str = "fecha") -> DataFrame:
    """Every day from ``lo`` to ``hi``, ends included, beside ``lo``; none if ``lo`` is later.
    A span of more than ``MAX_DAYS`` is an error."""
    message = F.format_string("a calendar from %s to %s is too long", "lo", "hi")
    days = F.when(F.datediff("hi", "lo") >= MAX_DAYS, F.raise_error(message).cast("array<date>"))
    days = days.when(F.col("lo") <= F.col("hi"), F.sequence("lo", "hi"))
    return bounds.select("lo", F.explode(days).alias(name))


def calendar_dim(bounds: DataFrame, week_start: str = "monday") -> DataFrame:
    """Calendar with one row per day and a dense key from 1.

    The spine has no holes, so the key is the day's distance from the first day; no sort needed.
    """
    d, dow = F.col("fecha"), weekday(F.col("fecha"), week_start)
    return date_spine(bounds).select(
        (F.datediff("fecha", "lo") + 1).cast("bigint").alias("tiempo_sk"),
        "fecha",
        F.year(d).alias("anio"),
        F.quarter(d).alias("trimestre"),
        F.month(d).alias("mes"),
        F.date_format(d, "MMMM").alias("mes_nombre"),
        F.dayofmonth(d).alias("dia"),
        dow.alias("dia_semana"),
        F.date_format(d, "EEEE").alias("dia_nombre"),
        (F.weekday(d) >= 5).alias("es_fin_semana"),
        F.month(d).isin(*HIGH_SEASON_MONTHS).alias("es_temporada_alta"),
    )


def bounded(calendar: DataFrame) -> DataFrame:
    """Mark a calendar for broadcast.

    Its size follows the span of dates, never the number of bookings: a century is 36,525 rows,
    and ``date_spine`` stops at ``MAX_DAYS``.
    """
    return F.broadcast(calendar)
