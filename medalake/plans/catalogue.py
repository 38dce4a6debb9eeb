"""Analytical queries over the booking star.

Each query takes a ``Star`` and returns a DataFrame. ``es_cancelada = 0`` is the confirmed
population; each metric says which population it is over.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from medalake.functions.dates import day, month_label
from medalake.functions.numbers import (
    from_units, money_avg, money_sum, money_units, percent, rounded,
)
from medalake.functions.text import map_values
from medalake.operators.calendar import bounded
from medalake.operators.matrix import linear_trend, pivot_matrix, top_k
from medalake.operators.scd import pit_join
from medalake.operators.star import Star, route_label

CONFIRMED = "es_cancelada = 0"
PRICE = "precio_pagado"
MILLION, BILLION = 1e6, 1e9
# Weekday spine and its short labels; peak days are Mon, Fri, Sat, Sun.
WEEKDAYS = {
    "Monday": "Lun", "Tuesday": "Mar", "Wednesday": "Mié", "Thursday": "Jue",
    "Friday": "Vie", "Saturday": "Sáb", "Sunday": "Dom",
}
PEAK_DAYS = ("Monday", "Friday", "Saturday", "Sunday")


def _n() -> Column:
    return F.count(F.lit(1))


def _flag_sum(c: Column) -> Column:
    return F.sum(c).cast("bigint")


def _cancelled() -> Column:
    return _flag_sum(F.col("es_cancelada"))


def monthly_revenue(star: Star) -> DataFrame:
    """Bookings, revenue, mean price and cancellations by month, over all bookings."""
    return (
        star.with_dims("tiempo")
        .groupBy("anio", "trimestre", "mes", "mes_nombre")
        .agg(
            _n().alias("reservas"),
            money_sum(F.col(PRICE)).alias("ingresos_cop"),
            money_avg(F.col(PRICE)).alias("ticket_promedio"),
            _cancelled().alias("canceladas"),
            percent(_cancelled(), _n(), 2).alias("tasa_cancel_pct"),
        )
        .orderBy("anio", "mes")
    )


def seat_utilisation(star: Star, since: date) -> DataFrame:
    """Seats sold (confirmed, by booking date) against capacity (by flight date) per route.

    Sales are summed per route and capacity per route before the two meet.
    """
    recent = bounded(star.tiempo.where(F.col("fecha") >= F.lit(since)).select("fecha"))
    sold = (
        star.booked_since(since).where(CONFIRMED).fact
        .groupBy("ruta_sk").agg(F.sum("asientos_reservados").alias("asientos_vendidos"))
        .join(star.ruta, "ruta_sk")
    )
    flights = star.vuelo.withColumn("fecha", day(F.col("fecha_vuelo")))
    capacity = (
        flights.join(recent, "fecha")
        .groupBy("ruta_id").agg(F.sum("capacidad_asientos").alias("asientos_disponibles"))
    )
    return (
        sold.join(capacity, "ruta_id")
        .select(
            route_label().alias("ruta"),
            "internacional_flag",
            "asientos_vendidos",
            "asientos_disponibles",
            percent(F.col("asientos_vendidos"), F.col("asientos_disponibles"), 1)
            .alias("ocupacion_pct"),
        )
        .orderBy(F.desc("ocupacion_pct"), "ruta")
    )


def _counted(facts: DataFrame, *keys: str) -> DataFrame:
    """Bookings, cancellations and money units per combination of keys."""
    return facts.groupBy(*keys).agg(
        _n().alias("_n"), _cancelled().alias("_cancelled"),
        F.sum(money_units(F.col(PRICE))).cast("decimal(38,0)").alias("_units"),
    )


def channel_conversion(star: Star) -> DataFrame:
    """Confirmed against cancelled per channel; revenue over all bookings.

    Facts are counted per channel key before they meet the channels, so no fact is shuffled by a
    key of a handful of values.
    """
    counted = _counted(star.fact, "canal_sk").join(star.canal, "canal_sk")
    return (
        counted.groupBy(F.col("nombre").alias("canal"), "digital_flag")
        .agg(
            F.sum("_n").alias("total_reservas"),
            (F.sum("_n") - F.sum("_cancelled")).alias("confirmadas"),
            F.sum("_cancelled").alias("canceladas"),
            percent(F.sum("_n") - F.sum("_cancelled"), F.sum("_n"), 2).alias("conversion_pct"),
            from_units(F.sum("_units")).cast("double").alias("ingresos_cop"),
        )
        .orderBy(F.desc("ingresos_cop"), "canal")
    )


def lead_time(star: Star) -> DataFrame:
    """Mean days between booking and flight by season and segment, confirmed only."""
    return (
        star.where(CONFIRMED).with_dims("tiempo", "pasajero")
        .groupBy("es_temporada_alta", "segmento")
        .agg(
            _n().alias("reservas"),
            rounded(F.avg("dias_anticipacion"), 1).alias("dias_anticipacion_avg"),
            rounded(money_avg(F.col(PRICE)), 0).alias("ticket_promedio"),
        )
        .orderBy(F.desc("es_temporada_alta"), F.desc("dias_anticipacion_avg"), "segmento")
    )


def _day_hour(star: Star, keys: Sequence[str]) -> DataFrame:
    return (
        star.with_dims("tiempo")
        .groupBy(*keys, F.hour("fecha_reserva").alias("hora"))
        .agg(_n().alias("reservas"))
    )


def booking_peaks(star: Star, k: int = 15) -> DataFrame:
    """Busiest weekday and hour cells among the peak days; ties by weekday from Monday, then hour.

    Days go by name: their numbers depend on where the calendar's week starts.
    """
    cells = _day_hour(star, ["dia_nombre"]).where(F.col("dia_nombre").isin(*PEAK_DAYS))
    order = F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), F.col("dia_nombre"))
    best = top_k(cells, k, F.desc("reservas"), order.asc(), F.asc("hora"))
    return best.select("dia_nombre", "hora", "reservas")


def top_routes(star: Star, k: int = 10) -> DataFrame:
    """Routes by confirmed revenue in millions, with seats."""
    routes = (
        star.where(CONFIRMED).fact.groupBy("ruta_sk")
        .agg(F.sum(money_units(F.col(PRICE))).alias("_units"),
             F.sum("asientos_reservados").alias("asientos"))
        .join(star.ruta, "ruta_sk")
        .groupBy(route_label().alias("ruta"), "internacional_flag")
        .agg((from_units(F.sum("_units")).cast("double") / MILLION).alias("ingresos_M_COP"),
             F.sum("asientos").alias("asientos"))
    )
    return top_k(routes, k, F.desc("ingresos_M_COP"), F.asc("ruta"))


def day_hour_matrix(star: Star) -> DataFrame:
    """Bookings per weekday (Monday first) and hour; empty cells 0, absent weekdays null."""
    hours = {h: f"h{h:02d}" for h in range(24)}
    cells = _day_hour(star, ["dia_nombre"])
    matrix = pivot_matrix(cells, ["dia_nombre"], "hora", "reservas", hours).na.fill(0)
    names = F.array(*[F.lit(name) for name in WEEKDAYS])
    # Seven rows on either side, whatever the fact: one partition and a broadcast.
    spine = star.fact.sparkSession.range(0, len(WEEKDAYS), numPartitions=1).select(
        F.col("id").alias("_orden"), F.get(names, F.col("id").cast("int")).alias("dia_nombre")
    )
    return (
        spine.join(F.broadcast(matrix), "dia_nombre", "left")
        .orderBy("_orden")
        .select(map_values(F.col("dia_nombre"), WEEKDAYS).alias("dia"), *hours.values())
    )


def monthly_trend(star: Star) -> DataFrame:
    """Confirmed revenue in millions per month, with its linear trend."""
    monthly = (
        star.where(CONFIRMED).with_dims("tiempo")
        .groupBy("anio", "mes")
        .agg((money_sum(F.col(PRICE)) / MILLION).alias("ingresos_M_COP"), _n().alias("reservas"))
        .withColumn("periodo", month_label(F.col("anio"), F.col("mes")))
    )
    return linear_trend(monthly, ["anio", "mes"], "ingresos_M_COP", 4).orderBy("anio", "mes")


def kpi_row(star: Star) -> DataFrame:
    """One row: cancel rate over all bookings; price, lead time and revenue over confirmed.

    One scan with conditional aggregates serves all populations.
    """
    confirmed = F.col("es_cancelada") == 0
    price, lead = (F.when(confirmed, F.col(c)) for c in (PRICE, "dias_anticipacion"))
    return star.fact.agg(
        percent(_cancelled(), _n(), 2).alias("tasa_cancelacion_pct"),
        rounded(money_avg(price), 0).alias("ticket_promedio"),
        rounded(F.avg(lead), 1).alias("ventana_media_dias"),
        (money_sum(price) / BILLION).alias("ingresos_total_B_COP"),
        _n().alias("total_reservas"),
        F.count_if(confirmed).alias("confirmadas"),
    )


def _channel_segment(star: Star, *aggregates: Column) -> DataFrame:
    """Aggregates of ``_counted`` by channel and segment; only the passengers meet whole facts."""
    counted = _counted(star.with_dims("pasajero"), "canal_sk", "segmento")
    return (
        counted.join(star.canal, "canal_sk")
        .groupBy(F.col("nombre").alias("canal"), "segmento")
        .agg(*aggregates)
    )


def _conversion() -> Column:
    return percent(F.sum("_n") - F.sum("_cancelled"), F.sum("_n"), 1)


def channel_segment_conversion(star: Star) -> DataFrame:
    """Conversion % and bookings per channel and segment, in long form."""
    return _channel_segment(
        star, _conversion().alias("conversion_pct"), F.sum("_n").alias("total")
    ).orderBy("canal", "segmento")


def channel_segment_matrix(star: Star, segments: Sequence[str]) -> DataFrame:
    """Conversion % with one column per segment; combinations without bookings are null."""
    cells = _channel_segment(star, _conversion().alias("v"))
    columns = {s: s.lower() for s in segments}
    return pivot_matrix(cells, ["canal"], "segmento", "v", columns).orderBy("canal")


def channel_segment_revenue(star: Star, segments: Sequence[str]) -> DataFrame:
    """Revenue over all bookings with one column per segment."""
    cells = _channel_segment(star, from_units(F.sum("_units")).cast("double").alias("v"))
    columns = {s: s.lower() for s in segments}
    return pivot_matrix(cells, ["canal"], "segmento", "v", columns).orderBy("canal")


def monthly_confirmed(star: Star) -> DataFrame:
    """Confirmed bookings and revenue per month through the calendar."""
    return (
        star.where(CONFIRMED).with_dims("tiempo")
        .groupBy("anio", "mes")
        .agg(_n().alias("reservas"), money_sum(F.col(PRICE)).alias("ingresos"))
        .orderBy("anio", "mes")
    )


def monthly_confirmed_plain(bookings: DataFrame) -> DataFrame:
    """The same from the booking table alone, with year and month as text."""
    at = F.col("fecha_reserva")
    return (
        bookings.where(F.col("estado") == "CONFIRMADA")
        .groupBy(F.date_format(day(at), "yyyy").alias("anio"),
                 F.date_format(day(at), "MM").alias("mes"))
        .agg(_n().alias("reservas"), money_sum(F.col(PRICE)).alias("ingresos"))
        .orderBy("anio", "mes")
    )


def full_scan(fact: DataFrame) -> DataFrame:
    return fact.agg(_n().alias("reservas"), money_sum(F.col(PRICE)).alias("ingresos"))


def route_count_since(star: Star, since: date) -> DataFrame:
    """Bookings per route since a date."""
    return (
        star.booked_since(since).fact
        .groupBy("ruta_sk").agg(_n().alias("n"))
        .join(star.ruta, "ruta_sk")
        .groupBy(route_label().alias("ruta")).agg(F.sum("n").alias("reservas"))
        .orderBy(F.desc("reservas"), "ruta")
    )


def card_monthly_revenue(view: DataFrame) -> DataFrame:
    """Revenue over all bookings per month, from the wide view."""
    return (
        view.groupBy("anio", "mes").agg(money_sum(F.col(PRICE)).alias("ingresos"))
        .orderBy("anio", "mes")
    )


def card_lead_and_cancelled(view: DataFrame) -> DataFrame:
    """Mean lead time and number of cancelled bookings, from the wide view."""
    return view.agg(
        rounded(F.avg("dias_anticipacion"), 4).alias("dias_anticipacion_avg"),
        F.count_if(F.col("es_cancelada") == 1).alias("canceladas"),
    )


def revenue_by_segment(
    bookings: DataFrame, versions: DataFrame, key: str, at: str, amount: str
) -> DataFrame:
    """Revenue by the segment an id had when booking."""
    return (
        pit_join(bookings, versions, key, at, ["segmento"], how="inner")
        .groupBy("segmento")
        .agg(_n().alias("reservas"), money_sum(F.col(amount)).alias("ingresos"))
        .orderBy("segmento")
    )


def promotion_rate(
    versions: DataFrame, key: str, origin: str = "ocasional", target: str = "frecuente",
    months: int = 12,
) -> DataFrame:
    """Share of ids once in ``origin`` that moved straight to ``target`` within ``months``."""
    chain = Window.partitionBy(key).orderBy("valido_desde")
    in_time = F.col("_desde") < F.add_months("valido_desde", months)
    moved = (F.col("segmento") == origin) & (F.col("_segmento") == target) & in_time
    per_id = (
        versions.select(
            key, "segmento", "valido_desde",
            F.lead("segmento").over(chain).alias("_segmento"),
            F.lead("valido_desde").over(chain).alias("_desde"),
        )
        .where(F.col("segmento") == origin)
        .groupBy(key).agg(F.max(F.coalesce(moved, F.lit(False))).alias("promoted"))
    )
    return per_id.agg(
        _n().alias("ids"),
        F.count_if("promoted").alias("promovidos"),
        percent(F.count_if("promoted"), _n(), 2).alias("tasa_promocion_pct"),
    )


def behaviour_by_version(
    bookings: DataFrame, versions: DataFrame, key: str, at: str, amount: str
) -> DataFrame:
    """Bookings of ids that changed, before and after each change: one row per id and version."""
    chain = Window.partitionBy(key)
    order = Window.partitionBy(key).orderBy("valido_desde")
    changed = versions.withColumns(
        {"_n": F.count(F.lit(1)).over(chain), "version": F.row_number().over(order)}
    ).where("_n > 1")
    return (
        pit_join(bookings, changed, key, at, ["version", "segmento"], how="inner")
        .groupBy(key, "version", "segmento")
        .agg(
            _n().alias("reservas"),
            money_sum(F.col(amount)).alias("ingresos"),
            money_avg(F.col(amount)).alias("ticket_promedio"),
        )
    )
