"""Gold: booking star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from medalake.functions.dates import day
from medalake.operators.calendar import calendar_dim, date_range
from medalake.operators.checks import Check
from medalake.operators.keys import surrogate_key
from medalake.operators.scd import DW_EPOCH, pit_join, scd2_from_base, single_version
from medalake.operators.star import Star, by_rows, lookup, resolve_orphans
from medalake.session import stage

DIMS = ("tiempo", "vuelo", "ruta", "canal", "pasajero")
# Keys, columns and declared tests of the star.
FACT_KEYS = ("tiempo_sk", "vuelo_sk", "ruta_sk", "pasajero_sk", "canal_sk")
FACT_COLUMNS = (
    "reserva_id", *FACT_KEYS, "fecha_reserva", "fecha_vuelo_pretendida", "precio_pagado",
    "asientos_reservados", "descuento_aplicado", "dias_anticipacion", "es_cancelada",
)
# Where a passenger segment moves to.
PROMOTION = {"nuevo": "ocasional", "ocasional": "frecuente"}
PROMOTION_FALLBACK = "frecuente"

# Declared tests of the star.
GOLD_CHECKS = (
    *[
        Check(kind, f"dim_{name}", column)
        for name, columns in {
            "tiempo": ("tiempo_sk", "fecha"),
            "vuelo": ("vuelo_sk", "vuelo_id"),
            "ruta": ("ruta_sk", "ruta_id"),
            "canal": ("canal_sk", "canal_id"),
        }.items()
        for column in columns
        for kind in ("not_null", "unique")
    ],
    Check("not_null", "dim_pasajero", "pasajero_sk"),
    Check("unique", "dim_pasajero", "pasajero_sk"),
    Check("not_null", "dim_pasajero", "pasajero_id"),
    Check("not_null", "fact_reservas", "reserva_id"),
    Check("unique", "fact_reservas", "reserva_id"),
    *[Check("not_null", "fact_reservas", k) for k in FACT_KEYS],
    *[
        Check("relationships", "fact_reservas", k, f"dim_{k.removesuffix('_sk')}", k)
        for k in FACT_KEYS
    ],
    Check("not_null", "fact_reservas", "precio_pagado"),
)


# Natural keys of the type-1 dimensions and the calendar, and which of them are small.
NATURAL_KEYS = {"tiempo": "fecha", "vuelo": "vuelo_id", "ruta": "ruta_id", "canal": "canal_id"}
SMALL_DIMS = ("tiempo", "ruta", "canal")


def build_dim(
    df: DataFrame, sk: str, natural_key: str, attributes: Sequence[str], small: bool = False,
    keyed: bool = True,
) -> DataFrame:
    """Type-1 dimension: chosen columns keyed in natural-key order, or not ``keyed`` yet. ``small``
    declares a catalogue table of a handful of rows."""
    rows = df.select(natural_key, *attributes)
    return surrogate_key(rows, sk, [natural_key], small=small) if keyed else rows


def build_dim_tiempo(
    reservas: DataFrame, vuelos: DataFrame, week_start: str = "monday"
) -> DataFrame:
    span = date_range(
        (reservas, "fecha_reserva", "fecha_vuelo_pretendida"),
        (vuelos, "fecha_vuelo", "fecha_vuelo"),
    )
    return calendar_dim(span, week_start)


def build_dim_vuelo(vuelos: DataFrame, keyed: bool = True) -> DataFrame:
    attributes = [
        "numero_vuelo", "ruta_id", "fecha_vuelo", "aeronave", "capacidad_asientos", "aerolinea",
    ]
    return build_dim(vuelos, "vuelo_sk", "vuelo_id", attributes, keyed=keyed)


def build_dim_ruta(rutas: DataFrame, keyed: bool = True) -> DataFrame:
    attributes = [
        "origen_iata", "origen_ciudad", "destino_iata", "destino_ciudad", "distancia_km",
        "internacional_flag",
    ]
    return build_dim(rutas, "ruta_sk", "ruta_id", attributes, small=True, keyed=keyed)


def build_dim_canal(canales: DataFrame, keyed: bool = True) -> DataFrame:
    attributes = ["nombre", "digital_flag", "categoria"]
    return build_dim(canales, "canal_sk", "canal_id", attributes, small=True, keyed=keyed)


def build_dim_pasajero(
    pasajeros: DataFrame, changes: DataFrame | None = None, epoch: date = DW_EPOCH
) -> DataFrame:
    """Type-2 dimension, one version each without ``changes``.

    ``changes`` holds (pasajero_id, fecha_cambio) and, unless segments are to follow the promotion
    map, the new ``segmento``.
    """
    base = pasajeros.select("pasajero_id", "segmento", "pais_residencia", "fecha_alta")
    if changes is None:
        versions = single_version(base, epoch)
    else:
        promote = "segmento" not in changes.columns
        versions = scd2_from_base(
            base, changes, "pasajero_id", "segmento", "fecha_cambio", epoch,
            promotion=PROMOTION if promote else None,
            fallback=PROMOTION_FALLBACK if promote else None,
        )
        # Numbering reads its input several times; the chain of versions is built once.
        versions = stage(versions)
    return surrogate_key(versions, "pasajero_sk", ["pasajero_id", "valido_desde"])


def build_fact(
    reservas: DataFrame, star_dims: Star, orphans: str = "drop", end: str = "date",
    beside: Sequence[str] = (), stored: bool = False,
) -> DataFrame:
    """Bookings with their surrogate keys, and the columns ``beside`` of the bookings. ``stored``
    tells that the dimensions are tables on storage; ``by_rows`` then decides how they are joined.

    Booking → flight → route is resolved on the flight side first: facts, the big side, then need
    a single lookup for both keys. Passengers, for whom facts are shuffled, come before the small
    dimensions, so that their keys are not shuffled along.
    """
    people, routes, channels = star_dims.pasajero, star_dims.ruta, star_dims.canal
    if stored:
        people, routes, channels = by_rows(people), by_rows(routes), by_rows(channels)
    flights = lookup(
        star_dims.vuelo.select("vuelo_id", "vuelo_sk", "ruta_id"), routes, "ruta_id", ["ruta_sk"]
    )
    flights = by_rows(flights, star_dims.vuelo.count()) if stored else flights
    fact = pit_join(
        reservas, people, "pasajero_id", "fecha_reserva", ["pasajero_sk"], end=end,
        how="inner" if orphans == "drop" else "left",
    )
    fact = lookup(
        fact.withColumn("_dia", day(F.col("fecha_reserva"))),
        star_dims.tiempo, {"_dia": "fecha"}, ["tiempo_sk"], small=True,
    )
    fact = lookup(fact, channels, "canal_id", ["canal_sk"])
    fact = lookup(fact, flights, "vuelo_id", ["vuelo_sk", "ruta_sk"])
    return resolve_orphans(fact.select(*FACT_COLUMNS, *beside), FACT_KEYS, orphans)


def build_dim_table(
    name: str,
    silver: Mapping[str, DataFrame],
    changes: DataFrame | None = None,
    epoch: date = DW_EPOCH,
    week_start: str = "monday",
    keyed: bool = True,
) -> DataFrame:
    """One dimension of the star from the silver tables it needs. Not ``keyed``, a type-1 dimension
    has no surrogate key: a registry gives it one."""
    if name == "tiempo":
        calendar = build_dim_tiempo(silver["reservas"], silver["vuelos"], week_start)
        return calendar if keyed else calendar.drop("tiempo_sk")
    if name == "vuelo":
        return build_dim_vuelo(silver["vuelos"], keyed)
    if name == "ruta":
        return build_dim_ruta(silver["rutas"], keyed)
    if name == "canal":
        return build_dim_canal(silver["canales"], keyed)
    if name == "pasajero":
        return build_dim_pasajero(silver["pasajeros"], changes, epoch)
    raise ValueError(f"no dimension called {name!r}")


# Segment rule: more than this many confirmed bookings within the trailing window of days is
# frequent; an id with no more than NEW_UP_TO confirmed bookings so far is new.
FREQUENT_ABOVE = 5
TRAILING_DAYS = 365
NEW_UP_TO = 1
SEGMENTS = ("nuevo", "ocasional", "frecuente")


def segment_days(
    bookings: DataFrame, key: str, at: str, confirmed: Column | None = None
) -> DataFrame:
    """Each id's counts and segment on every day on which they can change.

    ``confirmed`` tells which bookings count; cancelled ones only make an id known. A confirmed
    booking counts from its day on for ``TRAILING_DAYS`` days: it is an event of +1 on its day and
    of -1 on the day it expires, so an id falls back on that day and not at its next booking.

    Returns (key, dia, reservas_dia, reservas_12m, reservas_total, segmento). Events are summed
    per id and day before the window, so an id holds two rows per calendar day at most, whatever
    its share of all bookings. Rows without an id or a time are left out.
    """
    counted = F.lit(True) if confirmed is None else F.coalesce(confirmed, F.lit(False))
    daily = (
        bookings.select(key, day(F.col(at)).alias("dia"), counted.alias("_counts"))
        .where(F.col(key).isNotNull() & F.col("dia").isNotNull())
        .groupBy(key, "dia").agg(F.count_if("_counts").alias("n"))
    )
    expiry = F.struct(
        F.date_add("dia", TRAILING_DAYS).alias("dia"), F.lit(0).cast("bigint").alias("booked"),
        (-F.col("n")).alias("change"),
    )
    booking = F.struct(F.col("dia"), F.col("n").alias("booked"), F.col("n").alias("change"))
    events = F.when(F.col("n") > 0, F.array(booking, expiry)).otherwise(F.array(booking))
    summed = (
        daily.select(key, F.inline(events)).groupBy(key, "dia")
        .agg(F.sum("booked").alias("reservas_dia"), F.sum("change").alias("_change"))
    )
    so_far = Window.partitionBy(key).orderBy("dia").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    new, occasional, frequent = (F.lit(x) for x in SEGMENTS)
    segment = (
        F.when(F.col("reservas_12m") > FREQUENT_ABOVE, frequent)
        .when(F.col("reservas_total") <= NEW_UP_TO, new)
        .otherwise(occasional)
    )
    return summed.select(
        key, "dia", "reservas_dia",
        F.sum("_change").over(so_far).alias("reservas_12m"),
        F.sum("reservas_dia").over(so_far).alias("reservas_total"),
    ).withColumn("segmento", segment)


def segment_log(
    bookings: DataFrame, key: str, at: str, confirmed: Column | None = None
) -> DataFrame:
    """(key, fecha_cambio, segmento): segment each id has from each of its ``segment_days`` on."""
    return segment_days(bookings, key, at, confirmed).select(
        key, F.col("dia").alias("fecha_cambio"), "segmento"
    )
