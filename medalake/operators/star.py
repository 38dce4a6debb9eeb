"""Fact building and denormalisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, functions as F

from medalake.operators.calendar import bounded


# Partition column of a stored fact: booking month as ``YYYY-MM``.
MONTH = "anio_mes"
# A side of a join with no more rows than this is broadcast: some 200 bytes a row when versions are
# folded, and up to three times that in the driver while it builds the broadcast.
BROADCAST_ROWS = 200_000


def by_rows(side: DataFrame, rows: int | None = None) -> DataFrame:
    """A join's side that is broadcast or not by its rows, counted unless ``rows`` tells them.

    For stored tables. Spark compares the bytes of their files with its threshold, and columns that
    compress well take a hundredth of the memory there that their rows take in a broadcast, which
    the driver builds as a whole.
    """
    rows = side.count() if rows is None else rows
    return F.broadcast(side) if rows <= BROADCAST_ROWS else side.hint("merge")


@dataclass(frozen=True)
class Star:
    """One fact and its dimensions, joined on ``tiempo_sk``, ``vuelo_sk``, ``ruta_sk``,
    ``pasajero_sk`` and ``canal_sk``. A dimension a query does not use may be missing."""

    fact: DataFrame
    tiempo: DataFrame | None = None
    vuelo: DataFrame | None = None
    ruta: DataFrame | None = None
    pasajero: DataFrame | None = None
    canal: DataFrame | None = None

    def with_dims(self, *names: str) -> DataFrame:
        """Inner join of the fact with the named dimensions.

        Only the calendar is marked for broadcast, being bounded by the span of dates. For the
        others Spark compares the measured size with its broadcast threshold and falls back to a
        skew-aware shuffle join.
        """
        out = self.fact
        for name in names:
            dim = getattr(self, name)
            out = out.join(bounded(dim) if name == "tiempo" else dim, f"{name}_sk")
        return out

    def where(self, condition) -> "Star":
        return replace(self, fact=self.fact.where(condition))

    def booked_since(self, since: date) -> "Star":
        """Facts booked on or after a day. The bound is put on the fact itself rather than on the
        calendar, so that it prunes month partitions and Parquet row groups."""
        fact = self.fact.where(F.col("fecha_reserva") >= F.lit(since))
        if MONTH in fact.columns:
            fact = fact.where(F.col(MONTH) >= since.strftime("%Y-%m"))
        return replace(self, fact=fact)

    def tables(self) -> dict[str, DataFrame]:
        named = {"fact_reservas": self.fact}
        for name in ("tiempo", "vuelo", "ruta", "canal", "pasajero"):
            if getattr(self, name) is not None:
                named[f"dim_{name}"] = getattr(self, name)
        return named


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str] | str,
    take: Sequence[str],
    small: bool = False,
) -> DataFrame:
    """Left lookup: all facts, plus columns ``take`` of the matching dimension row or nulls.

    ``on`` maps fact column to dimension column. ``small`` marks a dimension whose size is bounded
    by construction for broadcast; otherwise Spark decides from sizes.
    """
    pairs = {on: on} if isinstance(on, str) else dict(on)
    keys = {f"_on_{i}": (f, d) for i, (f, d) in enumerate(pairs.items())}
    side = dim.select(*[F.col(d).alias(k) for k, (_, d) in keys.items()], *take)
    side = F.broadcast(side) if small else side
    match = [F.col(f) == F.col(k) for k, (f, _) in keys.items()]
    return fact.join(side, match, "left").drop(*keys)


def orphan_flag(keys: Sequence[str]):
    """True where any of the keys is null."""
    flag = F.col(keys[0]).isNull()
    for k in keys[1:]:
        flag = flag | F.col(k).isNull()
    return flag


def resolve_orphans(fact: DataFrame, keys: Sequence[str], policy: str = "drop") -> DataFrame:
    """Facts whose lookups all succeeded (``drop``), all facts (``keep``), or an error on the
    first orphan met while running (``fail``)."""
    if policy == "drop":
        # One predicate per key: each turns its left lookup into an inner join.
        for k in keys:
            fact = fact.where(F.col(k).isNotNull())
        return fact
    if policy == "keep":
        return fact
    if policy == "fail":
        message = F.lit(f"fact row without a dimension row for one of {', '.join(keys)}")
        first, *rest = keys
        checked = F.when(orphan_flag(keys), F.raise_error(message)).otherwise(F.col(first))
        return fact.withColumn(first, checked.cast(fact.schema[first].dataType))
    raise ValueError(f"orphan policy must be drop, keep or fail, not {policy!r}")


def orphan_measures(keys: Sequence[str]):
    """Aggregates: facts, orphans, and misses per key."""
    return [
        F.count(F.lit(1)).alias("filas"),
        F.count_if(orphan_flag(keys)).alias("huerfanas"),
        *[F.count_if(F.col(k).isNull()).alias(f"sin_{k}") for k in keys],
    ]


def orphan_counts(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of ``orphan_measures``. Expects a fact built with ``keep``."""
    return fact.agg(*orphan_measures(keys))


# Column of the wide view, and where it comes from. The names.
WIDE_DIMS = ("tiempo", "vuelo", "ruta", "pasajero", "canal")
WIDE_COLUMNS = {
    **{c: f"fact.{c}" for c in (
        "reserva_id", "precio_pagado", "asientos_reservados", "descuento_aplicado",
        "dias_anticipacion", "es_cancelada", "fecha_reserva",
    )},
    "hora": "hour(fact.fecha_reserva)",
    **{c: f"tiempo.{c}" for c in (
        "fecha", "anio", "mes", "mes_nombre", "dia_nombre", "es_temporada_alta",
    )},
    **{c: f"vuelo.{c}" for c in ("numero_vuelo", "aeronave", "capacidad_asientos")},
    **{c: f"ruta.{c}" for c in ("origen_iata", "destino_iata", "internacional_flag")},
    "ruta": "concat(ruta.origen_iata, '→', ruta.destino_iata)",
    "segmento": "pasajero.segmento",
    "pais_residencia": "pasajero.pais_residencia",
    "canal": "canal.nombre",
    "digital_flag": "canal.digital_flag",
}


def wide_view(star: Star) -> DataFrame:
    """Bookings with every reporting attribute already joined."""
    joined = star.fact.alias("fact")
    for name in WIDE_DIMS:
        dim = getattr(star, name)
        dim = (bounded(dim) if name == "tiempo" else dim).alias(name)
        joined = joined.join(dim, F.col(f"fact.{name}_sk") == F.col(f"{name}.{name}_sk"))
    return joined.select(*[F.expr(e).alias(c) for c, e in WIDE_COLUMNS.items()])


def route_label():
    return F.concat("origen_iata", F.lit("→"), "destino_iata")
