"""Booking roles played by the TPC-H-like tables.

orders / lineitem are bookings, customers passengers, parts flights, brands routes, order
priorities channels. ``bronze`` maps them to the six bronze tables in full (line grain);
``orders_star`` and ``lines_star`` view them directly as a star on natural keys.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from medalake.operators.calendar import calendar_dim, date_range, span_of
from medalake.operators.clean import CleanSpec
from medalake.operators.scd import scd2_build
from medalake.operators.star import Star, by_rows
from medalake.plans.gold import DIMS, build_dim_table, build_fact, segment_log
from medalake.plans.silver import build_silver
from medalake.session import concurrently, stage, stage_all

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}
# The five market segments and the five event types.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
EPOCH = date(1990, 1, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cancelled() -> Column:
    return (F.col("o_orderstatus") == "F").cast("int")


def lead_days() -> Column:
    return F.datediff("l_shipdate", "o_orderdate")


def named_priority() -> Column:
    """Channel with gaps: unspecified priorities count as missing."""
    return F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED"))


def day_keyed(bounds: DataFrame, week_start: str = "monday") -> DataFrame:
    """Calendar whose key is the date itself, for facts that carry a date and no surrogate key."""
    return calendar_dim(bounds, week_start).withColumn("tiempo_sk", F.col("fecha"))


def channels(orders: DataFrame) -> DataFrame:
    """Five rows; priorities are reduced to their distinct values before the shuffle."""
    name = F.col("o_orderpriority")
    return orders.select(name.alias("canal_sk")).distinct().select(
        "canal_sk",
        F.substring("canal_sk", 3, 20).alias("nombre"),
        (F.substring("canal_sk", 1, 1).cast("int") <= 2).alias("digital_flag"),
    )


def passengers(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("pasajero_sk"), F.col("c_mktsegment").alias("segmento")
    )


def orders_star(spark: SparkSession, sf_dir: str) -> Star:
    """Orders as bookings: the route is the customer's nation → region."""
    orders, customer, nation, region = (
        table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region")
    )
    fact = orders.select(
        F.col("o_orderkey").alias("reserva_id"),
        F.to_date("o_orderdate").alias("tiempo_sk"),
        F.col("o_custkey").alias("pasajero_sk"),
        F.col("o_orderpriority").alias("canal_sk"),
        F.col("o_orderdate").alias("fecha_reserva"),
        F.col("o_totalprice").alias("precio_pagado"),
        F.lit(1).alias("asientos_reservados"),
        cancelled().alias("es_cancelada"),
    )
    routes = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("ruta_sk"),
        F.col("n_name").alias("origen_iata"),
        F.col("r_name").alias("destino_iata"),
        (F.col("r_name") != "AMERICA").alias("internacional_flag"),
    )
    return Star(
        fact,
        tiempo=day_keyed(span_of(orders, "o_orderdate")),
        ruta=routes,
        pasajero=passengers(customer),
        canal=channels(orders),
    )


def with_route(spark: SparkSession, sf_dir: str, star: Star) -> Star:
    """Orders star with the two-hop route key: booking → customer → nation."""
    home = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("pasajero_sk"), F.col("c_nationkey").alias("ruta_sk")
    )
    return Star(
        star.fact.join(home, "pasajero_sk"), star.tiempo, None, star.ruta, star.pasajero, star.canal
    )


def flights(part: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Parts as flights departing on their last shipping day; parts never shipped have no date."""
    departure = lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.max("l_shipdate").alias("fecha_vuelo")
    )
    return part.join(departure, "p_partkey", "left")


def brand_number() -> Column:
    return F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int")


def lines_star(spark: SparkSession, sf_dir: str, routes: bool = True) -> Star:
    """Order lines as bookings, parts as flights, brands as routes.

    Without ``routes`` the fact has no route key and so needs no join with parts.
    """
    lineitem, orders, part, customer = (
        table(spark, sf_dir, t) for t in ("lineitem", "orders", "part", "customer")
    )
    booked = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    route_key = []
    if routes:
        brand = part.select("p_partkey", "p_brand")
        booked = booked.join(brand, F.col("l_partkey") == F.col("p_partkey"))
        route_key = [F.col("p_brand").alias("ruta_sk")]
    fact = booked.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("reserva_id"),
        F.to_date("o_orderdate").alias("tiempo_sk"),
        F.col("l_partkey").alias("vuelo_sk"),
        *route_key,
        F.col("o_custkey").alias("pasajero_sk"),
        F.col("o_orderpriority").alias("canal_sk"),
        F.col("o_orderdate").alias("fecha_reserva"),
        F.col("l_extendedprice").alias("precio_pagado"),
        F.col("l_quantity").alias("asientos_reservados"),
        F.col("l_discount").alias("descuento_aplicado"),
        lead_days().alias("dias_anticipacion"),
        cancelled().alias("es_cancelada"),
    )
    vuelo = flights(part, lineitem).select(
        F.col("p_partkey").alias("vuelo_sk"),
        F.col("p_name").alias("numero_vuelo"),
        F.col("p_brand").alias("ruta_id"),
        "fecha_vuelo",
        F.col("p_type").alias("aeronave"),
        F.col("p_size").alias("capacidad_asientos"),
    )
    ruta = part.select("p_brand").distinct().select(
        F.col("p_brand").alias("ruta_sk"),
        F.col("p_brand").alias("ruta_id"),
        F.concat(F.lit("A"), F.floor(brand_number() / 10)).alias("origen_iata"),
        F.concat(F.lit("B"), brand_number() % 10).alias("destino_iata"),
        (brand_number() % 5 == 0).alias("internacional_flag"),
    )
    nation = table(spark, sf_dir, "nation")
    pasajero = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("pasajero_sk"),
        F.col("c_mktsegment").alias("segmento"),
        F.col("n_name").alias("pais_residencia"),
    )
    return Star(
        fact,
        # Capacity counts by flight date, so the calendar covers bookings and flights.
        tiempo=day_keyed(date_range(
            (orders, "o_orderdate", "o_orderdate"), (lineitem, "l_shipdate", "l_shipdate")
        )),
        vuelo=vuelo,
        ruta=ruta,
        pasajero=pasajero,
        canal=channels(orders),
    )


def event_versions(events: DataFrame) -> DataFrame:
    """Type-2 history of each user's last event type per day."""
    return scd2_build(events, "user_id", ["event_type"], "ts", order_by=["ts", "event_id"])


def customer_segments(orders: DataFrame) -> DataFrame:
    """Type-2 history of customers' segments by the trailing-year rule."""
    log = segment_log(orders, "o_custkey", "o_orderdate", cancelled() == 0)
    return scd2_build(log, "o_custkey", ["segmento"], "fecha_cambio")


# Cleaning rules for order lines, written for the raw table.
LINE_SPEC = CleanSpec(
    key=["l_orderkey", "l_linenumber"],
    text={"l_returnflag": "lower"},
    casts={"l_quantity": "int", "l_extendedprice": "double"},
    defaults={"l_linestatus": "?"},
    not_null=["l_orderkey", "l_shipdate", "l_extendedprice"],
    rules=[("cantidad_minima", "l_quantity > 5")],
    order_by=["l_shipdate", "l_partkey", "l_suppkey"],
)


def bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six bronze tables, with padded and mixed-case text and missing channels to clean."""
    lineitem, orders, part, customer, nation = (
        table(spark, sf_dir, t) for t in ("lineitem", "orders", "part", "customer", "nation")
    )
    n = brand_number()
    rutas = part.select("p_brand").distinct().select(
        F.col("p_brand").alias("ruta_id"),
        F.concat(F.lit(" a"), F.floor(n / 10)).alias("origen_iata"),
        F.concat(F.lit("City A"), F.floor(n / 10)).alias("origen_ciudad"),
        F.concat(F.lit("b"), n % 10, F.lit("\t")).alias("destino_iata"),
        F.concat(F.lit("City B"), n % 10).alias("destino_ciudad"),
        (n * 100).cast("bigint").alias("distancia_km"),
        (n % 5 == 0).alias("internacional_flag"),
    )
    number = F.substring("o_orderpriority", 1, 1).cast("bigint")
    canales = orders.select("o_orderpriority").distinct().select(
        number.alias("canal_id"),
        F.concat(F.lit(" "), F.lower(F.substring("o_orderpriority", 3, 20))).alias("nombre"),
        (number <= 2).alias("digital_flag"),
        F.when(number <= 2, "online").otherwise("presencial").alias("categoria"),
    )
    vuelos = flights(part, lineitem).select(
        F.col("p_partkey").alias("vuelo_id"),
        F.col("p_name").alias("numero_vuelo"),
        F.col("p_brand").alias("ruta_id"),
        "fecha_vuelo",
        F.concat(F.lit(" "), "p_type", F.lit("\n")).alias("aeronave"),
        F.col("p_size").cast("bigint").alias("capacidad_asientos"),
        F.concat(F.lit("Line "), n % 3).alias("aerolinea"),
    )
    pasajeros = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("pasajero_id"),
        F.concat(F.lower("n_name"), F.lit("  ")).alias("pais_residencia"),
        F.concat(F.lit("\t"), "c_mktsegment").alias("segmento"),
        F.lit(None).cast("timestamp_ntz").alias("fecha_alta"),
    )
    flag = F.col("o_orderstatus") == "F"
    reservas = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("RES-"), "l_orderkey", F.lit("-"), "l_linenumber").alias("reserva_id"),
        F.col("o_custkey").alias("pasajero_id"),
        F.col("l_partkey").alias("vuelo_id"),
        F.substring(named_priority(), 1, 1).cast("double").alias("canal_id"),
        F.col("o_orderdate").alias("fecha_reserva"),
        F.col("l_shipdate").alias("fecha_vuelo_pretendida"),
        lead_days().cast("bigint").alias("dias_anticipacion"),
        F.col("l_extendedprice").alias("precio_pagado"),
        F.col("l_quantity").cast("bigint").alias("asientos_reservados"),
        F.col("l_discount").alias("descuento_aplicado"),
        flag.cast("bigint").alias("es_cancelada"),
        F.when(flag, " cancelada").otherwise("Confirmada ").alias("estado"),
    )
    pagos = orders.select(
        F.col("o_orderkey").alias("pago_id"),
        F.concat(F.lit("RES-"), "o_orderkey", F.lit("-1")).alias("reserva_id"),
        F.concat(F.lit(" "), F.lower(F.substring("o_orderpriority", 3, 20))).alias("medio_pago"),
        F.lower("o_orderstatus").alias("estado_pago"),
        F.col("o_totalprice").cast("string").alias("monto"),
    )
    return {
        "rutas": rutas, "canales": canales, "vuelos": vuelos, "pasajeros": pasajeros,
        "reservas": reservas, "pagos": pagos,
    }


def segment_changes(silver: dict[str, DataFrame]) -> DataFrame:
    """Passengers turn ``frecuente`` by the trailing-year rule, else keep their own segment."""
    own = silver["pasajeros"].select("pasajero_id", F.col("segmento").alias("_own"))
    confirmed = F.col("es_cancelada") == 0
    log = segment_log(silver["reservas"], "pasajero_id", "fecha_reserva", confirmed)
    return log.join(own, "pasajero_id").select(
        "pasajero_id",
        "fecha_cambio",
        F.when(F.col("segmento") == "frecuente", F.col("segmento"))
        .otherwise(F.col("_own"))
        .alias("segmento"),
    )


def gold_dim(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One dimension from the raw tables. Inputs that numbering reads repeatedly are staged."""
    silver = build_silver(bronze(spark, sf_dir))
    if name in ("vuelo", "ruta", "canal"):
        table_name = {"vuelo": "vuelos", "ruta": "rutas", "canal": "canales"}[name]
        return build_dim_table(name, {table_name: stage(silver[table_name])})
    if name == "pasajero":
        return build_dim_table(name, silver, segment_changes(silver), EPOCH)
    return build_dim_table(name, silver)


def gold_star(spark: SparkSession, sf_dir: str, orphans: str = "drop") -> Star:
    """The whole star from the raw tables.

    Silver and the dimensions are staged as the layers of a refresh are, since bounds, segments,
    keys and the fact all read them; the fact itself stays lazy.
    """
    silver = build_silver(bronze(spark, sf_dir))
    used = ("reservas", "vuelos", "rutas", "canales", "pasajeros")
    silver = stage_all({name: silver[name] for name in used})
    changes = segment_changes(silver)
    dims = concurrently(
        [lambda n=n: stage(build_dim_table(n, silver, changes, EPOCH)) for n in DIMS]
    )
    dims = dict(zip(DIMS, dims))
    return Star(build_fact(silver["reservas"], Star(None, **dims), orphans), **dims)


# The day between two states of the booking system.
SNAPSHOT_DAY = datetime(2000, 1, 1)


def earlier_bronze(
    spark: SparkSession, sf_dir: str, now: dict[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """The booking system on ``SNAPSHOT_DAY``, of which ``bronze`` is a later state: bookings made
    so far, flights of large aircraft not yet listed, and customers in debt in another segment.
    ``now`` is that later state, if the caller has it."""
    now = now or bronze(spark, sf_dir)
    debtors = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(
        F.col("c_custkey").alias("pasajero_id"), F.lit("BUILDING").alias("_segmento")
    )
    pasajeros = now["pasajeros"].join(by_rows(debtors), "pasajero_id", "left")
    return now | {
        "reservas": now["reservas"].where(F.col("fecha_reserva") < F.lit(SNAPSHOT_DAY)),
        "vuelos": now["vuelos"].where("capacidad_asientos <= 40"),
        "pasajeros": pasajeros.withColumn(
            "segmento", F.coalesce("_segmento", "segmento")
        ).drop("_segmento"),
    }


def order_states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders at the end of 1999, those of that year still open, and orders now, those before
    1996 archived."""
    orders = table(spark, sf_dir, "orders")
    then = orders.where("o_orderdate < DATE '2000-01-01'").withColumn(
        "o_orderstatus",
        F.when(F.col("o_orderdate") >= F.lit(date(1999, 1, 1)), F.lit("O"))
        .otherwise(F.col("o_orderstatus")),
    )
    return then, orders.where("o_orderdate >= DATE '1996-01-01'")
