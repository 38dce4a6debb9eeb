"""Registered queries: every operator and analysis over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from medalake.functions import as_double, as_int, lower_strip, map_values, strip, upper_strip
from medalake.functions.dates import weekday
from medalake.functions.numbers import from_units, money_misfits, money_sum, money_units
from medalake.operators.calendar import bounded, calendar_dim, date_range, span_of
from medalake.operators.changes import snapshot_changes
from medalake.operators.checks import Check, run_checks
from medalake.operators.clean import clean, quality_ledger, quality_summary
from medalake.operators.dedupe import dedupe
from medalake.operators.keys import stable_keys, surrogate_key
from medalake.operators.scd import (
    pit_join, scd2_apply, scd2_from_base, scd2_stats, single_version,
)
from medalake.operators.star import (
    Star, lookup, orphan_counts, resolve_orphans, wide_view,
)
from medalake.plans import catalogue as cat, fixture as fx, run
from medalake.plans.gold import DIMS, GOLD_CHECKS, segment_days
from medalake.plans.silver import SPECS, silver_table
from medalake.session import scratch_folder, stage
from medalake.sources.publish import publish_tables

Query = Callable[[SparkSession, str], DataFrame]

SINCE = date(2000, 1, 1)
SPLIT_DAY = date(2024, 1, 15)
LATE_EPOCH = date(1997, 1, 1)

_registry: dict[str, Query] = {}


def register(fn: Query | str):
    """Register a query under its own name, or under the given one."""
    if isinstance(fn, str):
        return lambda f: _registry.setdefault(fn, f)
    return _registry.setdefault(fn.__name__, fn)


def queries() -> dict[str, Query]:
    return dict(_registry)


# --- analytical catalogue -------------------------------------------------------------------


@register
def q1_monthly(spark, sf):
    return cat.monthly_revenue(fx.orders_star(spark, sf))


@register
def q2_utilisation(spark, sf):
    return cat.seat_utilisation(fx.lines_star(spark, sf), SINCE)


@register
def q3_conversion(spark, sf):
    return cat.channel_conversion(fx.orders_star(spark, sf))


@register
def q4_lead_time(spark, sf):
    return cat.lead_time(fx.lines_star(spark, sf, routes=False))


def _events_star(spark, sf, week_start: str = "monday") -> Star:
    events = fx.table(spark, sf, "events")
    fact = events.select(
        F.col("event_id").alias("reserva_id"),
        F.to_date("ts").alias("tiempo_sk"),
        F.col("ts").alias("fecha_reserva"),
    )
    return Star(fact, tiempo=fx.day_keyed(span_of(events, "ts"), week_start))


@register
def q5_peaks(spark, sf):
    return cat.booking_peaks(_events_star(spark, sf))


@register
def q5_peaks_sunday(spark, sf):
    """The same cells over a calendar whose weeks start on Sunday."""
    return cat.booking_peaks(_events_star(spark, sf, "sunday"))


@register
def money_fine_scale(spark, sf):
    """Sums of amounts with six decimals, their scale declared; none of them misses the scale."""
    price = F.col("l_extendedprice") / 10_000
    return fx.table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        money_sum(price, 6).alias("amount"), money_misfits(price, 6).alias("misfits")
    )


@register
def money_large(spark, sf):
    """Sums of amounts far beyond what 64 bits of units hold, as exact decimal text."""
    price = F.col("o_totalprice") * 1e12
    return fx.table(spark, sf, "orders").groupBy("o_orderstatus").agg(
        from_units(F.sum(money_units(price))).cast("decimal(38,4)").cast("string").alias("amount")
    )


@register
def topk_routes(spark, sf):
    return cat.top_routes(fx.with_route(spark, sf, fx.orders_star(spark, sf)))


@register
def pivot_day_hour(spark, sf):
    return cat.day_hour_matrix(_events_star(spark, sf))


@register
def trend_monthly(spark, sf):
    return cat.monthly_trend(fx.orders_star(spark, sf))


@register
def kpi_row(spark, sf):
    return cat.kpi_row(fx.lines_star(spark, sf, routes=False))


@register
def conversion_long(spark, sf):
    return cat.channel_segment_conversion(fx.orders_star(spark, sf))


@register
def pivot_channel_segment(spark, sf):
    return cat.channel_segment_matrix(fx.orders_star(spark, sf), fx.SEGMENTS)


@register
def pivot_channel_segment_sum(spark, sf):
    return cat.channel_segment_revenue(fx.orders_star(spark, sf), fx.SEGMENTS)


@register
def card_route_count_since(spark, sf):
    return cat.route_count_since(fx.with_route(spark, sf, fx.orders_star(spark, sf)), SINCE)


@register
def card_monthly_revenue(spark, sf):
    return cat.card_monthly_revenue(wide_view(fx.lines_star(spark, sf)))


@register
def card_lead_and_cancelled(spark, sf):
    return cat.card_lead_and_cancelled(wide_view(fx.lines_star(spark, sf)))


@register
def bench_a(spark, sf):
    return cat.monthly_confirmed(fx.orders_star(spark, sf))


@register
def bench_a_rowstore_form(spark, sf):
    bookings = fx.table(spark, sf, "orders").select(
        F.col("o_orderdate").alias("fecha_reserva"),
        F.col("o_totalprice").alias("precio_pagado"),
        F.when(fx.cancelled() == 1, "CANCELADA").otherwise("CONFIRMADA").alias("estado"),
    )
    return cat.monthly_confirmed_plain(bookings)


@register
def bench_b(spark, sf):
    orders = fx.table(spark, sf, "orders")
    return cat.full_scan(orders.withColumnRenamed("o_totalprice", "precio_pagado"))


# --- cleaning and quality -------------------------------------------------------------------


@register
def clean_silver(spark, sf):
    return clean(fx.table(spark, sf, "lineitem"), fx.LINE_SPEC)


@register
def dedupe_keep_first(spark, sf):
    lines = fx.table(spark, sf, "lineitem")
    return dedupe(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])


@register("quality_ledger")
def _ledger(spark, sf):
    return quality_ledger(fx.table(spark, sf, "lineitem"), fx.LINE_SPEC)


@register("quality_summary")
def _summary(spark, sf):
    lines = fx.table(spark, sf, "lineitem")
    return quality_summary(lines, clean(lines, fx.LINE_SPEC), "l_extendedprice")


def _gapped_orders(spark, sf):
    return fx.table(spark, sf, "orders").withColumn("o_orderpriority", fx.named_priority())


@register
def filter_not_null(spark, sf):
    return _gapped_orders(spark, sf).na.drop(subset=["o_orderpriority"])


@register
def filter_ne_nullsafe(spark, sf):
    return _gapped_orders(spark, sf).where(
        ~F.col("o_orderpriority").eqNullSafe(F.lit("5-LOW"))
    )


@register
def filter_positive(spark, sf):
    return fx.table(spark, sf, "customer").where(F.col("c_acctbal") > 0)


@register
def filter_lead_time(spark, sf):
    lines, orders = fx.table(spark, sf, "lineitem"), fx.table(spark, sf, "orders")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", fx.lead_days().alias("dias_anticipacion")
    ).where(F.col("dias_anticipacion") >= 0)


@register
def normalise_text(spark, sf):
    padded = F.concat(F.lit(" \t"), F.lower("n_name"), F.lit(" \n"))
    return fx.table(spark, sf, "nation").select(
        "n_nationkey",
        upper_strip(padded).alias("upper_name"),
        lower_strip(F.concat(F.lit("  "), "n_name")).alias("lower_name"),
        strip(padded).alias("strip_name"),
    )


@register
def cast_coerce(spark, sf):
    digit = F.substring("o_orderpriority", 1, 1)
    price = F.col("o_totalprice").cast("string")
    return fx.table(spark, sf, "orders").select(
        "o_orderkey",
        as_int(digit).alias("channel"),
        as_int(price, to="bigint").alias("whole_price"),
        as_double(price).alias("price"),
        as_double(F.col("o_orderpriority")).alias("not_a_number"),
    )


@register
def cast_strict(spark, sf):
    orders = fx.table(spark, sf, "orders")
    day_text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return orders.select(
        "o_orderkey",
        as_int(F.substring("o_orderpriority", 1, 1), on_error="fail").alias("channel"),
        as_double(F.col("o_totalprice").cast("string"), on_error="fail").alias("price"),
        day_text.cast("date").alias("day"),
        F.concat(day_text, F.lit(" 10:30:00")).cast("timestamp_ntz").alias("moment"),
        F.when(fx.cancelled() == 1, "true").otherwise("false").cast("boolean").alias("cancelled"),
    )


@register
def default_nulls(spark, sf):
    return _gapped_orders(spark, sf).fillna({"o_orderpriority": "4-CALL CENTER"})


@register
def value_map(spark, sf):
    promoted = {"BUILDING": "HOUSEHOLD", "HOUSEHOLD": "MACHINERY"}
    return fx.table(spark, sf, "customer").select(
        "c_custkey", map_values(F.col("c_mktsegment"), promoted, "TOP").alias("promoted")
    )


# --- dimensions, keys and lookups -----------------------------------------------------------


def _calendar(spark, sf):
    orders, lines = fx.table(spark, sf, "orders"), fx.table(spark, sf, "lineitem")
    return calendar_dim(
        date_range(
            (orders, "o_orderdate", "o_orderdate"), (lines, "l_shipdate", "l_shipdate")
        )
    )


@register
def dim_calendar(spark, sf):
    return _calendar(spark, sf)


@register
def weekday_conventions(spark, sf):
    """Weekday from Monday and from Sunday, and days covered by the least and greatest date."""
    lines, orders = fx.table(spark, sf, "lineitem"), fx.table(spark, sf, "orders")
    span = date_range((orders, "o_orderdate", "o_orderdate"), (lines, "l_shipdate", "l_shipdate"))
    return calendar_dim(span, week_start="sunday").select(
        "fecha",
        F.col("dia_semana").alias("desde_domingo"),
        weekday(F.col("fecha")).alias("desde_lunes"),
    )


@register
def calendar_join(spark, sf):
    events = fx.table(spark, sf, "events")
    calendar = bounded(calendar_dim(span_of(events, "ts")))
    return events.withColumn("fecha", F.to_date("ts")).join(calendar, "fecha").select(
        "event_id", "tiempo_sk", "fecha", "dia_nombre"
    )


@register("surrogate_key")
def _surrogate_key_dim(spark, sf):
    customers = fx.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return surrogate_key(customers, "customer_sk", ["c_custkey"])


@register
def two_hop_lookup(spark, sf):
    """Line → order → customer; the second hop is resolved on the orders side."""
    customers = fx.table(spark, sf, "customer")
    orders = lookup(
        fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey"),
        customers, {"o_custkey": "c_custkey"}, ["c_nationkey"],
    )
    return lookup(
        fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"),
        orders, {"l_orderkey": "o_orderkey"}, ["o_custkey", "c_nationkey"],
    )


def _event_fact(spark, sf):
    events, customers = fx.table(spark, sf, "events"), fx.table(spark, sf, "customer")
    calendar = calendar_dim(span_of(events, "ts"))
    history = stage(fx.event_versions(events))
    versions = surrogate_key(history, "version_sk", ["user_id", "valido_desde"])
    kinds = events.select("event_type").distinct()
    kinds = surrogate_key(kinds, "tipo_sk", ["event_type"], small=True)
    homes = surrogate_key(customers.select("c_custkey", "c_nationkey"), "cliente_sk", ["c_custkey"])
    nations = surrogate_key(
        fx.table(spark, sf, "nation").select("n_nationkey"), "nacion_sk", ["n_nationkey"],
        small=True,
    )
    homes = lookup(homes, nations, {"c_nationkey": "n_nationkey"}, ["nacion_sk"])
    fact = events.select("event_id", "ts", "user_id", "event_type", "value")
    fact = lookup(
        fact.withColumn("_dia", F.to_date("ts")), calendar, {"_dia": "fecha"}, ["tiempo_sk"],
        small=True,
    )
    fact = lookup(fact, kinds, "event_type", ["tipo_sk"])
    fact = lookup(fact, homes, {"user_id": "c_custkey"}, ["cliente_sk", "nacion_sk"])
    return pit_join(fact, versions, "user_id", "ts", ["version_sk"])


EVENT_KEYS = ("tiempo_sk", "tipo_sk", "cliente_sk", "nacion_sk", "version_sk")


@register
def fact_build(spark, sf):
    fact = resolve_orphans(_event_fact(spark, sf), EVENT_KEYS)
    return fact.select("event_id", *EVENT_KEYS, "ts", "value")


def _supplied(spark, sf):
    events = fx.table(spark, sf, "events").select("event_id", "user_id", "value")
    suppliers = fx.table(spark, sf, "supplier").withColumn("supplier_sk", F.col("s_suppkey") + 1)
    return lookup(events, suppliers, {"user_id": "s_suppkey"}, ["supplier_sk"])


@register
def orphan_drop(spark, sf):
    return resolve_orphans(_supplied(spark, sf), ["supplier_sk"])


@register
def orphan_report(spark, sf):
    return orphan_counts(_supplied(spark, sf), ["supplier_sk"])


@register
def union_by_name(spark, sf):
    customers = fx.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
    )
    suppliers = fx.table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
    )
    return customers.unionByName(suppliers)


@register
def star_wide_view(spark, sf):
    return wide_view(fx.lines_star(spark, sf))


# --- slowly changing dimensions -------------------------------------------------------------


def _versions(spark, sf):
    return fx.event_versions(fx.table(spark, sf, "events"))


@register
def scd2_build(spark, sf):
    return _versions(spark, sf)


@register("scd2_apply")
def _scd2_incremental(spark, sf):
    events = fx.table(spark, sf, "events")
    # The dimension an increment meets is a stored table.
    first = stage(fx.event_versions(events.where(F.col("ts") < F.lit(SPLIT_DAY))))
    later = events.where(F.col("ts") >= F.lit(SPLIT_DAY))
    return scd2_apply(
        first, later, "user_id", ["event_type"], "ts", order_by=["ts", "event_id"]
    )


@register
def scd2_promote(spark, sf):
    """Base table plus change dates; the new value follows from the old through a map."""
    base = fx.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segmento"), "c_nationkey"
    )
    changes = (
        fx.table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
        .groupBy(F.col("o_custkey").alias("id")).agg(F.min("o_orderdate").alias("fecha_cambio"))
    )
    return scd2_from_base(
        base, changes, "id", "segmento", "fecha_cambio", fx.EPOCH,
        promotion={"BUILDING": "HOUSEHOLD", "HOUSEHOLD": "MACHINERY"}, fallback="MACHINERY",
    )


def _day_changes(spark, sf):
    """Every day on which a customer had a cancelled order."""
    return (
        fx.table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
        .select(F.col("o_custkey").alias("id"), F.col("o_orderdate").alias("fecha_cambio"))
    )


def _promoted(spark, sf, changes, epoch):
    base = fx.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segmento"), "c_nationkey"
    )
    return scd2_from_base(
        base, changes, "id", "segmento", "fecha_cambio", epoch,
        promotion={"BUILDING": "HOUSEHOLD", "HOUSEHOLD": "MACHINERY"}, fallback="MACHINERY",
    )


@register
def scd2_promote_many(spark, sf):
    """Several changes per id: each promotes what the one before made."""
    return _promoted(spark, sf, _day_changes(spark, sf), fx.EPOCH)


@register
def scd2_change_before_epoch(spark, sf):
    """First changes on either side of the epoch: the base state ends where the first one begins."""
    first = _day_changes(spark, sf).groupBy("id").agg(F.min("fecha_cambio").alias("fecha_cambio"))
    return _promoted(spark, sf, first, LATE_EPOCH)


@register
def scd2_late_rows(spark, sf):
    """A batch with older rows than the one before it, applied with the ids' history at hand."""
    events = fx.table(spark, sf, "events")
    early = F.pmod("event_id", F.lit(3)) != 0
    history = events.where(early)
    first = stage(fx.event_versions(history))
    return scd2_apply(
        first, events.where(~early), "user_id", ["event_type"], "ts",
        order_by=["ts", "event_id"], history=history,
    )


@register("scd2_stats")
def _scd2_counts(spark, sf):
    return scd2_stats(_versions(spark, sf), "user_id")


def _pit(spark, sf, **options):
    events = fx.table(spark, sf, "events")
    versions = fx.event_versions(events).withColumnRenamed("event_type", "estado")
    facts = events.select("event_id", "user_id", "ts")
    return pit_join(facts, versions, "user_id", "ts", ["estado", "valido_desde"], **options)


@register("pit_join")
def _pit_lookup(spark, sf):
    return _pit(spark, sf)


@register
def pit_join_closed_ts(spark, sf):
    return _pit(spark, sf, end="closed_ts", how="inner")


@register
def dim_single_version(spark, sf):
    base = fx.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return single_version(base)


@register
def semi_changed(spark, sf):
    versions = _versions(spark, sf)
    changed = versions.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return (
        fx.table(spark, sf, "customer").select("c_custkey", "c_name")
        .join(changed, F.col("c_custkey") == F.col("user_id"), "left_semi")
    )


@register
def rolling_segment(spark, sf):
    """Counts and segment of each customer on every day on which they can change."""
    orders = fx.table(spark, sf, "orders")
    return segment_days(orders, "o_custkey", "o_orderdate", fx.cancelled() == 0)


def _segment_input(spark, sf):
    orders = fx.table(spark, sf, "orders")
    bookings = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return bookings, fx.customer_segments(orders)


@register
def revenue_by_segment_asof(spark, sf):
    bookings, versions = _segment_input(spark, sf)
    return cat.revenue_by_segment(bookings, versions, "o_custkey", "o_orderdate", "o_totalprice")


@register
def promotion_rate(spark, sf):
    return cat.promotion_rate(_segment_input(spark, sf)[1], "o_custkey")


@register
def pre_post_change(spark, sf):
    bookings, versions = _segment_input(spark, sf)
    return cat.behaviour_by_version(
        bookings, versions, "o_custkey", "o_orderdate", "o_totalprice"
    )


# --- states of the source compared ------------------------------------------------------------


@register("snapshot_changes")
def _snapshot_changes(spark, sf):
    """Inserted, updated and deleted orders between two states of the table."""
    return snapshot_changes(*fx.order_states(spark, sf), ["o_orderkey"])


@register("stable_keys")
def _stable_keys(spark, sf):
    """Keys of all customers where customers in debt were numbered a run before."""
    customer = fx.table(spark, sf, "customer")
    first = stage(stable_keys(customer.where("c_acctbal < 0"), "c_sk", ["c_custkey"]))
    return stable_keys(customer, "c_sk", ["c_custkey"], first)


def _grown_lake(spark, sf, states: int) -> str:
    """A lake after refreshes from the earlier and, for two ``states``, the present bronze."""
    root = scratch_folder(spark, "lake")
    now = fx.bronze(spark, sf)
    if states == 2:
        # Bookings and flights are made from orders and their lines once for both states.
        for made in ("reservas", "vuelos"):
            now[made] = stage(now[made], "zstd")
    days = (fx.SNAPSHOT_DAY - timedelta(days=1), fx.SNAPSHOT_DAY)
    for state, day in list(zip((fx.earlier_bronze(spark, sf, now), now), days))[:states]:
        run.land(state, root, "fixture", day)
        run.refresh_silver(spark, root, by_month=True)
        run.refresh_changes(spark, root, fx.EPOCH, version=f"{day:%Y%m%d}")
    return root


@register
def gold_incremental(spark, sf):
    """The wide view of a star that a second refresh brought up to date."""
    return wide_view(run.read_star(spark, _grown_lake(spark, sf, 2)))


@register
def gold_incremental_pasajero(spark, sf):
    """Passenger versions after the second refresh, with keys that the first one gave."""
    return run.read_gold(spark, _grown_lake(spark, sf, 2), "dim_pasajero")


@register
def gold_quarantine(spark, sf):
    """Bookings that the first refresh could not place, by reason."""
    return run.read_gold(spark, _grown_lake(spark, sf, 1), "cuarentena")


@register
def published_views(spark, sf):
    """Customers by segment and nation through views that a second publication has switched."""
    database = f"medalake_{uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_folder(spark, 'published')}'")
    customer, nation = (fx.table(spark, sf, t) for t in ("customer", "nation"))
    before = customer.where("c_acctbal >= 0").withColumn("c_mktsegment", F.lit("BUILDING"))
    for version, rows in (("first", before), ("second", customer)):
        publish_tables(spark, {"clientes": rows, "paises": nation}, database, version)
    seen = spark.table(f"{database}.clientes").join(
        spark.table(f"{database}.paises"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return seen.groupBy("c_mktsegment", "n_name").agg(F.count(F.lit(1)).alias("clientes"))


# --- declared tests -------------------------------------------------------------------------


def _checked(spark, sf, *checks):
    names = ("customer", "supplier", "nation", "lineitem", "events")
    tables = {t: fx.table(spark, sf, t) for t in names}
    tables["orders"] = _gapped_orders(spark, sf)
    return run_checks(tables, checks)


@register
def dq_not_null(spark, sf):
    return _checked(
        spark, sf,
        *[Check("not_null", "orders", c) for c in ("o_orderkey", "o_orderpriority")],
        *[Check("not_null", "lineitem", c) for c in ("l_orderkey", "l_shipdate")],
        Check("not_null", "customer", "c_custkey"),
    )


@register
def dq_unique(spark, sf):
    return _checked(
        spark, sf,
        Check("unique", "orders", "o_orderkey"),
        Check("unique", "orders", "o_orderpriority"),
        Check("unique", "lineitem", ("l_orderkey", "l_linenumber")),
        Check("unique", "customer", "c_custkey"),
    )


@register
def dq_relationships(spark, sf):
    return _checked(
        spark, sf,
        Check("relationships", "events", "user_id", "supplier", "s_suppkey"),
        Check("relationships", "orders", "o_custkey", "customer", "c_custkey"),
        Check("relationships", "lineitem", "l_orderkey", "orders", "o_orderkey"),
        Check("relationships", "customer", "c_nationkey", "nation", "n_nationkey"),
    )


# --- silver and gold from raw tables --------------------------------------------------------


def _silver(name: str) -> Query:
    return lambda spark, sf: silver_table(name, fx.bronze(spark, sf)[name])


for _name in SPECS:
    _registry[f"silver_{_name}"] = _silver(_name)


@register
def booking_ledger(spark, sf):
    return quality_ledger(fx.bronze(spark, sf)["reservas"], SPECS["reservas"])


def _gold_dim(name: str) -> Query:
    return lambda spark, sf: fx.gold_dim(spark, sf, name)


for _name in DIMS:
    _registry[f"gold_dim_{_name}"] = _gold_dim(_name)


@register
def gold_fact_reservas(spark, sf):
    return fx.gold_star(spark, sf).fact


GOLD_SEGMENTS = ("frecuente", *(s.lower() for s in fx.SEGMENTS))
GOLD_QUERIES = {
    "gold_monthly": cat.monthly_revenue,
    "gold_utilisation": lambda star: cat.seat_utilisation(star, SINCE),
    "gold_conversion": cat.channel_conversion,
    "gold_lead_time": cat.lead_time,
    "gold_top_routes": cat.top_routes,
    "gold_kpi_row": cat.kpi_row,
    "gold_channel_segment": lambda star: cat.channel_segment_matrix(star, GOLD_SEGMENTS),
    "gold_route_count_since": lambda star: cat.route_count_since(star, SINCE),
    "gold_wide_view": wide_view,
    # Every check reads the fact, so it is stored once.
    "gold_checks": lambda star: run_checks(
        replace(star, fact=stage(star.fact)).tables(), GOLD_CHECKS
    ),
}


def _on_gold(query) -> Query:
    return lambda spark, sf: query(fx.gold_star(spark, sf))


for _name, _query in GOLD_QUERIES.items():
    _registry[_name] = _on_gold(_query)
