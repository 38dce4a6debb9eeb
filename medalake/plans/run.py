"""Bronze → silver → gold on storage, and the star read back from it."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from medalake.operators.checks import run_checks
from medalake.operators.clean import quality_ledger, quality_summary
from medalake.operators.scd import DW_EPOCH, scd2_stats
from medalake.operators.star import MONTH, Star, by_rows, orphan_measures, resolve_orphans
from medalake.plans import catalogue, silver as silver_plan
from medalake.plans.gold import DIMS, FACT_KEYS, GOLD_CHECKS, build_dim_table, build_fact
from medalake.plans.incremental import read_parts, refresh_changed, with_month
from medalake.schemas import BRONZE, TABLES
from medalake.session import concurrently, staging
from medalake.sources.jdbc import Split, read_jdbc
from medalake.sources.layers import (
    current_version, in_splits, json_document, mark_complete, read_layer, write_document, write_extract,
    write_layer,
)
from medalake.sources.snapshots import read_snapshot, write_snapshot


Changes = Callable[[Mapping[str, DataFrame]], DataFrame | None]


# Catalogue tables of a handful of rows; all others need a split to be read in parallel.
SMALL_TABLES = ("rutas", "canales")


def parquet_source(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {t: spark.read.schema(BRONZE[t]).parquet(f"{root.rstrip('/')}/{t}") for t in TABLES}


def jdbc_source(
    spark: SparkSession, url: str, splits: Mapping[str, Split], **properties: str
) -> dict[str, DataFrame]:
    return {
        t: read_jdbc(spark, url, t, splits.get(t), small=t in SMALL_TABLES, **properties)
        for t in TABLES
    }


def open_source(
    spark: SparkSession, mode: str, location: str, splits: Mapping[str, Split] | None = None,
    **properties: str,
) -> dict[str, DataFrame]:
    """The six source tables from Parquet folders or over JDBC."""
    if mode == "parquet":
        return parquet_source(spark, location)
    if mode == "jdbc":
        return jdbc_source(spark, location, splits or {}, **properties)
    raise ValueError(f"mode must be 'parquet' or 'jdbc', not {mode!r}")


def land(source: Mapping[str, DataFrame], root: str, name: str, at: datetime) -> str:
    """Extract: every source table as a bronze snapshot."""
    labels = concurrently(
        [lambda t=t, df=df: write_snapshot(df, root, t, name, at) for t, df in source.items()]
    )
    return labels[0]


def refresh_silver(
    spark: SparkSession, root: str, on_error: str = "null", by_month: bool = False
) -> None:
    """Clean the latest snapshots. ``by_month`` stores bookings by month, for ``refresh_changes``,
    which then reads no more than the months that it builds. They are not shuffled for that: a month
    has as many files as tasks had rows of it, and whoever reads it takes several files to a task."""

    def refresh(table: str) -> None:
        bronze = read_snapshot(spark, root, table)
        silver = silver_plan.silver_table(table, bronze, on_error, stored=True)
        if by_month and table == "reservas":
            write_layer(
                with_month(silver), root, "silver", table, partition_by=[MONTH], rebalance=False
            )
        else:
            write_layer(silver, root, "silver", table)

    with staging(spark):
        concurrently([lambda t=t: refresh(t) for t in TABLES])


def read_silver(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {t: read_layer(spark, root, "silver", t).drop(MONTH) for t in TABLES}


def refresh_gold(
    spark: SparkSession,
    root: str,
    changes: Changes | None = None,
    epoch: date = DW_EPOCH,
    orphans: str = "drop",
    end: str = "date",
    week_start: str = "monday",
    version: str | None = None,
) -> dict[str, int]:
    """Model silver as a star, and return what ``orphan_counts`` counts of its fact.

    Each refresh writes a version of its own and marks it complete as the last step; readers take
    the newest complete one, so a refresh that fails half-way leaves the star before it in place.
    Dimensions are written first, so the fact reads stored keys and measured sizes; the fact is
    laid out by booking month for partition pruning. Bookings without a dimension row are counted
    while the fact is written, whatever becomes of them, and the counts are kept beside it.
    """
    with staging(spark):
        return _refresh_gold(spark, root, changes, epoch, orphans, end, week_start, version)


def _refresh_gold(spark, root, changes, epoch, orphans, end, week_start, version):
    silver = read_silver(spark, root)
    changed = changes(silver) if changes else None
    version = version or datetime.now().strftime("%Y%m%d_%H%M%S_%f")
    gold = f"gold/{version}"

    def refresh(name: str) -> None:
        dim = build_dim_table(name, silver, changed, epoch, week_start)
        write_layer(dim, root, gold, f"dim_{name}")

    concurrently([lambda n=n: refresh(n) for n in DIMS])
    stored = {name: read_layer(spark, root, gold, f"dim_{name}") for name in DIMS}
    found = build_fact(silver["reservas"], Star(None, **stored), "keep", end, stored=True)
    seen = Observation()
    fact = resolve_orphans(found.observe(seen, *orphan_measures(FACT_KEYS)), FACT_KEYS, orphans)
    by_month = fact.withColumn(MONTH, F.date_format("fecha_reserva", "yyyy-MM"))
    write_layer(by_month, root, gold, "fact_reservas", partition_by=[MONTH])
    counts = dict(seen.get)
    row = spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} bigint" for c in counts))
    write_layer(row, root, gold, "huerfanas")
    mark_complete(spark, root, "gold", version)
    return counts


def refresh_changes(
    spark: SparkSession, root: str, epoch: date = DW_EPOCH, as_of: date | None = None,
    orphans: str = "drop", end: str = "date", week_start: str = "monday",
    version: str | None = None,
) -> dict[str, int]:
    """``refresh_gold`` from what changed in silver since the version before; see
    ``plans.incremental``. Passengers' changes come from the data: a new segment in a snapshot is
    valid from that snapshot's day on."""
    silver = {t: read_layer(spark, root, "silver", t) for t in TABLES}
    if MONTH in silver["reservas"].columns:
        silver["reservas"] = in_splits(silver["reservas"], root, "silver", "reservas")
    return refresh_changed(spark, root, silver, epoch, as_of, orphans, end, week_start, version)


def read_gold(spark: SparkSession, root: str, table: str) -> DataFrame:
    """One table of the newest complete star."""
    return read_parts(spark, root, current_version(spark, root, "gold"), table)


def read_star(spark: SparkSession, root: str) -> Star:
    version = current_version(spark, root, "gold")

    def dim(name: str) -> DataFrame:
        return by_rows(read_parts(spark, root, version, f"dim_{name}"))

    dims = dict(zip(DIMS, concurrently([lambda n=n: dim(n) for n in DIMS])))
    return Star(read_parts(spark, root, version, "fact_reservas"), **dims)


def quality_report(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Ledger and summary of the booking table's cleaning, and rows of every silver table."""
    bronze = read_snapshot(spark, root, "reservas")
    silver = read_silver(spark, root)
    rows = [
        df.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(t).alias("tabla"), "filas")
        for t, df in silver.items()
    ]
    return {
        "ledger": quality_ledger(bronze, silver_plan.SPECS["reservas"]),
        "summary": quality_summary(bronze, silver["reservas"], "precio_pagado"),
        "rows": reduce(DataFrame.union, rows),
    }


def check_gold(star: Star) -> DataFrame:
    return run_checks(star.tables(), GOLD_CHECKS)


def serving_results(star: Star) -> dict[str, DataFrame]:
    """Result sets behind the dashboard."""
    matrix = catalogue.day_hour_matrix(star)
    hours = [c for c in matrix.columns if c != "dia"]
    return {
        "top_rutas": catalogue.top_routes(star),
        "heatmap": matrix.select("dia", F.array(*hours).alias("valores")),
        "mensual": catalogue.monthly_trend(star),
        "kpis": catalogue.kpi_row(star),
        "conversion": catalogue.channel_segment_conversion(star),
        "scd2": scd2_stats(star.pasajero, "pasajero_id"),
    }


def serving_document(star: Star, timings: DataFrame | None = None) -> DataFrame:
    """The dashboard's one JSON document: ``serving_results`` under the names its reader expects.

    ``timings`` are rows (query, sqlite_ms, duckdb_ms, factor) of a comparison made elsewhere.
    """
    spark = star.fact.sparkSession
    found = serving_results(star)
    monthly = found["mensual"].select("anio", "mes", "ingresos_M_COP", "reservas", "periodo")
    names = {name: i for i, name in enumerate(catalogue.WEEKDAYS.values())}
    day = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col("dia")]
    if timings is None:
        schema = "query string, sqlite_ms double, duckdb_ms double, factor double"
        timings = spark.createDataFrame([], schema)
    lists = {
        "top_rutas": (found["top_rutas"], [F.desc("ingresos_M_COP"), "ruta"]),
        "heatmap": (found["heatmap"], [day]),
        "mensual": (monthly, ["anio", "mes"]),
        "conversion": (found["conversion"], ["canal", "segmento"]),
        "benchmark": (timings, ["query"]),
    }
    objects = {
        "kpis": found["kpis"].select(
            F.col("tasa_cancelacion_pct").alias("tasa_cancelacion"), "ticket_promedio",
            F.col("ventana_media_dias").alias("ventana_dias"),
            F.col("ingresos_total_B_COP").alias("ingresos_B"), "total_reservas", "confirmadas",
        ),
        "scd2": found["scd2"].select(
            F.col("ids").alias("pasajeros_unicos"), F.col("versions").alias("filas_dim"),
            F.col("ids_with_history").alias("con_versiones"),
        ),
    }
    return json_document(spark, lists, objects)


def run(
    spark: SparkSession,
    source: Mapping[str, DataFrame],
    root: str,
    name: str,
    at: datetime,
    changes: Changes | None = None,
    epoch: date = DW_EPOCH,
    incremental: bool = False,
) -> Star:
    """Whole refresh: land, clean, model, publish the serving extract. ``incremental`` models what
    changed since the version before; changes of passengers then come from the snapshots."""
    if incremental and changes:
        raise ValueError("an incremental refresh finds the changes itself")
    land(source, root, name, at)
    refresh_silver(spark, root, by_month=incremental)
    if incremental:
        refresh_changes(spark, root, epoch)
    else:
        refresh_gold(spark, root, changes, epoch)
    star = read_star(spark, root)
    write_extract(serving_results(star), f"{root.rstrip('/')}/extract")
    write_document(serving_document(star), f"{root.rstrip('/')}/data.json")
    return star
