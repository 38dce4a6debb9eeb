"""The whole refresh on a small booking system, against row-by-row arithmetic."""

import json
import pathlib
from collections import Counter, defaultdict
from datetime import date, datetime

import pytest

import bookings
from medalake.operators.star import orphan_counts, wide_view
from medalake.plans import catalogue as cat, gold, run
from medalake.plans.silver import build_silver
from medalake.operators.scd import scd2_stats
from medalake.operators.star import Star
from medalake.sources.layers import (
    complete_versions, create_star_view, current_version, drop_versions, register_views,
    save_tables,
)

CHANGED = {"P000": date(2024, 5, 1), "P003": date(2024, 7, 9)}


@pytest.fixture(scope="module")
def data():
    return bookings.rows()


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return str(tmp_path_factory.mktemp("lake"))


@pytest.fixture(scope="module")
def star(spark, data, root):
    def changes(silver):
        return spark.createDataFrame(list(CHANGED.items()), "pasajero_id string, fecha_cambio date")

    return run.run(
        spark, bookings.source(spark, data), root, "prueba", datetime(2026, 1, 1, 10, 0), changes
    )


@pytest.fixture(scope="module")
def facts(data):
    return bookings.fact_rows(data)


def cancelled(r):
    return r[10] or 0


def test_fact_holds_every_matched_booking(star, facts):
    got = {r.reserva_id: r for r in star.fact.collect()}
    assert set(got) == set(facts)
    for key, r in facts.items():
        f = got[key]
        assert (f.precio_pagado, f.es_cancelada, f.descuento_aplicado) == (
            r[7], cancelled(r), r[9] or 0.0,
        )


def test_ledger_and_orphans_add_up(spark, star, root, data, facts):
    ledger = {r.concepto: r.filas for r in run.quality_report(spark, root)["ledger"].collect()}
    survivors = bookings.clean_bookings(data)
    assert ledger["bronze"] == len(data["reservas"]) and ledger["silver"] == len(survivors)
    assert ledger["default:canal_id"] == sum(r[3] is None for r in data["reservas"])
    removed = ("not_null", "precio_no_positivo", "anticipacion_negativa", "duplicates")
    assert ledger["bronze"] - sum(ledger[k] for k in removed) == ledger["silver"]
    summary = run.quality_report(spark, root)["summary"].first()
    assert summary.filas_silver == len(survivors)
    assert summary.monto_total == pytest.approx(sum(r[7] for r in survivors.values()), abs=1e-6)
    kept = gold.build_fact(
        run.read_silver(spark, root)["reservas"],
        Star(None, star.tiempo, star.vuelo, star.ruta, star.pasajero, star.canal), orphans="keep",
    )
    row = orphan_counts(kept, gold.FACT_KEYS).first()
    assert (row.filas, row.filas - row.huerfanas) == (len(survivors), len(facts))


def test_fail_policy_raises(spark, star, root):
    dims = Star(None, star.tiempo, star.vuelo, star.ruta, star.pasajero, star.canal)
    fact = gold.build_fact(run.read_silver(spark, root)["reservas"], dims, orphans="fail")
    with pytest.raises(Exception, match="without a dimension row"):
        fact.collect()


def test_closed_timestamp_loses_the_last_day(spark, star, root, facts):
    dims = Star(None, star.tiempo, star.vuelo, star.ruta, star.pasajero, star.canal)
    silver = run.read_silver(spark, root)["reservas"]
    closed = gold.build_fact(silver, dims, end="closed_ts")
    lost = sum(
        1 for r in facts.values()
        if r[1] in CHANGED and (CHANGED[r[1]] - r[4].date()).days == 1
        and r[4] != datetime(r[4].year, r[4].month, r[4].day)
    )
    assert lost > 0 and closed.count() == len(facts) - lost


def test_thirty_two_checks_pass(star):
    results = run.check_gold(star).collect()
    assert len(results) == 32 and {r.fallos for r in results} == {0}
    assert Counter(r.prueba for r in results) == {"not_null": 17, "unique": 10, "relationships": 5}


def test_passenger_versions(star):
    assert tuple(scd2_stats(star.pasajero, "pasajero_id").first()) == (40, 42, 2)
    history = star.pasajero.where("pasajero_id = 'P000'").orderBy("pasajero_sk").collect()
    assert [(r.valido_desde, r.valido_hasta, r.activo) for r in history] == [
        (date(2020, 1, 1), date(2024, 4, 30), False), (date(2024, 5, 1), date(9999, 12, 31), True),
    ]


def test_monthly(star, facts):
    want = defaultdict(lambda: [0, 0.0, 0])
    for r in facts.values():
        cell = want[(r[4].year, r[4].month)]
        cell[0] += 1
        cell[1] += r[7]
        cell[2] += cancelled(r)
    got = cat.monthly_revenue(star).collect()
    assert [(r.anio, r.mes) for r in got] == sorted(want)
    for r in got:
        n, revenue, lost = want[(r.anio, r.mes)]
        assert (r.reservas, r.canceladas) == (n, lost)
        assert r.ingresos_cop == pytest.approx(revenue, abs=1e-6)
        assert r.ticket_promedio == pytest.approx(revenue / n)


def test_conservation(star, facts):
    """Cells of every breakdown add up to the whole."""
    matrix = cat.day_hour_matrix(star).collect()
    assert [r.dia for r in matrix] == ["Lun", "Mar", "Mié", "Jue", "Vie", "Sáb", "Dom"]
    assert sum(v for r in matrix for v in r[1:] if v) == len(facts)
    kpis = cat.kpi_row(star).first()
    monthly = cat.monthly_trend(star).collect()
    assert sum(r.reservas for r in monthly) == kpis.confirmadas
    assert sum(r["ingresos_M_COP"] for r in monthly) / 1e3 == pytest.approx(
        kpis.ingresos_total_B_COP
    )
    assert sum(r.total for r in cat.channel_segment_conversion(star).collect()) == len(facts)
    by_channel = cat.channel_conversion(star).collect()
    assert sum(r.confirmadas for r in by_channel) == kpis.confirmadas
    assert sum(r.ingresos_cop for r in by_channel) == pytest.approx(
        sum(r[7] for r in facts.values())
    )


def test_absent_weekday_is_null(star):
    monday_only = Star(star.with_dims("tiempo").where("dia_semana = 0").select(*star.fact.columns),
                       star.tiempo)
    matrix = cat.day_hour_matrix(monday_only).collect()
    assert [r.h00 is None for r in matrix] == [False] + [True] * 6


def test_utilisation(star, data, facts):
    since = date(2024, 6, 1)
    route_of = {v[0]: v[2] for v in data["vuelos"]}
    last = max(max(r[5] for r in facts.values()), max(v[3] for v in data["vuelos"]))
    sold, capacity = Counter(), Counter()
    for r in facts.values():
        if r[4].date() >= since and not cancelled(r):
            sold[route_of[r[2]]] += r[8]
    for v in data["vuelos"]:
        if v[2] is not None and since <= v[3].date() <= last.date():
            capacity[v[2]] += v[5]
    label = {r[0]: f"{r[1].strip().upper()}→{r[3].strip().upper()}" for r in data["rutas"]}
    want = {label[k]: (sold[k], capacity[k]) for k in sold if k in capacity}
    got = cat.seat_utilisation(star, since).collect()
    assert {r.ruta: (r.asientos_vendidos, r.asientos_disponibles) for r in got} == want
    shares = [r.ocupacion_pct for r in got]
    assert shares == sorted(shares, reverse=True)


def test_wide_view_and_cards(star, facts):
    view = wide_view(star)
    assert view.count() == len(facts)
    assert cat.card_lead_and_cancelled(view).first().canceladas == sum(
        cancelled(r) for r in facts.values()
    )
    assert sum(r.reservas for r in cat.route_count_since(star, date(2020, 1, 1)).collect()) == len(
        facts
    )


def test_sql_over_views(spark, star, facts):
    register_views(star.tables())
    weekend = spark.sql("""
        WITH days AS (SELECT tiempo_sk FROM dim_tiempo WHERE es_fin_semana)
        SELECT count(*) AS n FROM fact_reservas LEFT SEMI JOIN days USING (tiempo_sk)
    """).first()
    assert weekend.n == sum(r[4].weekday() >= 5 for r in facts.values())
    create_star_view(spark, "v_prueba", temporary=True)
    view = spark.table("v_prueba")
    assert view.columns == wide_view(star).columns and view.count() == len(facts)


def test_persisted_tables(spark, star, facts):
    spark.sql("CREATE DATABASE IF NOT EXISTS reporte")
    for _ in range(2):
        counts = {r.tabla: r.filas for r in save_tables(star.tables(), "reporte").collect()}
    assert counts["fact_reservas"] == len(facts) and counts["dim_canal"] == 4
    assert len(counts) == 6
    create_star_view(spark, database="reporte")
    assert spark.table("reporte.v_reservas_full").count() == len(facts)


def test_extract_is_json(root, facts):
    def read(name):
        parts = sorted(pathlib.Path(root, "extract", name).glob("part-*.json"))
        return [json.loads(line) for p in parts for line in p.read_text().splitlines()]

    heat = read("heatmap")
    assert len(heat) == 7 and sum(sum(v or 0 for v in h["valores"]) for h in heat) == len(facts)
    assert read("kpis")[0]["total_reservas"] == len(facts)
    assert read("scd2")[0]["ids_with_history"] == 2
    assert len(read("top_rutas")) == 6


def test_fact_is_laid_out_by_month(spark, star, root):
    version = current_version(spark, root, "gold")
    stored = pathlib.Path(root, "gold", version, "fact_reservas")
    months = {p.name for p in stored.glob("anio_mes=*")}
    assert len(months) == 12
    plan = star.fact.where("anio_mes = '2024-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(anio_mes" in plan
    recent = star.booked_since(date(2024, 6, 15))
    plan = recent.fact._jdf.queryExecution().executedPlan().toString()
    assert "(anio_mes" in plan and ">= 2024-06)" in plan
    assert recent.fact.count() == star.fact.where("fecha_reserva >= '2024-06-15'").count()


def test_second_run_replaces_and_keeps_old_snapshots(spark, star, root, data, facts):
    """A rerun with fewer bookings: gold follows, the first snapshot stays readable."""
    smaller = {**data, "reservas": data["reservas"][:300]}
    again = str(pathlib.Path(root).parent / "again")
    run.run(spark, bookings.source(spark, data), again, "prueba", datetime(2026, 1, 1, 10, 0))
    second = run.run(
        spark, bookings.source(spark, smaller), again, "prueba", datetime(2026, 1, 2, 10, 0)
    )
    assert second.fact.count() == len(bookings.fact_rows(smaller))
    from medalake.sources.snapshots import list_snapshots, read_snapshot

    labels = list_snapshots(spark, again, "reservas")
    assert labels == ["20260101_1000", "20260102_1000"]
    assert read_snapshot(spark, again, "reservas", labels[0]).count() == len(data["reservas"])


def test_failed_refresh_leaves_the_star_before_it(spark, data, tmp_path):
    """An orphan stops the second refresh while the fact is written; readers never see it."""
    root = str(tmp_path)
    run.run(spark, bookings.source(spark, data), root, "prueba", datetime(2026, 1, 1, 10, 0))
    before = run.read_star(spark, root).fact.count()
    with pytest.raises(Exception, match="dimension row"):
        run.refresh_gold(spark, root, orphans="fail", version="99990101")
    assert pathlib.Path(root, "gold", "99990101").exists()
    assert "99990101" not in complete_versions(spark, root, "gold")
    assert run.read_star(spark, root).fact.count() == before
    run.refresh_gold(spark, root)
    drop_versions(spark, root, "gold", keep=1)
    assert len(complete_versions(spark, root, "gold")) == 1
    assert run.read_star(spark, root).fact.count() == before


def test_refresh_counts_orphans(spark, star, root, data, facts):
    """What was left out is counted while the fact is written, and kept beside it."""
    row = run.read_gold(spark, root, "huerfanas").first().asDict()
    assert row["filas"] == len(bookings.clean_bookings(data))
    assert row["huerfanas"] == row["filas"] - len(facts) > 0
    assert max(row[k] for k in row if k.startswith("sin_")) <= row["huerfanas"]


def test_report_counts_every_silver_table(spark, star, root, data):
    rows = {r.tabla: r.filas for r in run.quality_report(spark, root)["rows"].collect()}
    assert len(rows) == 6 and rows["reservas"] == len(bookings.clean_bookings(data))


def test_silver_same_for_any_layout(spark, data, shuffle_partitions):
    seen = set()
    for n in (1, 7, 64):
        shuffle_partitions(n)
        silver = build_silver({"reservas": bookings.source(spark, data)["reservas"].repartition(n)})
        seen.add(str(sorted(map(tuple, silver["reservas"].collect()), key=repr)))
    assert len(seen) == 1


def test_command_line(spark, data, tmp_path, capsys):
    from medalake.__main__ import main

    for name, df in bookings.source(spark, data).items():
        df.write.parquet(f"{tmp_path}/oltp/{name}")
    main(["--location", f"{tmp_path}/oltp", "--root", f"{tmp_path}/lake", "--since", "2024-06-01"])
    printed = capsys.readouterr().out
    assert "precio_no_positivo" in printed and "ocupacion_pct" in printed
