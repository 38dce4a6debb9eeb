"""Refreshes from changes against full builds over the same states."""

import pathlib
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

import bookings
from medalake.operators.changes import changed_keys, fingerprints, snapshot_changes
from medalake.operators.keys import stable_keys, with_stable_key
from medalake.operators.scd import scd2_build
from medalake.operators import keys, star as star_module
from medalake.operators.star import wide_view
from medalake.plans import gold, incremental, run
from medalake.sources.layers import complete_versions, current_version

DAYS = [datetime(2024, 3, 1), datetime(2024, 6, 1), datetime(2024, 9, 1), datetime(2025, 3, 1)]


def states():
    """The booking system on four days: tables grow, shrink and change in between."""
    full = bookings.rows()
    new_flight = ("V404", "VC404", "R1", datetime(2024, 5, 5), "A320", 150, "Aero")
    route = ("R77", "xx", "City X", "yy", "City Y", 77, True)
    out = []
    for n, day in enumerate(DAYS):
        data = {t: list(rows) for t, rows in full.items()}
        data["reservas"] = [r for r in full["reservas"] if r[4] < day]
        # Flights are listed in an order of their own, so new ones come in between.
        data["vuelos"] = [v for i, v in enumerate(full["vuelos"]) if i % 5 or n > 0]
        if n >= 1:
            data["pasajeros"] = [
                (p[0], p[1], "frecuente" if p[0] in ("P000", "P007") else p[2], p[3])
                for p in data["pasajeros"]
            ]
        if n >= 2:
            data["pasajeros"] += [("P040", "mx", "nuevo", None), ("P041", "mx", "nuevo", None)]
            data["reservas"] = [
                tuple([*r[:7], 999.0, *r[8:]]) if r[0] == "RES-00005" else r
                for r in data["reservas"] if r[0] not in ("RES-00010", "RES-00011")
            ]
            data["vuelos"] = [
                (*v[:2], "R2", *v[3:]) if v[0] == "V003" else v for v in data["vuelos"]
            ]
        if n == 3:
            data["vuelos"].append(new_flight)
            data["rutas"] = [*data["rutas"], route]
        out.append(data)
    return out


@pytest.fixture(scope="module")
def lakes(spark, tmp_path_factory):
    """One lake refreshed four times, and what each refresh counted."""
    root = str(tmp_path_factory.mktemp("grown"))
    counts = []
    for n, (data, day) in enumerate(zip(states(), DAYS)):
        run.land(bookings.source(spark, data), root, "prueba", day)
        run.refresh_silver(spark, root, by_month=True)
        counts.append(run.refresh_changes(spark, root, version=f"v{n}"))
    return root, counts


def star_at(spark, root, n):
    names = [f"dim_{d}" for d in incremental.DIMS]
    dims = [incremental.read_parts(spark, root, f"v{n}", t) for t in names]
    return run.Star(
        incremental.read_parts(spark, root, f"v{n}", "fact_reservas"), **dict(zip(incremental.DIMS, dims))
    )


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def segments(spark, upto):
    """Type-2 history from all snapshots at once."""
    log, known = [], set()
    for data, day in zip(states()[: upto + 1], DAYS):
        for p in data["pasajeros"]:
            since = day.date() if p[0] in known else date(2020, 1, 1)
            log.append((p[0], p[2].strip().lower(), since))
        known |= {p[0] for p in data["pasajeros"]}
    df = spark.createDataFrame(log, "pasajero_id string, segmento string, desde date")
    return scd2_build(df, "pasajero_id", ["segmento"], "desde")


@pytest.mark.parametrize("n", range(4))
def test_refreshes_equal_a_full_build(spark, lakes, n):
    root, counts = lakes
    star = star_at(spark, root, n)
    data = states()[n]
    facts = bookings.fact_rows(data)
    got = {r.reserva_id: r for r in wide_view(star).collect()}
    assert set(got) == set(facts)
    versions = segments(spark, n).collect()
    city = {r[0]: r[1].strip().upper() for r in data["rutas"]}
    route_of = {v[0]: v[2] for v in data["vuelos"]}
    for key, r in facts.items():
        (hit,) = [v for v in versions if v.pasajero_id == r[1]
                  and v.valido_desde <= r[4].date() <= v.valido_hasta]
        assert (got[key].precio_pagado, got[key].segmento, got[key].origen_iata, got[key].fecha) == (
            r[7], hit.segmento, city[route_of[r[2]]], r[4].date()
        )
    kept = ["pasajero_id", "segmento", "valido_desde", "valido_hasta", "activo"]
    assert rows_of(star.pasajero.select(*kept)) == rows_of(segments(spark, n).select(*kept))
    assert counts[n]["filas"] == len(bookings.clean_bookings(data))
    assert counts[n]["huerfanas"] == counts[n]["filas"] - len(facts)
    assert {r.fallos for r in run.check_gold(star).collect()} == {0}


@pytest.mark.parametrize("name", ["tiempo", "vuelo", "ruta", "canal", "pasajero"])
def test_keys_stay_over_refreshes(spark, lakes, name):
    root, _ = lakes
    key = ["pasajero_id", "valido_desde"] if name == "pasajero" else [
        incremental.NATURAL_KEYS[name]]
    before = {}
    for n in range(4):
        dim = incremental.read_parts(spark, root, f"v{n}", f"dim_{name}").collect()
        now = {tuple(r[k] for k in key): r[f"{name}_sk"] for r in dim}
        assert len(set(now.values())) == len(now)
        assert all(before[k] == sk for k, sk in now.items() if k in before)
        fresh = [sk for k, sk in now.items() if k not in before]
        assert not before or all(sk > max(before.values()) for sk in fresh)
        before |= now
    if name == "vuelo":
        ids = sorted(k[0] for k in before)
        assert [before[i,] for i in ids] != sorted(before.values())


def test_only_reached_months_are_written(spark, lakes):
    root, _ = lakes

    def months(n):
        stored = pathlib.Path(root, "gold", f"v{n}", "fact_reservas")
        return {p.name.removeprefix("anio_mes=") for p in stored.glob("anio_mes=*")}

    assert months(0) == {"2024-01", "2024-02"}
    parts = incremental.parts_of(spark, root, "v3")["fact_reservas"]
    assert set(parts) == {f"2024-{m:02}" for m in range(1, 13)}
    # Nothing but new bookings since September, and the months that a late flight reaches.
    late = {r[4].strftime("%Y-%m") for r in bookings.clean_bookings(states()[3]).values()
            if r[2] in ("V404", "V999") and r[4] < DAYS[2]}
    assert months(3) == {"2024-09", "2024-10", "2024-11", "2024-12"} | late
    assert {parts[m] for m in months(3)} == {"v3"} and {"v0", "v1", "v2"} & set(parts.values())
    # The calendar's span did not move for routes and channels: they are referred to.
    assert incremental.parts_of(spark, root, "v1")["dim_canal"] == {"": "v0"}
    fact = star_at(spark, root, 3).fact
    plan = fact.where("anio_mes = '2024-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(anio_mes" in plan


def test_late_rows_leave_the_quarantine(spark, lakes):
    root, _ = lakes

    def waiting(n):
        rows = incremental.read_parts(spark, root, f"v{n}", "cuarentena").collect()
        return {(r.reserva_id, r.motivo) for r in rows}

    missing = {r[0] for r in bookings.clean_bookings(states()[0]).values()
               if r[2] in {v[0] for v in states()[1]["vuelos"] if v[2]}
               - {v[0] for v in states()[0]["vuelos"]}}
    assert missing and {(i, "sin_vuelo_sk") for i in missing} <= waiting(0)
    assert not {i for i, _ in waiting(1)} & {
        i for i in missing if i in bookings.fact_rows(states()[1])}
    unknown = {i for i, why in waiting(1) if why == "sin_pasajero_sk"}
    assert unknown and not unknown & {i for i, w in waiting(2) if w == "sin_pasajero_sk"}
    for n in range(4):
        data = states()[n]
        orphans = set(bookings.clean_bookings(data)) - set(bookings.fact_rows(data))
        assert {i for i, _ in waiting(n)} == orphans


def test_nothing_changed_writes_no_fact(spark, lakes, tmp_path):
    root = str(tmp_path)
    data = states()[1]
    for n in range(2):
        run.land(bookings.source(spark, data), root, "prueba", datetime(2024, 6, 1, n))
        run.refresh_silver(spark, root, by_month=True)
        run.refresh_changes(spark, root, version=f"v{n}")
    second = {p.name for p in pathlib.Path(root, "gold", "v1").iterdir()}
    assert not second & {"fact_reservas", "cuarentena", *[f"dim_{d}" for d in incremental.DIMS]}
    assert rows_of(star_at(spark, root, 0).fact) == rows_of(run.read_star(spark, root).fact)


def test_dropping_old_versions_keeps_their_used_parts(spark, tmp_path):
    root = str(tmp_path)
    for n, (data, day) in enumerate(zip(states(), DAYS)):
        run.land(bookings.source(spark, data), root, "prueba", day)
        run.refresh_silver(spark, root)
        run.refresh_changes(spark, root, version=f"v{n}")
    before = rows_of(wide_view(run.read_star(spark, root)))
    incremental.drop_gold(spark, root, keep=1)
    assert complete_versions(spark, root, "gold") == ["v3"]
    assert rows_of(wide_view(run.read_star(spark, root))) == before
    assert not pathlib.Path(root, "gold", "v0", "huellas_reservas").exists()
    # An empty system: the star keeps its columns, and a later refresh fills it again.
    empty = {t: [] if t in ("reservas", "pagos") else rows for t, rows in states()[3].items()}
    for n, data in ((4, empty), (5, empty), (6, states()[3])):
        run.land(bookings.source(spark, data), root, "prueba", datetime(2025, 4, n))
        run.refresh_silver(spark, root)
        run.refresh_changes(spark, root, version=f"v{n}")
        assert run.read_star(spark, root).fact.count() == len(bookings.fact_rows(data))


def test_failed_refresh_leaves_the_version_before(spark, tmp_path):
    root = str(tmp_path)
    run.land(bookings.source(spark, states()[0]), root, "prueba", DAYS[0])
    run.refresh_silver(spark, root)
    run.refresh_changes(spark, root, version="v0")
    run.land(bookings.source(spark, states()[1]), root, "prueba", DAYS[1])
    run.refresh_silver(spark, root)
    with pytest.raises(Exception, match="dimension row"):
        run.refresh_changes(spark, root, orphans="fail", version="v1")
    assert current_version(spark, root, "gold") == "v0"
    run.refresh_changes(spark, root, version="v2")
    assert run.read_star(spark, root).fact.count() == len(bookings.fact_rows(states()[1]))


def test_untouched_passengers_are_not_shuffled(spark, lakes):
    from medalake.operators.scd import scd2_apply

    root, _ = lakes
    dim = incremental.read_parts(spark, root, "v3", "dim_pasajero")
    one = spark.createDataFrame(
        [("P001", "nuevo", "co", None, date(2025, 5, 1))],
        "pasajero_id string, segmento string, pais_residencia string, fecha_alta timestamp_ntz, desde date",
    )
    out = scd2_apply(dim, one, "pasajero_id", ["segmento"], "desde",
                     carry=["pais_residencia", "fecha_alta"], broadcast_keys=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    anti = plan.index("LeftAnti")
    # Below the anti-join the dimension's scan has no exchange of its own.
    side = plan[anti:].split("BroadcastExchange")[0]
    assert "Exchange" not in side and "FileScan" in side


def joins_of(df):
    """Kind of each join in a plan, by its first key."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    found = [re.search(r"(BroadcastHash|SortMerge)Join \[(\w+)#", x) for x in lines]
    return {m[2]: m[1] for m in found if m}


def test_stored_dimensions_are_joined_by_their_rows(spark, tmp_path, monkeypatch):
    """Their files are far below Spark's threshold, as those of millions of rows can be."""
    root, built = str(tmp_path), []
    monkeypatch.setattr(star_module, "BROADCAST_ROWS", 10, raising=False)
    real = incremental.build_fact

    def build_fact(*args, **options):
        built.append(joins_of(out := real(*args, **options)))
        return out

    monkeypatch.setattr(incremental, "build_fact", build_fact)
    data = states()[1]
    run.land(bookings.source(spark, data), root, "prueba", DAYS[1])
    run.refresh_silver(spark, root, by_month=True)
    run.refresh_changes(spark, root, version="v0")
    assert {k: built[0][k] for k in ("pasajero_id", "vuelo_id", "canal_id", "ruta_id")} == {
        "pasajero_id": "SortMerge", "vuelo_id": "SortMerge",
        "canal_id": "BroadcastHash", "ruta_id": "BroadcastHash",
    }
    wide = wide_view(run.read_star(spark, root))
    assert joins_of(wide) == {
        "pasajero_sk": "SortMerge", "vuelo_sk": "SortMerge", "tiempo_sk": "BroadcastHash",
        "canal_sk": "BroadcastHash", "ruta_sk": "BroadcastHash",
    }
    assert wide.count() == len(bookings.fact_rows(data))


def test_flights_are_numbered_once(spark, tmp_path, monkeypatch):
    """Numbering reads its input several times, so a numbering of a numbering is a plan whose text
    alone fills the driver."""
    root, numbered = str(tmp_path), []
    for module in (gold, keys):
        def surrogate_key(df, name, *args, real=module.surrogate_key, **options):
            numbered.append(name)
            return real(df, name, *args, **options)

        monkeypatch.setattr(module, "surrogate_key", surrogate_key)
    run.land(bookings.source(spark, states()[0]), root, "prueba", DAYS[0])
    run.refresh_silver(spark, root, by_month=True)
    run.refresh_changes(spark, root, version="v0")
    want = ["canal_sk", "pasajero_sk", "ruta_sk", "tiempo_sk", "vuelo_sk"]
    assert sorted(numbered) == want


def test_many_changed_passengers_are_not_broadcast(spark, tmp_path, monkeypatch):
    root, applied = str(tmp_path), []
    monkeypatch.setattr(incremental, "BROADCAST_KEYS", 0)
    real = incremental.scd2_apply

    def scd2_apply(*args, **options):
        applied.append(joins_of(out := real(*args, **options)))
        return out

    monkeypatch.setattr(incremental, "scd2_apply", scd2_apply)
    for n in range(3):
        run.land(bookings.source(spark, states()[n]), root, "prueba", DAYS[n])
        run.refresh_silver(spark, root, by_month=True)
        run.refresh_changes(spark, root, version=f"v{n}")
    assert [x["pasajero_id"] for x in applied] == ["SortMerge"] * 2
    versions = run.read_gold(spark, root, "dim_pasajero")
    want = segments(spark, 2).select("pasajero_id", "segmento", "valido_hasta", "activo")
    assert rows_of(versions.select(*want.columns)) == rows_of(want)


def test_changes_of_snapshots(spark):
    schema = "k string, v double, w string"
    old = spark.createDataFrame(
        [("a", 1.0, "x"), ("b", 2.0, None), ("c", 3.0, "y"), ("d", None, "z"), (None, 1.0, "n"),
         ("e", float("nan"), "q"), ("f", 0.0, "q")], schema)
    new = spark.createDataFrame(
        [("a", 1.0, "x"), ("b", 2.0, ""), ("d", None, "zz"), (None, 2.0, "n"), ("g", 1.0, "x"),
         ("e", float("nan"), "q"), ("f", -0.0, "q")], schema)
    got = {(r.cambio, r.k, r.v, r.w) for r in snapshot_changes(old, new, ["k"]).collect()}
    assert got == {
        ("update", "b", 2.0, ""), ("delete", "c", 3.0, "y"), ("update", "d", None, "zz"),
        ("update", None, 2.0, "n"), ("insert", "g", 1.0, "x"),
    }
    only = snapshot_changes(old, new, ["k"], compared=["v"])
    assert {(r.cambio, r.k) for r in only.collect()} == {
        ("delete", "c"), ("update", None), ("insert", "g")}
    assert snapshot_changes(old, old, ["k"]).isEmpty()
    assert snapshot_changes(old.limit(0), new.limit(0), ["k"]).isEmpty()
    assert {r.cambio for r in snapshot_changes(old.limit(0), new, ["k"]).collect()} == {"insert"}
    keep = changed_keys(fingerprints(old, ["k"], keep=["w"]), fingerprints(new, ["k"], keep=["w"]),
                        ["k"], ["w"]).where("k = 'd'").first()
    assert (keep.antes_w, keep.ahora_w) == ("z", "zz")


def test_registry_keeps_numbers(spark):
    def frame(names):
        return spark.createDataFrame([(n, n.upper()) for n in names], "id string, name string")

    first = stable_keys(frame("bdf"), "sk", ["id"])
    second = stable_keys(frame("abcf"), "sk", ["id"], first)
    third = stable_keys(frame("da"), "sk", ["id"], second)
    assert {r.id: r.sk for r in third.collect()} == {"b": 1, "d": 2, "f": 3, "a": 4, "c": 5}
    keyed = with_stable_key(frame("da"), "sk", ["id"], third)
    assert sorted(map(tuple, keyed.collect())) == [(2, "d", "D"), (4, "a", "A")]
