"""A small booking system with faults, as bronze source tables on string ids."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from medalake.schemas import BRONZE

N = 1200


def rows(seed=11):
    rng = random.Random(seed)
    cities = ["BOG", "MDE", "CTG", "MIA"]
    rutas = [
        (f"R{i}", f" {a.lower()}", f"City {a}", f"{b}\t", f"City {b}", 100 * i, b == "MIA")
        for i, (a, b) in enumerate([(a, b) for a in cities for b in cities if a < b])
    ]
    rutas.append(rutas[0])
    canales = [(1, "web ", True, "online"), (2, " app", True, "online"),
               (3, "agencia", False, "presencial"), (4, "call_center", False, "telefonico")]
    start = datetime(2024, 1, 1)
    vuelos = [
        (f"V{i:03d}", f"VC{i}", f"R{rng.randrange(6)}",
         start + timedelta(days=rng.randrange(400), hours=rng.randrange(24)),
         rng.choice([" A320 ", "A319\n"]), rng.choice([150, 180]), "Aero")
        for i in range(60)
    ]
    vuelos.append(("V998", "VC", None, start, "A320", 150, "Aero"))       # no route
    vuelos.append(("V999", "VC", "R77", start, "A320", 150, "Aero"))     # unknown route
    pasajeros = [
        (f"P{i:03d}", rng.choice(["co", " us "]), rng.choice(["Nuevo ", "ocasional", "FRECUENTE"]),
         start - timedelta(days=rng.randrange(500)))
        for i in range(40)
    ]
    reservas = []
    for i in range(N):
        at = start + timedelta(minutes=rng.randrange(60 * 24 * 365))
        lead = rng.randrange(60)
        cancelled = int(rng.random() < 0.1)
        reservas.append([
            f"RES-{i:05d}",
            "P000" if i % 3 == 0 else f"P{rng.randrange(42):03d}",       # hot and unknown ids
            rng.choice(["V998", "V999", "V404"]) if i % 97 == 0 else f"V{rng.randrange(60):03d}",
            None if i % 50 == 0 else float(rng.randrange(1, 5)),
            at, at + timedelta(days=lead), -3 if i % 211 == 0 else lead,
            -1.0 if i % 101 == 0 else round(rng.uniform(50, 900), 2),
            rng.randrange(1, 5), None if i % 60 == 0 else 0.1,
            None if i % 70 == 0 else cancelled, "cancelada " if cancelled else " Confirmada",
        ])
    reservas += [list(r) for r in reservas[:40]]                          # exact duplicates
    pagos = [(f"PG{i}", r[0], " tarjeta", "ok ", r[7]) for i, r in enumerate(reservas)]
    return {
        "rutas": rutas, "canales": canales, "vuelos": vuelos, "pasajeros": pasajeros,
        "reservas": [tuple(r) for r in reservas], "pagos": pagos,
    }


def source(spark, data=None):
    data = data or rows()
    return {t: spark.createDataFrame(data[t], BRONZE[t]).repartition(3) for t in BRONZE}


def clean_bookings(data):
    """Bookings that survive cleaning, worked out row by row."""
    kept = {}
    for r in data["reservas"]:
        if r[7] > 0 and r[6] >= 0:
            kept.setdefault(r[0], r)
    return kept


def fact_rows(data):
    """Bookings that also find every dimension row."""
    route_of = {v[0]: v[2] for v in data["vuelos"] if v[2] is not None}
    routes, people = {r[0] for r in data["rutas"]}, {p[0] for p in data["pasajeros"]}
    return {
        k: r for k, r in clean_bookings(data).items()
        if route_of.get(r[2]) in routes and r[1] in people
    }
