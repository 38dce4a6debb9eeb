"""The segment rule against a walk over every single day."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from medalake.operators.scd import scd2_build
from medalake.plans import catalogue as cat, gold

SCHEMA = "id string, at timestamp_ntz, cancelada int, precio double"
DAY = timedelta(days=1)


def bookings(seed, ids=12, start=datetime(2023, 1, 1)):
    rng = random.Random(seed)
    rows = []
    for i in range(ids):
        for _ in range(rng.choice([0, 1, 2, 7, 15, 40])):
            at = start + timedelta(days=rng.choice([rng.randrange(900), rng.randrange(30)]),
                                   hours=rng.randrange(24))
            rows.append((f"P{i}", at, int(rng.random() < 0.3), float(rng.randrange(1, 100))))
    return rows


def walk(rows):
    """Segment of each id on each day from the first booking on, counted anew for every day."""
    out = {}
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        confirmed = [r[1].date() for r in mine if not r[2]]
        d, end = min(r[1].date() for r in mine), max(r[1].date() for r in mine) + 400 * DAY
        while d <= end:
            trailing = sum(d - timedelta(days=364) <= c <= d for c in confirmed)
            known = sum(c <= d for c in confirmed)
            out[key, d] = (
                "frecuente" if trailing > 5 else "nuevo" if known <= 1 else "ocasional"
            )
            d += DAY
    return out


def versions_of(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    log = gold.segment_log(df, "id", "at", F.col("cancelada") == 0)
    return scd2_build(log, "id", ["segmento"], "fecha_cambio")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_versions_match_every_day(spark, seed):
    rows = bookings(seed)
    want = walk(rows)
    found = {}
    versions = versions_of(spark, rows).collect()
    for v in versions:
        found.setdefault(v.id, []).append(v)
    assert set(found) == {k for k, _ in want}
    for (key, d), segment in want.items():
        (hit,) = [v for v in found[key] if v.valido_desde <= d <= v.valido_hasta]
        assert hit.segmento == segment, (key, d)
    assert {v.segmento for v in versions} == {"nuevo", "ocasional", "frecuente"}


def test_state_ends_on_the_day_it_expires(spark):
    """Six bookings on 1 to 6 January 2023, none after: frequent until 31 December 2023."""
    rows = [("a", datetime(2023, 1, d, 12), 0, 1.0) for d in range(1, 7)]
    rows += [("b", datetime(2023, 1, d, 12), int(d == 3), 1.0) for d in range(1, 7)]
    got = sorted(
        (v.id, v.segmento, v.valido_desde, v.valido_hasta) for v in versions_of(spark, rows).collect()
    )
    end = date(9999, 12, 31)
    assert got == [
        ("a", "frecuente", date(2023, 1, 6), date(2023, 12, 31)),
        ("a", "nuevo", date(2023, 1, 1), date(2023, 1, 1)),
        ("a", "ocasional", date(2023, 1, 2), date(2023, 1, 5)),
        ("a", "ocasional", date(2024, 1, 1), end),
        ("b", "nuevo", date(2023, 1, 1), date(2023, 1, 1)),
        ("b", "ocasional", date(2023, 1, 2), end),
    ]


def test_cancelled_bookings_only_make_known(spark):
    rows = [("a", datetime(2023, 1, d), 1, 1.0) for d in range(1, 20)]
    rows += [("a", datetime(2023, 3, 1), 0, 1.0), (None, datetime(2023, 1, 1), 0, 1.0), ("a", None, 0, 1.0)]
    (only,) = versions_of(spark, rows).collect()
    assert (only.segmento, only.valido_desde, only.activo) == ("nuevo", date(2023, 1, 1), True)


def test_counts_and_a_hot_id(spark):
    """A third of all rows on one id: its events are summed per day before they meet."""
    rows = [("hot", datetime(2023, 1, 1 + i % 28, i % 24), 0, 1.0) for i in range(3000)]
    days = gold.segment_days(spark.createDataFrame(rows, SCHEMA), "id", "at").orderBy("dia").collect()
    assert len(days) == 56 and days[27].reservas_12m == days[-1].reservas_total == 3000
    assert days[-1].reservas_12m == 0 and days[-1].segmento == "ocasional"
    assert days[0].reservas_dia == sum(r[1].day == 1 for r in rows)


def test_revenue_and_promotion_follow_the_rule(spark):
    rows = bookings(5)
    want = walk(rows)
    versions = versions_of(spark, rows)
    df = spark.createDataFrame(rows, SCHEMA)
    revenue = {r.segmento: (r.reservas, r.ingresos) for r in cat.revenue_by_segment(
        df, versions, "id", "at", "precio").collect()}
    expected = {}
    for key, at, _, price in rows:
        n, total = expected.get(want[key, at.date()], (0, 0.0))
        expected[want[key, at.date()]] = (n + 1, total + price)
    assert revenue == expected
    once = {k for (k, _), s in want.items() if s == "ocasional"}
    row = cat.promotion_rate(versions, "id").first()
    assert row.ids == len(once) and 0 < row.promovidos <= row.ids
