import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from medalake.operators.calendar import calendar_dim, date_range, span_of
from medalake.operators.keys import surrogate_key


@pytest.mark.parametrize("partitions", [1, 4, 64])
@pytest.mark.parametrize("kind", ["int", "string", "pair"])
def test_keys_equal_position(spark, shuffle_partitions, partitions, kind):
    shuffle_partitions(partitions)
    rng = random.Random(partitions)
    ids = rng.sample(range(100_000), 1500)
    if kind == "pair":
        rows = [(f"P{i % 7}", i) for i in ids]
        df, order = spark.createDataFrame(rows, "a string, b int"), ["a", "b"]
    elif kind == "string":
        rows = [(f"RES-{i:09d}",) for i in ids]
        df, order = spark.createDataFrame(rows, "a string"), ["a"]
    else:
        rows = [(i,) for i in ids]
        df, order = spark.createDataFrame(rows, "a int"), ["a"]
    keyed = surrogate_key(df.repartition(partitions + 2), "sk", order)
    got = sorted((r.sk, *[r[c] for c in order]) for r in keyed.collect())
    assert got == [(n, *row) for n, row in enumerate(sorted(rows), start=1)]


def test_keys_handle_null_empty_and_start(spark):
    df = spark.createDataFrame([(3,), (None,), (1,)], "a int")
    assert [(r.sk, r.a) for r in surrogate_key(df, "sk", ["a"]).orderBy("sk").collect()] == [
        (1, None), (2, 1), (3, 3),
    ]
    assert surrogate_key(df.limit(0), "sk", ["a"]).count() == 0
    last = spark.createDataFrame([(40,)], "m long")
    assert {r.sk for r in surrogate_key(df, "sk", ["a"], start=last).collect()} == {41, 42, 43}
    empty = last.where("m < 0").agg(F.max("m"))
    assert {r.sk for r in surrogate_key(df, "sk", ["a"], start=empty).collect()} == {1, 2, 3}


def test_keys_never_gather_the_table(spark):
    df = spark.range(1000).withColumnRenamed("id", "a")
    plan = surrogate_key(df, "sk", ["a"])._jdf.queryExecution().executedPlan().toString()
    window = plan.index("row_number")
    assert "hashpartitioning(_bucket" in plan[window: window + 1200]


def test_key_buckets_are_balanced(spark):
    from medalake.operators import keys

    df = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("a"))
    key = F.struct("a")
    cuts = keys._cut_points(df, key, 16)
    sizes = keys._with_bucket(df, key, cuts).groupBy("_bucket").count().collect()
    assert len(sizes) == 16 and max(r["count"] for r in sizes) < 3 * 20_000 / 16


def test_calendar(spark):
    df = spark.createDataFrame(
        [(datetime(2023, 12, 30, 23, 59), datetime(2024, 3, 3, 0, 1))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    rows = calendar_dim(span_of(df, "a", "b")).orderBy("fecha").collect()
    assert [r.tiempo_sk for r in rows] == list(range(1, 66))
    by_day = {r.fecha: r for r in rows}
    leap, sunday, new_year = (
        by_day[date(2024, 2, 29)], by_day[date(2024, 3, 3)], by_day[date(2024, 1, 1)]
    )
    assert (leap.mes_nombre, leap.dia_nombre, leap.es_temporada_alta) == (
        "February", "Thursday", False,
    )
    assert (sunday.dia_semana, sunday.es_fin_semana) == (6, True)
    assert (new_year.anio, new_year.trimestre, new_year.es_temporada_alta) == (2024, 1, True)
    assert by_day[date(2023, 12, 31)].trimestre == 4
    from_sunday = calendar_dim(span_of(df, "a", "b"), "sunday").collect()
    sundays = {r.fecha: r.dia_semana for r in from_sunday}
    assert sundays[date(2024, 3, 3)] == 0


def test_date_range_over_frames(spark):
    a = spark.createDataFrame([(date(2024, 1, 5), date(2024, 1, 9))], "x date, y date")
    b = spark.createDataFrame([(date(2024, 1, 2),), (None,)], "z date")
    assert tuple(date_range((a, "x", "y"), (b, "z", "z")).first()) == (
        date(2024, 1, 2), date(2024, 1, 9),
    )
    backwards = spark.createDataFrame([(date(2024, 1, 5), date(2024, 1, 2))], "x date, y date")
    assert calendar_dim(date_range((backwards, "x", "y"))).count() == 0
    nothing = calendar_dim(date_range((a.where("x > y"), "x", "y")))
    assert nothing.count() == 0


def test_calendar_of_a_sentinel_date_is_refused(spark):
    bounds = spark.createDataFrame([(date(2024, 1, 1), date(9999, 12, 31))], "lo date, hi date")
    with pytest.raises(Exception, match="too long"):
        calendar_dim(bounds).count()
