from datetime import date

from pyspark.sql import functions as F

import pytest

from medalake.functions import (
    as_double, as_int, lower_strip, map_values, money_avg, money_sum, month_label, percent, rounded, strip,
    upper_strip, weekday,
)


def values(df):
    return [tuple(r) for r in df.collect()]


def test_strip_removes_any_whitespace(spark):
    df = spark.createDataFrame([(" Bog\t",), ("\n mde ",), ("a b",), (None,), ("  ",)], "s string")
    out = values(df.select(strip(F.col("s")), upper_strip(F.col("s")), lower_strip(F.col("s"))))
    assert out == [
        ("Bog", "BOG", "bog"), ("mde", "MDE", "mde"), ("a b", "A B", "a b"), (None, None, None),
        ("", "", ""),
    ]


def test_coercion(spark):
    texts = ["7", " 7 ", "7.9", "-7.9", "abc", "", None, "NaN"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    out = values(df.select(as_double(F.col("s")), as_int(F.col("s"))))
    assert out == [
        (7.0, 7), (7.0, 7), (7.9, 7), (-7.9, -7), (None, None), (None, None), (None, None),
        (None, None),
    ]


def test_large_integers_stay_exact(spark):
    df = spark.createDataFrame([("9007199254740993",)], "s string")
    assert values(df.select(as_int(F.col("s"), to="bigint"))) == [(9007199254740993,)]


def test_strict_cast_raises(spark):
    df = spark.createDataFrame([("abc",)], "s string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(as_double(F.col("s"), on_error="fail")).collect()
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(as_int(F.col("s"), on_error="fail")).collect()


def test_ratio(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (201, 20000), (None, 5)], "a long, b long")
    out = values(df.select(percent(F.col("a"), F.col("b"), 2)))
    assert [x for (x,) in out] == [33.33, None, 1.0, None]


def test_rounding(spark):
    numbers = [1.005, 0.125, -0.125, 2.5, -2.5, 1e12 + 0.005, None]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    got = [x for (x,) in values(df.select(rounded(F.col("x"), 2)))]
    assert got[:5] == [1.0, 0.13, -0.13, 2.5, -2.5] and got[6] is None


def test_money_does_not_depend_on_order(spark):
    amounts = [0.1, 1e9, 0.2, -1e9, 0.3] * 200
    results = set()
    for n in (1, 3, 16):
        df = spark.createDataFrame([(a,) for a in amounts], "a double").repartition(n)
        results.add(values(df.agg(money_sum(F.col("a")), money_avg(F.col("a"))))[0])
    assert results == {(120.0, 0.12)}


def test_weekday_conventions(spark):
    days = [date(2024, 2, 26), date(2024, 3, 2), date(2024, 3, 3)]  # Mon, Sat, Sun
    df = spark.createDataFrame([(d,) for d in days], "d date")
    out = values(df.select(weekday(F.col("d")), weekday(F.col("d"), "sunday")))
    assert out == [(0, 1), (5, 6), (6, 0)]
    with pytest.raises(ValueError):
        weekday(F.col("d"), "tuesday")


def test_value_map_and_label(spark):
    df = spark.createDataFrame([("nuevo", 3), ("otro", 12), (None, 1)], "s string, m int")
    mapping = {"nuevo": "ocasional"}
    out = values(
        df.select(
            map_values(F.col("s"), mapping), map_values(F.col("s"), mapping, "frecuente"),
            month_label(F.lit(2024), F.col("m")),
        )
    )
    assert out == [
        ("ocasional", "ocasional", "2024-03"), (None, "frecuente", "2024-12"),
        (None, "frecuente", "2024-01"),
    ]
