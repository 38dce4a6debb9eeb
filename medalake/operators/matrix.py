"""Pivots, trends and top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from medalake.functions.numbers import rounded


def pivot_matrix(
    cells: DataFrame, rows: Sequence[str], column: str, value: str, labels: Mapping[object, str]
) -> DataFrame:
    """Spread ``value`` over one column per entry of ``labels`` (pivot value → column name).

    The values are given, so no extra job looks for them and the schema is fixed.
    """
    spread = cells.groupBy(*rows).pivot(column, list(labels)).agg(F.first(value))
    return spread.select(*rows, *[F.col(f"`{v}`").alias(name) for v, name in labels.items()])


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First ``k`` rows under a total order; tasks keep ``k`` rows each before merging."""
    return df.orderBy(*order).limit(k)


def linear_trend(periods: DataFrame, order: Sequence[str], value: str, digits: int) -> DataFrame:
    """Least-squares line over the position of each period: slope, intercept and fitted value.

    ``periods`` is already aggregated to one row per calendar period, so its size is bounded by
    the calendar and one task is enough.
    """
    whole = Window.orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    position = F.row_number().over(Window.orderBy(*order)) - 1
    y, x = F.col(value), F.col("_x").cast("double")
    return (
        periods.withColumn("_x", position)
        .withColumn("pendiente", F.regr_slope(y, x).over(whole))
        .withColumn("intercepto", F.regr_intercept(y, x).over(whole))
        .withColumn(
            "ajuste", rounded(F.col("intercepto") + F.col("pendiente") * F.col("_x"), digits)
        )
        .withColumn("pendiente", rounded(F.col("pendiente"), digits))
        .withColumn("intercepto", rounded(F.col("intercepto"), digits))
        .drop("_x")
    )
