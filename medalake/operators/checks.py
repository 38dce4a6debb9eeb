"""Declared data tests: how many rows fail each one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Check:
    """``kind`` is not_null, unique or relationships; the last also names a parent table.column."""

    kind: str
    table: str
    column: str | tuple[str, ...]
    parent: str | None = None
    parent_column: str | None = None

    @property
    def label(self) -> str:
        return self.column if isinstance(self.column, str) else "+".join(self.column)


def _result(frame: DataFrame, check: Check, failures: Column) -> DataFrame:
    """One row (prueba, tabla, columna, fallos)."""
    return frame.agg(
        F.lit(check.kind).alias("prueba"),
        F.lit(check.table).alias("tabla"),
        F.lit(check.label).alias("columna"),
        failures.alias("fallos"),
    )


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Null rows of each column, all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = [
        F.struct(
            F.lit("not_null").alias("prueba"),
            F.lit(table).alias("tabla"),
            F.lit(c).alias("columna"),
            F.col(c).alias("fallos"),
        )
        for c in columns
    ]
    return counts.select(F.inline(F.array(*rows)))


def unique(df: DataFrame, check: Check) -> DataFrame:
    """Values that occur more than once; null is no value. Counted before the shuffle."""
    keys = [check.column] if isinstance(check.column, str) else list(check.column)
    repeated = F.col("_n") > 1
    for k in keys:
        repeated = repeated & F.col(k).isNotNull()
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return _result(counts, check, F.count_if(repeated))


def relationships(child: DataFrame, parent: DataFrame, check: Check) -> DataFrame:
    """Child rows whose non-null reference has no parent.

    References are counted per value first, so where the parent is too large to broadcast only
    one row per value and task is shuffled to meet it. (Spark itself moves the anti join below the
    count when the parent is small enough.)
    """
    references = child.groupBy(F.col(check.column).alias("_ref")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    known = parent.select(F.col(check.parent_column).alias("_ref"))
    lost = F.sum(F.when(F.col("_ref").isNotNull(), F.col("_n")))
    return _result(
        references.join(known, "_ref", "left_anti"), check, F.coalesce(lost, F.lit(0))
    )


def _stack(frames: list[DataFrame]) -> DataFrame:
    """Union in halves: a chain would have Spark analyse the growing union at every link."""
    if len(frames) == 1:
        return frames[0]
    middle = len(frames) // 2
    return _stack(frames[:middle]).union(_stack(frames[middle:]))


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """(prueba, tabla, columna, fallos) for every check, as one frame."""
    parts = []
    nulls = sorted((c for c in checks if c.kind == "not_null"), key=lambda c: c.table)
    for table, group in groupby(nulls, key=lambda c: c.table):
        parts.append(not_null(tables[table], table, [c.column for c in group]))
    for c in checks:
        if c.kind == "unique":
            parts.append(unique(tables[c.table], c))
        elif c.kind == "relationships":
            parts.append(relationships(tables[c.table], tables[c.parent], c))
    return _stack(parts)
