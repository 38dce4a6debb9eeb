"""Declarative cleaning with a quality ledger."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from medalake.functions.numbers import as_double, as_int, money_sum, percent
from medalake.functions.text import lower_strip, strip, upper_strip
from medalake.operators.dedupe import dedupe, dedupe_stored

_TEXT = {"upper": upper_strip, "lower": lower_strip, "strip": strip}


@dataclass(frozen=True)
class CleanSpec:
    """How to turn one bronze table into its silver table.

    ``rules`` are (name, SQL predicate) pairs a row must satisfy; a null outcome fails. They apply
    in order, after the not-null check, and each counts only rows that survived the ones before.
    ``on_error`` says what becomes of a value that cannot be cast: ``null`` or ``fail``.
    """

    key: Sequence[str]
    text: Mapping[str, str] = field(default_factory=dict)
    casts: Mapping[str, str] = field(default_factory=dict)
    defaults: Mapping[str, object] = field(default_factory=dict)
    not_null: Sequence[str] = ()
    rules: Sequence[tuple[str, str]] = ()
    order_by: Sequence[str] = ()
    on_error: str = "null"


def cast_column(df: DataFrame, name: str, to: str, on_error: str) -> Column:
    c = F.col(name)
    if to == "double":
        return as_double(c, on_error)
    if to in ("int", "bigint"):
        exact = isinstance(df.schema[name].dataType, NumericType) and on_error == "fail"
        return c.cast(to) if exact else as_int(c, on_error, to)
    return c.cast(to) if on_error == "fail" else c.try_cast(to)


def conform(df: DataFrame, spec: CleanSpec, flags: bool = False) -> DataFrame:
    """Normalised text, cast types and defaults; ``flags`` adds ``_null_<column>`` per default."""
    typed = df.withColumns({c: _TEXT[how](F.col(c)) for c, how in spec.text.items()})
    typed = typed.withColumns(
        {c: cast_column(typed, c, to, spec.on_error) for c, to in spec.casts.items()}
    )
    if flags:
        typed = typed.withColumns({f"_null_{c}": F.col(c).isNull() for c in spec.defaults})
    filled = {
        c: F.coalesce(F.col(c), F.lit(v).cast(typed.schema[c].dataType))
        for c, v in spec.defaults.items()
    }
    return typed.withColumns(filled) if filled else typed


def clean(df: DataFrame, spec: CleanSpec, stored: bool = False) -> DataFrame:
    """The silver rows, in one pass with one shuffle, for the dedupe. Checks on columns taken as
    they are reach the scan; checks on cast columns run right above it. A ``stored`` table is read
    once more instead, and only rows whose key may repeat are shuffled."""
    out = conform(df, spec)
    if spec.not_null:
        out = out.na.drop(subset=list(spec.not_null))
    for _, predicate in spec.rules:
        out = out.where(predicate)
    return (dedupe_stored if stored else dedupe)(out, spec.key, spec.order_by)


def _first_failure(spec: CleanSpec) -> Column:
    """Position of the first step a row fails (0 = not-null check), null for survivors."""
    steps = []
    if spec.not_null:
        present = F.col(spec.not_null[0]).isNotNull()
        for c in spec.not_null[1:]:
            present = present & F.col(c).isNotNull()
        steps.append((0, present))
    steps += [(i, F.expr(p)) for i, (_, p) in enumerate(spec.rules, start=1)]
    failure = F.lit(None).cast("int")
    for position, holds in reversed(steps):
        failure = F.when(F.coalesce(holds, F.lit(False)), failure).otherwise(F.lit(position))
    return failure


def _tally(df: DataFrame, spec: CleanSpec, amount: str | None = None) -> DataFrame:
    """One row of counts from a single scan.

    Failing rows share one null key per step; survivors are counted per key before the shuffle, so
    neither a common failure nor a heavily duplicated key gathers rows in one task.
    """
    marked = conform(df, spec, flags=True).withColumn("_step", _first_failure(spec))
    survived = F.col("_step").isNull()
    nulls = [f"_null_{c}" for c in spec.defaults]
    per_key = marked.groupBy(
        "_step", *[F.when(survived, F.col(k)).alias(f"_key_{i}") for i, k in enumerate(spec.key)]
    ).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(n)).alias(n) for n in nulls]
    )

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    return per_key.agg(
        total(F.col("_n")).alias("bronze"),
        *[total(F.col(n)).alias(n) for n in nulls],
        *[
            total(F.when(F.col("_step") == i, F.col("_n"))).alias(f"_step_{i}")
            for i in range(len(spec.rules) + 1)
        ],
        total(F.when(survived, F.col("_n") - 1)).alias("duplicates"),
        F.count_if(survived).alias("silver"),
    )


def quality_ledger(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """(paso, concepto, filas): input, nulls defaulted, rows removed by each step, output."""
    entries = [("bronze", "bronze")]
    entries += [(f"default:{c}", f"_null_{c}") for c in spec.defaults]
    entries += [("not_null", "_step_0")] if spec.not_null else []
    entries += [(name, f"_step_{i}") for i, (name, _) in enumerate(spec.rules, start=1)]
    entries += [("duplicates", "duplicates"), ("silver", "silver")]
    rows = [
        F.struct(F.lit(i).alias("paso"), F.lit(label).alias("concepto"), F.col(c).alias("filas"))
        for i, (label, c) in enumerate(entries)
    ]
    return _tally(df, spec).select(F.inline(F.array(*rows)))


def quality_summary(bronze: DataFrame, silver: DataFrame, amount: str) -> DataFrame:
    """One row: rows before and after, rows removed, percentage kept, total amount after."""
    before = bronze.agg(F.count(F.lit(1)).alias("n")).scalar()
    return silver.agg(
        F.count(F.lit(1)).alias("filas_silver"), money_sum(F.col(amount)).alias("monto_total")
    ).select(
        before.alias("filas_bronze"),
        "filas_silver",
        (before - F.col("filas_silver")).alias("filas_eliminadas"),
        percent(F.col("filas_silver"), before, 1).alias("pct_retenido"),
        "monto_total",
    )
