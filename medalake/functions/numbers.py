"""Numeric coercion, money and ratios."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

# Money arrives as double. Summing doubles depends on the order in which partial sums meet, so the
# same query could answer differently after a retry. Sums therefore run over whole units of the
# amounts' declared scale, as decimals without fraction: exact for amounts of that many decimals,
# whatever their size. ``money_misfits`` counts amounts with more decimals, which the ledger shows;
# a column that has them is summed with a larger scale.
MONEY_SCALE = 4
LARGE = 1 << 40


def as_double(c: Column, on_error: str = "null") -> Column:
    """Number or null (``on_error="null"``), or an error on text that is no number (``"fail"``)."""
    if on_error == "fail":
        number = c.cast("double")
        message = F.lit("a value to cast is not a number")
        return F.when(F.isnan(number), F.raise_error(message).cast("double")).otherwise(number)
    number = c.try_cast("double")
    return F.when(~F.isnan(number), number)


def as_int(c: Column, on_error: str = "null", to: str = "int") -> Column:
    """Whole number; fractions are cut towards zero, as ``"7.9"`` → 7."""
    if on_error == "fail":
        return c.cast(to)
    return F.coalesce(c.try_cast(to), as_double(c).try_cast(to))


def money_units(c: Column, scale: int = MONEY_SCALE) -> Column:
    """Amount in whole units of its declared scale, for exact sums."""
    units = F.rint(c * 10**scale)
    # A double casts to a decimal through its shortest text, which is not all of its digits beyond
    # 2**53; whole numbers keep them, large ones in two parts.
    high = F.floor(units / LARGE)
    low = (units - high.cast("double") * float(LARGE)).cast("bigint")
    large = high.cast("decimal(24,0)") * F.lit(LARGE).cast("decimal(13,0)") + low
    small = units.cast("bigint").cast("decimal(38,0)")
    return F.when(F.abs(units) < 2.0**62, small).otherwise(large.cast("decimal(38,0)"))


def from_units(units: Column, scale: int = MONEY_SCALE) -> Column:
    """A sum of units as an amount, still a decimal."""
    return units * F.lit(Decimal(1).scaleb(-scale))


def money_sum(c: Column, scale: int = MONEY_SCALE) -> Column:
    """Order-independent sum of a money column, returned as double."""
    return from_units(F.sum(money_units(c, scale)), scale).cast("double")


def money_avg(c: Column, scale: int = MONEY_SCALE) -> Column:
    """Order-independent mean of a money column, returned as double."""
    return F.try_divide(money_sum(c, scale), F.count(c))


def money_misfits(c: Column, scale: int = MONEY_SCALE) -> Column:
    """How many amounts have more decimals than their scale declares."""
    units = c * 10**scale
    # Binary fractions miss a whole number by far less than a thousandth of a unit.
    return F.count_if(F.abs(units - F.rint(units)) > 0.001)


def rounded(c: Column, digits: int) -> Column:
    """Round a double half away from zero on the scaled double, as SQL engines on C doubles do.

    Spark's ``round`` goes through the decimal text of the number and so turns 1.005 into 1.01,
    although the double is below the half.
    """
    scale = float(10**digits)
    return F.round(c * scale) / scale


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``100 * part / whole`` rounded; null when ``whole`` is zero."""
    return rounded(F.try_divide(part.cast("double") * 100, whole.cast("double")), digits)
