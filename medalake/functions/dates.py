"""Calendar helpers on ``date`` and ``timestamp_ntz`` columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def day(ts: Column) -> Column:
    """Day of a timestamp as a date; ``date_trunc`` would turn ntz into a zoned timestamp."""
    return F.to_date(ts)


def weekday(d: Column, week_start: str = "monday") -> Column:
    """Day number within the week from 0, counted from Monday (default) or from Sunday."""
    if week_start == "monday":
        return F.weekday(d)
    if week_start == "sunday":
        return F.dayofweek(d) - 1
    raise ValueError(f"week_start must be 'monday' or 'sunday', not {week_start!r}")


def month_label(year: Column, month: Column) -> Column:
    """``YYYY-MM``."""
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))
