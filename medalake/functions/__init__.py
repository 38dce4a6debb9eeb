from medalake.functions.dates import day, month_label, weekday
from medalake.functions.numbers import as_double, as_int, money_avg, money_sum, percent, rounded
from medalake.functions.text import map_values, strip, upper_strip, lower_strip

__all__ = [
    "as_double", "as_int", "day", "lower_strip", "map_values", "money_avg", "money_sum",
    "month_label", "percent", "rounded", "strip", "upper_strip", "weekday",
]
