"""Text normalisation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace of any kind; ``trim`` only removes spaces."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def upper_strip(c: Column) -> Column:
    return strip(F.upper(c))


def lower_strip(c: Column) -> Column:
    return strip(F.lower(c))


def map_values(c: Column, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Replace values through a small literal map; unmapped values become ``default``."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), c)
    return found if default is None else F.coalesce(found, F.lit(default))
