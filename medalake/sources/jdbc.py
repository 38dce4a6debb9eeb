"""Relational extract over JDBC, read by many tasks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

FETCH_SIZE = 10_000


@dataclass(frozen=True)
class RangeSplit:
    """Ranges of a numeric, date or timestamp column.

    The bounds only shape the ranges; rows outside them, and nulls, are still read.
    """

    column: str
    lower: str
    upper: str
    partitions: int


@dataclass(frozen=True)
class KeySplit:
    """Ranges of a text key between sorted cut points.

    Cut points are sorted here by code point, so the database has to compare the same way, else
    ranges overlap or leave gaps. Name a binary collation of the database in ``collation`` (such as
    ``"C"`` or ``BINARY``), unless the column has one already; ``HashSplit`` needs no order.
    """

    column: str
    cuts: Sequence[str]
    collation: str | None = None

    def predicates(self) -> list[str]:
        column = f"{self.column} COLLATE {self.collation}" if self.collation else self.column
        quoted = ["'" + c.replace("'", "''") + "'" for c in sorted(self.cuts)]
        if not quoted:
            return ["1 = 1"]
        first = f"{column} < {quoted[0]} OR {self.column} IS NULL"
        middle = [f"{column} >= {lo} AND {column} < {hi}" for lo, hi in zip(quoted, quoted[1:])]
        return [first, *middle, f"{column} >= {quoted[-1]}"]


@dataclass(frozen=True)
class HashSplit:
    """Residue classes of a whole-number expression that the database computes, such as its hash
    of a key. Needs no order and no cut points; nulls go to the first class."""

    expression: str
    partitions: int

    def predicates(self) -> list[str]:
        n, e = self.partitions, self.expression
        classes = [f"MOD(MOD({e}, {n}) + {n}, {n}) = {i}" for i in range(n)]
        return [f"{classes[0]} OR ({e}) IS NULL", *classes[1:]]


Split = RangeSplit | KeySplit | HashSplit


def range_options(split: RangeSplit) -> dict[str, str]:
    return {
        "partitionColumn": split.column,
        "lowerBound": split.lower,
        "upperBound": split.upper,
        "numPartitions": str(split.partitions),
    }


def bounds_query(table: str, column: str) -> str:
    """Subquery the database answers with one row (lo, hi)."""
    return f"(SELECT min({column}) AS lo, max({column}) AS hi FROM {table}) bounds"


def measure_split(
    spark: SparkSession, url: str, table: str, column: str, partitions: int, **properties: str
) -> RangeSplit:
    """A split over the actual range of ``column``; only its two ends reach the driver."""
    row = spark.read.jdbc(url, bounds_query(table, column), properties=properties).first()
    return RangeSplit(column, str(row[0]), str(row[1]), partitions)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    split: Split | None = None,
    small: bool = False,
    **properties: str,
) -> DataFrame:
    """A whole table. Without a split one task would read all of it, which only a table declared
    ``small`` may do. Filters and column selections on the result reach the database."""
    if split is None and not small:
        raise ValueError(f"give {table} a split, or declare it small")
    properties = {"fetchsize": str(FETCH_SIZE), **properties}
    if isinstance(split, (KeySplit, HashSplit)):
        return spark.read.jdbc(url, table, predicates=split.predicates(), properties=properties)
    options = {"url": url, "dbtable": table, **properties}
    if split is not None:
        options |= range_options(split)
    return spark.read.format("jdbc").options(**options).load()
