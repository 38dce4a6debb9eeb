"""Dense surrogate keys without a single-partition sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

SAMPLE_PER_BUCKET = 16
MIN_BUCKETS = 8
# Rows in a bucket: one task sorts them. Their number grows with the root of the table's, so that
# neither the buckets nor the cut points between them grow as fast as the table.
LEAST_ROWS = 100_000
ROWS_PER_ROOT = 10


def _bucket_count(rows: Column) -> Column:
    root = F.sqrt(rows.cast("double")) * ROWS_PER_ROOT
    wanted = F.ceil(rows / F.greatest(F.lit(float(LEAST_ROWS)), root))
    return F.greatest(F.lit(MIN_BUCKETS), wanted).cast("int")


def _cut_points(df: DataFrame, key: Column, buckets: int | None) -> DataFrame:
    """One row with a sorted array of cut points, one less than buckets.

    The sample keeps the keys whose hash falls in one residue class, the class count growing with
    the table so that about ``SAMPLE_PER_BUCKET`` keys per bucket remain. It is uniform over
    distinct keys and the same on every attempt. Cut points only balance the buckets; any set of
    them yields the same final numbering.
    """
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    count = F.lit(buckets) if buckets else _bucket_count(rows)
    classes = F.greatest(F.lit(1), F.floor(rows / (count * SAMPLE_PER_BUCKET)))
    sample = (
        df.select(key.alias("k"), count.alias("n"))
        .where(F.pmod(F.xxhash64("k"), classes) == 0)
        .agg(F.array_sort(F.collect_set("k")).alias("s"), F.max("n").alias("n"))
    )
    share = F.size("s") / F.col("n")
    every = F.when(F.col("n") > 1, F.sequence(F.lit(1), F.col("n") - 1)).otherwise(
        F.array().cast("array<int>")
    )
    return sample.select(
        F.transform(every, lambda i: F.get("s", F.floor(i * share).cast("int"))).alias("_cuts")
    )


def _with_bucket(df: DataFrame, key: Column, cuts: DataFrame) -> DataFrame:
    """Bucket = number of cut points below the key, found by binary search."""
    searched = df.select("*", key.alias("_k"), cuts.scalar().alias("_cuts"))
    steps = F.transform(
        F.sequence(
            F.ceil(F.log2(F.size("_cuts") + 1)).cast("int"), F.lit(0), F.lit(-1)
        ),
        lambda k: F.pow(F.lit(2), k).cast("int"),
    )

    def advance(below: Column, step: Column) -> Column:
        return F.when(F.get("_cuts", below + step - 1) < F.col("_k"), below + step).otherwise(below)

    return searched.select(
        *df.columns, F.aggregate(steps, F.lit(0), advance).alias("_bucket")
    )


def surrogate_key(
    df: DataFrame,
    name: str,
    order_by: Sequence[str],
    start: DataFrame | None = None,
    buckets: int | None = None,
    small: bool = False,
) -> DataFrame:
    """Prepend ``name``: 1..n as bigint in the order of ``order_by``.

    ``order_by`` must identify a row; the numbering then depends on the data alone, not on files
    or partitions. ``row_number() over (order by …)`` moves the whole table through one task.
    Here rows are split into ordered buckets, numbered inside each bucket, and shifted by the
    running size of the buckets before. Everything stays lazy and on executors.

    ``start``: optional one-row frame whose single column is the last key already in use.
    ``small``: the caller declares a table of a handful of rows by construction, such as routes or
    channels; it is numbered in one task without the passes that find and size the buckets.
    """
    if small:
        number = F.row_number().over(Window.orderBy(*order_by))
        last = F.lit(0) if start is None else F.coalesce(start.scalar(), F.lit(0))
        return df.select((number + last).cast("bigint").alias(name), *df.columns)
    key = F.struct(*[F.col(c) for c in order_by])
    cuts = _cut_points(df, key, buckets)
    # The size pass reads only the key columns.
    sizes = _with_bucket(df.select(*order_by), key, cuts).groupBy("_bucket").count()
    # At most ``buckets`` rows from here: one task and a broadcast are both bounded.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("count").over(before), F.lit(0))
    offsets = sizes.select("_bucket", offset.alias("_offset"))
    if start is not None:
        last = F.coalesce(start.scalar(), F.lit(0))
        offsets = offsets.select("_bucket", (F.col("_offset") + last).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order_by))
    return (
        _with_bucket(df, key, cuts)
        .withColumn("_inside", inside)
        .join(F.broadcast(offsets), "_bucket")
        .select((F.col("_offset") + F.col("_inside")).cast("bigint").alias(name), *df.columns)
    )


def stable_keys(
    df: DataFrame, name: str, natural_key: Sequence[str], registry: DataFrame | None = None,
    small: bool = False,
) -> DataFrame:
    """Registry of surrogate keys after ``df``: natural key and ``name`` of every row ever seen.

    A natural key keeps the number that the ``registry`` of the run before gives it, also while its
    row is gone; new ones follow the highest number in natural-key order. Without a registry this
    numbers as ``surrogate_key`` does. Natural keys must not be null.
    """
    if registry is None:
        return surrogate_key(df.select(*natural_key), name, natural_key, small=small)
    new = df.select(*natural_key).join(registry, list(natural_key), "left_anti")
    last = registry.agg(F.max(name).alias("last"))
    keyed = surrogate_key(new, name, natural_key, start=last, small=small)
    return registry.select(name, *natural_key).unionByName(keyed)


def with_stable_key(
    df: DataFrame, name: str, natural_key: Sequence[str], registry: DataFrame
) -> DataFrame:
    """Prepend ``name`` as ``registry``, made by ``stable_keys`` over ``df``, has it."""
    return df.join(registry, list(natural_key)).select(name, *df.columns)
