"""Deterministic deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from medalake.session import stage

# Hashes of repeated keys up to this number are broadcast: some 60 bytes each, and up to three times
# that in the driver while it builds the broadcast.
BROADCAST_KEYS = 250_000


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """Keep the first row of each key under ``order_by``.

    ``dropDuplicates`` keeps whichever row a task met first. Here every remaining column breaks
    ties after ``order_by``, so two candidates can only tie when they are the same row and the
    result does not depend on partitioning. Spark places a group limit before the shuffle, so a
    key holding a third of the table sends one row per map task, not all its rows.
    """
    named = {o for o in order_by if isinstance(o, str)}
    rest = [c for c in df.columns if c not in named and c not in keys]
    window = Window.partitionBy(*keys).orderBy(*order_by, *rest)
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def dedupe_stored(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """``dedupe`` for rows that are cheap to read again, such as a stored table's.

    Hashes of the keys are counted first; only rows whose hash occurs more than once are then
    shuffled and ranked, all others pass as they are. Equal keys have equal hashes, so a key never
    has rows on both sides; different keys that share a hash are merely ranked without need. Telling
    rows apart by more hashes than can be broadcast would shuffle all of them twice, so all of them
    are then ranked, in one shuffle.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*keys))
    again = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_hash")
    again = stage(again)
    n = again.count()
    if not n:
        return df
    if n > BROADCAST_KEYS:
        return dedupe(df, keys, order_by)
    again = F.broadcast(again)
    once = hashed.join(again, "_hash", "left_anti").select(*df.columns)
    more = hashed.join(again, "_hash", "left_semi").select(*df.columns)
    return once.unionByName(dedupe(more, keys, order_by))
