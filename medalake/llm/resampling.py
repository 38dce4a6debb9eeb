"""Quality selection by importance resampling.

Two generative models of hashed word n-grams, one of good text and one of all text, give each
document an importance weight: the ratio of its likelihoods. Gumbel noise on the log weights turns
the k largest into a sample without replacement in proportion to the weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from medalake.llm.common import stage, table
from medalake.llm.shingles import ngram_hashes

SLOTS = 1 << 14
SIZES = (1, 2)
# The model of good text learns from at most so many labelled rows, the first by hash of their id.
MAX_LABELLED = 20_000
SMOOTHING = 1.0
# A document weighs as one of so many n-grams of its mean ratio, so that length is no merit.
TEMPERED_LENGTH = 50.0
KEEP_SHARE = 0.8
SEED = 17
# Log weights with noise as whole numbers of this fraction.
RESOLUTION = 1 << 32
RANGES = 4096


def _slots(texts: list[bytes | None]) -> list[np.ndarray]:
    """Slots of all n-grams of each text, with repeats."""
    every = [ngram_hashes(texts, size) for size in SIZES]
    return [
        (np.concatenate(parts) >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)
        for parts in zip(*every)
    ]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: n-grams by slot, of all texts and of good ones."""
    counts = np.zeros((2, SLOTS), np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            good = part.column("good").to_pylist()
            for slots, is_good in zip(_slots(part.column("text").to_pylist()), good):
                n = np.bincount(slots, minlength=SLOTS)
                counts[0] += n
                if is_good:
                    counts[1] += n
    slots = np.flatnonzero(counts[0])
    yield pa.RecordBatch.from_arrays(
        [pa.array(slots), pa.array(counts[0][slots]), pa.array(counts[1][slots])],
        ["slot", "raw", "good"],
    )


def log_ratios(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Log ratio of both models for each slot. The raw model counts every n-gram of every
    document; only the labelled rows of the good model are bounded. Without good rows it is 0."""
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    good = stage(good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED))
    marked = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(
        F.broadcast(good.withColumn("good", F.lit(True))), "doc_id", "left"
    )
    counted = marked.select("text", "good").mapInArrow(_count, "slot bigint, raw bigint, good bigint")
    rows = counted.groupBy("slot").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good"))
    rows = rows.toArrow()
    raw, target = np.zeros(SLOTS), np.zeros(SLOTS)
    at = rows.column("slot").to_numpy()
    raw[at], target[at] = rows.column("raw").to_numpy(), rows.column("good").to_numpy()
    if not target.sum():
        return np.zeros(SLOTS)
    share = lambda n: (n + SMOOTHING) / (n.sum() + SMOOTHING * SLOTS)
    return np.log(share(target)) - np.log(share(raw))


def log_weights(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """``doc_id``, ``text_key`` (hash of the text) and ``log_weight`` of each row; 0 for null texts
    and texts without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = []
            for at in range(0, batch.num_rows, 256):
                for slots in _slots(batch.column("text").slice(at, 256).to_pylist()):
                    mean = float(ratios[slots].mean()) if len(slots) else 0.0
                    weights.append(mean * TEMPERED_LENGTH)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(weights, pa.float64())],
                ["doc_id", "text_key", "log_weight"],
            )

    read = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"),
        F.col("text").cast("binary").alias("text"),
    )
    return read.mapInArrow(run, "doc_id bigint, text_key bigint, log_weight double")


def largest(df: DataFrame, column: str, k: int) -> tuple[int | None, int]:
    """The k-th largest value of a whole-number column, and how many rows of that value belong to
    the k largest. Each round counts the rows of ``RANGES`` ranges and goes on in the one that holds
    it, so the driver sees a fixed number of counts whatever the rows."""
    value = F.col(column).cast("decimal(20,0)")
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low is None or k <= 0:
        return None, 0
    while True:
        width = max(1, -(-(high - low + 1) // RANGES))
        at = F.floor((value - F.lit(low).cast("decimal(20,0)")) / F.lit(width).cast("decimal(20,0)"))
        inside = df.where(F.col(column).between(low, high))
        counts = dict(inside.groupBy(at.cast("int").alias("r")).count().collect())
        for r in sorted(counts, reverse=True):
            if counts[r] >= k:
                break
            k -= counts[r]
        else:
            return low, counts[min(counts)]
        low, high = low + r * width, min(high, low + (r + 1) * width - 1)
        if low == high:
            return low, k


def resample(
    docs: DataFrame, labels: DataFrame, share: float = KEEP_SHARE, seed: int = SEED
) -> DataFrame:
    """Draw ``share`` of the rows, those of larger importance weight likelier.

    Args:
        docs: documents with ``doc_id`` and ``text``; other columns are left out.
        labels: ``doc_id`` and ``quality`` 0 or 1, possibly null.

    Returns ``doc_id``, ``log_weight`` double, ``selected`` boolean for each row. The noise is a
    function of id, text and seed; rows that repeat both tie, and a tie at the edge is drawn by the
    hash of the stored row's place. No documents give no rows.
    """
    weighted = log_weights(docs, log_ratios(docs, labels))
    # A hash as a number strictly between 0 and 1.
    uniform = (F.xxhash64("doc_id", "text_key", F.lit(seed)).cast("double") / 2.0**64) + 0.5
    inside = F.greatest(F.lit(1e-18), F.least(F.lit(1 - 1e-15), uniform))
    noisy = F.col("log_weight") - F.log(-F.log(inside))
    keyed = stage(weighted.select(
        "doc_id", "log_weight", F.floor(noisy * RESOLUTION).cast("bigint").alias("key"),
        F.xxhash64(F.monotonically_increasing_id()).alias("place"),
    ))
    k = int(np.ceil(share * keyed.count()))
    edge, of_edge = largest(keyed, "key", k)
    if edge is None:
        return keyed.select("doc_id", "log_weight", F.lit(False).alias("selected"))
    last, _ = largest(keyed.where(F.col("key") == edge), "place", of_edge)
    chosen = (F.col("key") > edge) | ((F.col("key") == edge) & (F.col("place") >= last))
    return keyed.select("doc_id", "log_weight", chosen.alias("selected"))


def op6_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight and whether it is drawn."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
