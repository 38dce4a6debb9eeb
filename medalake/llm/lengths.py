"""Exact histogram of encoded lengths, and what it answers for every context limit."""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, SparkSession, functions as F, Window

from medalake.llm.common import stage, table

# Distinct lengths are summed within blocks of so many numbers, then over the blocks.
BLOCK = 1024


def _encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def _encode(path: str):
    """Task: the encoded length of each text, counted up within the task's batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(path)
        for batch in batches:
            counts: dict[int, int] = {}
            for text in batch.column(0):
                value = text.as_py()
                n = len(encoding.encode_ordinary(value)) if value else 0
                counts[n] = counts.get(n, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.int64()), pa.array(counts.values(), pa.int64())],
                ["length", "docs"],
            )

    return run


def histogram(docs: DataFrame, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``length`` bigint and ``docs`` bigint: how many documents have so many ids.

    Args:
        docs: documents; columns other than ``text`` are left out, repeated rows count each time.
        text: whole text; null and empty texts have length 0.
        vocabulary: path of a rank file, by default the installed byte-level one.
    """
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    counted = docs.select(F.col(text)).mapInArrow(_encode(path), "length bigint, docs bigint")
    return counted.groupBy("length").agg(F.sum("docs").alias("docs"))


def with_suffix_sums(lengths: DataFrame) -> DataFrame:
    """Add to each distinct length what all longer or equal documents hold.

    ``docs_from`` and ``tokens_from``: documents of at least this length and their ids. ``total_docs``
    and ``total_tokens``: of all. Two levels of sums: inside blocks of ``BLOCK`` consecutive lengths,
    and over the blocks, of which there are the longest length divided by ``BLOCK`` at most.
    """
    rows = stage(lengths).withColumn("block", F.floor(F.col("length") / BLOCK))
    tokens = F.col("length") * F.col("docs")
    blocks = rows.groupBy("block").agg(F.sum("docs").alias("d"), F.sum(tokens).alias("t"))
    longer = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    zero = F.lit(0).cast("bigint")
    blocks = blocks.select(
        "block", F.coalesce(F.sum("d").over(longer), zero).alias("d"),
        F.coalesce(F.sum("t").over(longer), zero).alias("t"),
        F.sum("d").over(every).alias("total_docs"), F.sum("t").over(every).alias("total_tokens"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("length"))
    return rows.join(blocks, "block").select(
        "length", "docs",
        (F.col("d") + F.sum("docs").over(inside)).alias("docs_from"),
        (F.col("t") + F.sum(tokens).over(inside)).alias("tokens_from"),
        "total_docs", "total_tokens",
    )


def truncated_totals(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """For each context limit: ``limit_ids``, ``kept_tokens`` if every document is cut there,
    ``cut_tokens``, ``cut_docs``. All zero if there are no documents."""
    wanted = sums.sparkSession.createDataFrame([(int(n),) for n in limits], "limit_ids bigint")
    # A stated set of limits against the histogram: sums over the documents that are longer.
    over = [
        F.struct(
            F.lit(int(n)).cast("bigint").alias("limit_ids"),
            F.sum(F.when(F.col("length") > n, F.col("docs"))).alias("d"),
            F.sum(F.when(F.col("length") > n, F.col("docs") * (F.col("length") - n))).alias("t"),
        )
        for n in limits
    ]
    total = F.sum(F.col("docs") * F.col("length"))
    zero = F.lit(0).cast("bigint")
    found = sums.agg(F.array(*over).alias("x"), F.coalesce(total, zero).alias("all")).select(
        "all", F.explode("x").alias("x")
    )
    return wanted.join(found, F.col("limit_ids") == F.col("x.limit_ids")).select(
        "limit_ids", (F.col("all") - F.coalesce("x.t", zero)).alias("kept_tokens"),
        F.coalesce("x.t", zero).alias("cut_tokens"), F.coalesce("x.d", zero).alias("cut_docs"),
    )


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """Exact quantiles: for each share, the least length that so large a share of documents does
    not exceed. No documents give nulls."""
    below = F.col("total_docs") - F.col("docs_from") + F.col("docs")
    found = [
        F.struct(
            F.lit(float(q)).alias("share"),
            F.min(F.when(below >= F.ceil(F.lit(float(q)) * F.col("total_docs")), F.col("length")))
            .alias("length"),
        )
        for q in shares
    ]
    return sums.agg(F.array(*found).alias("x")).select(F.explode("x").alias("x")).select("x.*")


def op9_length_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The histogram of all documents with its suffix sums and the totals at each length.

    For limits between two lengths, ``truncated_totals`` follows from the same columns: the longer
    documents keep the limit each. ``kept_tokens`` is what remains if every document is cut at
    ``length`` ids, ``share_within`` the documents that fit whole, in millionths.
    """
    sums = with_suffix_sums(histogram(table(spark, sf_dir, "documents")))
    longer = F.col("docs_from") - F.col("docs")
    kept = F.col("total_tokens") - F.col("tokens_from") + F.col("length") * F.col("docs_from")
    within = F.floor((F.col("total_docs") - longer) * 1_000_000 / F.col("total_docs"))
    return sums.select(
        "*", kept.alias("kept_tokens"), longer.alias("cut_docs"), within.alias("share_within")
    )
