"""Sharding by jump consistent hashing, in SQL functions only.

A key walks through the numbers of shards at which it would move, drawn from a linear congruential
generator that the key seeds, and stays at the last one below the number of shards. There is no
ring to store, and one shard more moves only the rows that go to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window

from medalake.llm.common import columns, stage, table, whole_text

# Multiplier of the generator (its increment is 1) as two 32-bit halves.
MULTIPLIER = 2862933555777941757
HIGH, LOW = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF
WORD = 0xFFFFFFFF
# A walk visits about ln(shards) + 1 numbers; one that is longer than this stops the job.
MAX_JUMPS = 128
ROWS_PER_BUCKET = 20_000
COPIES_PER_BLOCK = 10_000


def stable_key(c: Column) -> Column:
    """First 64 bits of the MD5 of the key's text, as ``hi`` and ``lo`` of 32 bits. Null: empty."""
    digest = F.md5(F.coalesce(c.cast("string"), F.lit("")))
    half = lambda at: F.conv(F.substring(digest, at, 8), 16, 10).cast("bigint")
    return F.struct(half(1).alias("hi"), half(9).alias("lo"))


def _next_key(hi: Column, lo: Column) -> tuple[Column, Column]:
    """One step of the generator modulo 2**64, from products that fit in 63 bits."""
    low16, high16 = lo.bitwiseAND(0xFFFF), F.shiftright(lo, 16)
    middle = high16 * LOW
    low = low16 * LOW + F.shiftleft(middle.bitwiseAND(0xFFFF), 16) + 1
    carry = F.shiftright(low, 32) + F.shiftright(middle, 16)
    top = hi.bitwiseAND(0xFFFF) * LOW + F.shiftleft(
        (F.shiftright(hi, 16) * LOW).bitwiseAND(0xFFFF), 16
    )
    cross = (lo * HIGH).bitwiseAND(WORD)
    return (carry + top.bitwiseAND(WORD) + cross).bitwiseAND(WORD), low.bitwiseAND(WORD)


def jump_hash(key: Column, shards: int) -> Column:
    """``shard`` of a ``stable_key`` among ``shards``, and ``grown`` among one more."""
    if shards < 1:
        raise ValueError("at least one shard")
    jumps = min(shards, MAX_JUMPS) + 1

    def state(hi: Column, lo: Column, at: Column, before: Column) -> Column:
        hi, lo = _next_key(hi, lo)
        return F.struct(hi.alias("hi"), lo.alias("lo"), at.alias("at"), before.alias("before"))

    def target(s: Column) -> Column:
        draw = F.lit(float(1 << 31)) / (F.shiftright(s["hi"], 1) + 1).cast("double")
        return F.floor((s["at"] + 1).cast("double") * draw)

    zero = F.lit(0).cast("bigint")
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(jumps)),
        state(key["hi"], key["lo"], zero, zero),
        lambda s, _: F.when(
            target(s) <= shards, state(s["hi"], s["lo"], target(s), s["at"])
        ).otherwise(s),
        lambda s: F.struct(
            F.when(s["at"] == shards, s["before"]).otherwise(s["at"]).cast("int").alias("shard"),
            s["at"].cast("int").alias("grown"),
            (target(s) > shards).alias("done"),
        ),
    )
    return F.when(walked["done"], walked).otherwise(
        F.raise_error(F.lit(f"a key moved more than {jumps} times"))
    )


def shard_rows(df: DataFrame, key: str, carry: list[str], shards: int = 16) -> DataFrame:
    """Shard, slot in it and shard after growth, for each row.

    Args:
        df: rows; columns other than ``key`` and ``carry`` are left out.
        key: the column that decides, of any type that casts to text. A null key counts as empty.
        carry: further columns to return; with the key they also order the slots. They should be
            narrow: all of them pass the shuffle.
        shards: number of shards.

    Returns ``key``, ``carry``, ``shard`` int, ``slot`` bigint (gapless from 0 in each shard),
    ``grown_shard`` int. Repeated rows get slots of their own. No rows give no rows.

    A shard is numbered in buckets of about ``ROWS_PER_BUCKET`` rows: rows get a mixed order key,
    the buckets are its ranges, and a bucket's first slot is the number of rows in those before
    it. Equal rows meet as one row with their count, so a key that holds a third of all rows
    is spread over the buckets by its other columns, and its copies are unfolded in blocks.
    """
    names = [key, *carry]
    text = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in names]
    counted = columns(df, names).groupBy(*names).agg(F.count(F.lit(1)).alias("_copies"))
    walked = counted.withColumn("_jump", jump_hash(stable_key(F.col(key)), shards)).select(
        *names, "_copies", F.col("_jump.shard").alias("shard"),
        F.col("_jump.grown").alias("grown_shard"),
        F.md5(F.concat_ws("|", *text)).alias("_order"),
    )
    rows = stage(walked)
    total = rows.count()
    buckets = max(1, -(-total // (ROWS_PER_BUCKET * shards)))
    # Twice as many as whole rows need, so that even full shards give many small tasks.
    at = (F.conv(F.substring("_order", 1, 8), 16, 10).cast("bigint") * (2 * buckets)) / (1 << 32)
    rows = rows.withColumn("_bucket", F.floor(at))
    sizes = rows.groupBy("shard", "_bucket").agg(F.sum("_copies").alias("_rows"))
    # One row per bucket: a shard's buckets are its share of one row per ROWS_PER_BUCKET rows.
    before = Window.partitionBy("shard").orderBy("_bucket")
    first = sizes.select(
        "shard", "_bucket", (F.sum("_rows").over(before) - F.col("_rows")).alias("_first")
    )
    inside = Window.partitionBy("shard", "_bucket").orderBy("_order", *names)
    slots = rows.join(first, ["shard", "_bucket"]).withColumn(
        "_slot", F.col("_first") + F.sum("_copies").over(inside) - F.col("_copies")
    )
    block = F.lit(COPIES_PER_BLOCK)
    blocks = slots.withColumn("_at", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1, block)))
    copies = F.sequence(F.col("_at"), F.least(F.col("_copies"), F.col("_at") + block) - 1)
    return blocks.withColumn("_copy", F.explode(copies)).select(
        *names, "shard", (F.col("_slot") + F.col("_copy")).alias("slot"), "grown_shard"
    )


def write_shards(df: DataFrame, path: str, key: str = "doc_id", shards: int = 16) -> None:
    """Write whole rows under ``shard=<n>`` folders. A big shard is written by several tasks."""
    jump = jump_hash(stable_key(F.col(key)), shards)
    (
        df.withColumn("shard", jump["shard"])
        .hint("rebalance", "shard")
        .write.partitionBy("shard").parquet(path)
    )


def op4_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in 16 shards by ``doc_id``; sizes and checksums of their texts."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(whole_text()) + 1).cast("bigint").alias("size"),
        F.crc32(whole_text().cast("binary")).alias("text_crc32"),
    )
    placed = shard_rows(docs, "doc_id", ["size", "text_crc32"], 16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


OP4_SQL = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(
    list_prepend(i::UBIGINT, [k::UBIGINT FOR k IN range(8)]),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END
  ) ORDER BY i) AS entries FROM range(256) t(i)
), docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
    md5(coalesce(doc_id::VARCHAR, '')) AS digest FROM documents
), digests AS (
  SELECT row, doc_id, strlen(text) + 1 AS size, digest, xor(list_reduce(
      list_prepend(4294967295::UBIGINT, list_transform(
        regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::UBIGINT)),
      lambda c, b: xor(c >> 8, entries[((xor(c, b) & 255) + 1)::BIGINT])
    ), 4294967295::UBIGINT)::BIGINT AS text_crc32
  FROM docs, crc_table
), steps AS (
  SELECT row, 0::BIGINT AS spot,
    (('0x' || digest[1:16])::UBIGINT::HUGEINT * {MULTIPLIER} + 1) % 18446744073709551616 AS key
  FROM docs
  UNION ALL
  SELECT row, jump, (key * {MULTIPLIER} + 1) % 18446744073709551616 FROM (
    SELECT *, floor((spot + 1)::DOUBLE * (2147483648.0::DOUBLE
      / ((key // 8589934592) + 1)::DOUBLE))::BIGINT AS jump FROM steps) WHERE jump <= 16
), walked AS (
  SELECT row, max(spot) AS grown, max(spot) FILTER (spot < 16) AS shard FROM steps GROUP BY row
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY
    md5(concat_ws('|', coalesce(doc_id::VARCHAR, '\\N'), size, text_crc32)), doc_id) - 1 AS slot,
  grown::INTEGER AS grown_shard
FROM digests JOIN walked USING (row)
"""
