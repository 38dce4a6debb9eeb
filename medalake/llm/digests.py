"""Exact deduplication against a persistent index of digests.

The index is a table bucketed and sorted by digest, one row per distinct text. New documents are
counted per digest, a sort-merge anti-join against the index leaves the digests that it does not
know, and those are appended. The index is never shuffled or rewritten.
"""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from medalake.llm.common import stage, table, whole_text
from medalake.session import _file_system, _shared_folder

# A text of one in so many rows of a batch is hot, so a batch has at most so many hot texts.
HOT = 1024

INDEX_COLUMNS = "digest binary, keep_id bigint, batch string"


def digest(text: str = "text") -> Column:
    """SHA-256 of the whole text in UTF-8, null counting as empty."""
    return F.unhex(F.sha2(whole_text(text), 256))


@dataclass(frozen=True)
class DigestIndex:
    """A stored index, known to the session as the table ``name``.

    For each digest ``keep_id`` is the id of the document that stays and ``batch`` the batch that
    brought it.
    """

    spark: SparkSession
    buckets: int
    name: str

    @classmethod
    def open(cls, spark: SparkSession, folder: str, buckets: int) -> DigestIndex:
        """The index of a folder, empty if nothing was written there yet.

        ``buckets`` is fixed for the life of an index; choose it so that a bucket of the full index
        fits into a task. It is part of the stored path, so another number opens another, empty
        index and never misreads this one.
        """
        name = f"medalake_digests_{uuid4().hex}"
        place = f"{folder.rstrip('/')}/buckets_{buckets}".replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({INDEX_COLUMNS}) USING parquet CLUSTERED BY (digest) "
            f"SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
        return cls(spark, buckets, name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def unknown(self, groups: DataFrame) -> DataFrame:
        """Rows of ``groups`` whose digest the index does not know."""
        return groups.join(self.read().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, rows: DataFrame) -> None:
        """Add rows of unknown digests: every bucket gets one more sorted file."""
        dealt = rows.select("digest", "keep_id", "batch").repartition(self.buckets, "digest")
        dealt.write.format("parquet").mode("append").bucketBy(self.buckets, "digest").sortBy(
            "digest"
        ).saveAsTable(self.name)

    def close(self) -> None:
        """Forget the session's name; what is stored stays."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def deduplicate(
    docs: DataFrame, index: DigestIndex, batch: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Enter a batch of documents into ``index`` and tell which of them stay.

    Args:
        docs: the batch; columns other than ``key`` and ``text`` are left out.
        batch: the batch's name. A run repeated under its name after a failure appends what is
            missing and returns the same verdicts; under another name its documents are copies.
        key: integer id. Of the rows of a text that no earlier batch brought the one with the
            largest id stays, a null id counting as the least; of rows that repeat id and text one.
        text: compared whole and unchanged; a null text is an empty one.

    Returns one row per document: ``key``, ``keep_id`` (id of the document that stays for this
    text, which may be of an earlier batch), ``group_size`` (rows of this text in this batch),
    ``kept`` and ``text_sha256``. An empty batch gives no rows and leaves the index as it is.

    A text's copies are counted before their digest is shuffled. Rows of hot texts, of which a
    batch has at most ``HOT``, get their verdict by broadcast and are not gathered anywhere.
    """
    # Stored with numbers, so that all passes agree on which of equal rows is which.
    rows = stage(docs.select(
        F.col(key).cast("bigint").alias("id"), digest(text).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    ))
    groups = stage(
        rows.groupBy("digest").agg(
            F.max(F.struct("id", "row")).alias("last"), F.count(F.lit(1)).alias("group_size")
        ).select(
            "digest", F.col("last.id").alias("keep_id"), F.col("last.row").alias("last_row"),
            "group_size", F.lit(batch).alias("batch"),
        )
    )
    # Stored before the append, which would otherwise read the table that it writes to.
    index.append(stage(index.unknown(groups)))
    known = index.read().withColumnRenamed("batch", "brought_by").hint("merge")
    verdicts = stage(
        known.join(groups.select("digest", "last_row", "group_size", "batch"), "digest").select(
            "digest", "keep_id", "group_size",
            F.when(F.col("brought_by") == F.col("batch"), F.col("last_row")).alias("kept_row"),
        )
    )
    total = rows.count()
    hot = F.col("group_size") * HOT >= total
    few = F.broadcast(verdicts.where(hot))
    others = rows.join(F.broadcast(verdicts.where(hot).select("digest")), "digest", "left_anti")
    judged = rows.join(few, "digest").unionByName(
        others.join(verdicts.where(~hot).hint("merge"), "digest")
    )
    return judged.select(
        F.col("id").alias(key), "keep_id", "group_size",
        F.coalesce(F.col("row") == F.col("kept_row"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op12_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as one batch into an index of their own, which goes with the application."""
    path = f"{_shared_folder(spark)}/medalake-digests-{uuid4().hex}"
    fs, target = _file_system(spark, path)
    fs.deleteOnExit(target)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return deduplicate(
        table(spark, sf_dir, "documents"), DigestIndex.open(spark, path, buckets), "documents"
    )


OP12_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
