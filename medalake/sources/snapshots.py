"""Bronze: immutable snapshots with audit columns, and the latest one."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from medalake.schemas import AUDIT
from medalake.sources.layers import layer_path

SNAPSHOT = "snapshot"


def snapshot_label(at: datetime) -> str:
    """Minute stamp; the underscore keeps partition inference from reading it as a number."""
    return at.strftime("%Y%m%d_%H%M")


def write_snapshot(df: DataFrame, root: str, table: str, source: str, at: datetime) -> str:
    """Land a table as one snapshot. A rerun within the same minute replaces that snapshot only.
    A table without rows is a snapshot too."""
    label = snapshot_label(at)
    (
        df.withColumn("_extraido_en", F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz"))
        .withColumn("_fuente", F.lit(source))
        .write.mode("overwrite").option("compression", "zstd")
        .parquet(f"{layer_path(root, 'bronze', table)}/{SNAPSHOT}={label}")
    )
    return label


def list_snapshots(spark: SparkSession, root: str, table: str) -> list[str]:
    """Snapshot labels, oldest first: one directory listing, no file is opened."""
    path = spark._jvm.org.apache.hadoop.fs.Path(layer_path(root, "bronze", table))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    prefix = f"{SNAPSHOT}="
    return sorted(n.removeprefix(prefix) for n in names if n.startswith(prefix))


def read_snapshot(
    spark: SparkSession,
    root: str,
    table: str,
    label: str | None = None,
    schema: str | None = None,
) -> DataFrame:
    """One snapshot, the latest unless named. Only its own directory is listed and read."""
    if label is None:
        labels = list_snapshots(spark, root, table)
        if not labels:
            raise FileNotFoundError(f"no snapshot of {table} under {root}")
        label = labels[-1]
    reader = spark.read
    if schema is not None:
        reader = reader.schema(f"{schema}, {AUDIT}")
    return reader.parquet(f"{layer_path(root, 'bronze', table)}/{SNAPSHOT}={label}")
