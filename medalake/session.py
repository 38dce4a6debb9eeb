"""Session settings and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this library wants, on a laptop or on a cluster. Nothing here sizes the
# cluster: shuffle parallelism, memory and executors belong to the submitter.
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when that costs one more exchange further down.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.ansi.enabled": "true",
    # Recording the call site of every column expression costs more than small queries themselves.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def submitted_session(app: str = "medalake") -> SparkSession:
    """The session of a submitted job: master and resources come from the submitter."""
    builder = SparkSession.builder.appName(app)
    for key, value in SQL_DEFAULTS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cores: int | str = "*", app: str = "medalake", **conf: str) -> SparkSession:
    """A single-JVM session for tests and benches; clusters bring their own session."""
    cores_text = str(cores)
    partitions = str(os.cpu_count() or 8) if cores_text == "*" else cores_text
    builder = (
        SparkSession.builder.master(f"local[{cores_text}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", conf.pop("driver_memory", "8g"))
        .config("spark.sql.shuffle.partitions", conf.pop("shuffle_partitions", partitions))
    )
    for key, value in {**SQL_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _shared_folder(spark: SparkSession) -> str:
    """Folder for staged tables: the one the cluster names, else a scratch folder in local mode."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="medalake-")
    context.setCheckpointDir(own)
    return own


# Staged tables of the open ``staging`` blocks, innermost last.
_open_blocks: list[list[str]] = []


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own beside the staged tables, which goes with the application."""
    path = f"{_shared_folder(spark)}/medalake-{name}-{uuid.uuid4().hex}"
    fs, target = _file_system(spark, path)
    fs.deleteOnExit(target)
    return path


def stage(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back.

    For frames several later passes read. A lost executor then re-reads a file instead of
    replaying the history, each pass reads only the columns it needs, and joins see measured
    sizes. The table goes away with the ``staging`` block around it, else with the application.
    ``compression`` is that of the files: zstd writes less than snappy, in more time.
    """
    spark = df.sparkSession
    path = f"{_shared_folder(spark)}/medalake-stage-{uuid.uuid4().hex}"
    fs, target = _file_system(spark, path)
    fs.deleteOnExit(target)
    if _open_blocks:
        _open_blocks[-1].append(path)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside the block when it ends, for work that stores its results.

    Frames that read such tables must not be used afterwards.
    """
    mine: list[str] = []
    _open_blocks.append(mine)
    try:
        yield
    finally:
        _open_blocks.remove(mine)
        for path in mine:
            fs, target = _file_system(spark, path)
            fs.delete(target, True)


def concurrently(actions: Iterable[Callable[[], object]]) -> list:
    """Submit independent Spark actions together, so that small jobs fill idle executors."""
    todo = list(actions)
    with ThreadPoolExecutor(max_workers=max(1, len(todo))) as pool:
        return [job.result() for job in [pool.submit(action) for action in todo]]


def stage_all(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``stage`` several frames that do not depend on each other."""
    staged = concurrently([lambda df=df: stage(df) for df in frames.values()])
    return dict(zip(frames, staged))
