"""Reading and writing layer tables, views, persisted tables and the serving extract."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from medalake.operators.star import WIDE_COLUMNS, WIDE_DIMS


# Tasks for each core that a table of small files is read by at least.
TASKS_PER_CORE = 4


def layer_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def read_layer(
    spark: SparkSession, root: str, layer: str, table: str, schema: str | None = None
) -> DataFrame:
    """One table of a layer. A declared schema skips footer inference."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(layer_path(root, layer, table))


def in_splits(df: DataFrame, root: str, layer: str, table: str) -> DataFrame:
    """A stored table of many small files, read by as many tasks as its bytes make splits.

    Spark takes a file for 4 MB at least, and so makes a task of every few small files; each of them
    costs the driver memory in every pass. Tasks take more files here, and nothing is shuffled.
    """
    spark = df.sparkSession
    fs, target = _file_system(spark, layer_path(root, layer, table))
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    splits = -(-fs.getContentSummary(target).getLength() // split)
    return df.coalesce(max(splits, TASKS_PER_CORE * spark.sparkContext.defaultParallelism))


def write_layer(
    df: DataFrame, root: str, layer: str, table: str, partition_by: Sequence[str] = (),
    rebalance: bool = True,
) -> None:
    """Replace one table of a layer.

    Partitioned tables are rebalanced on the partition columns first: one task per small
    partition, several for a partition too large for one, instead of every task writing a file
    into every partition. Without ``rebalance`` they are not shuffled, and each task writes its
    own file into every partition that it has rows of. Layers are written once and read often, so files are small (zstd).
    """
    cols = [F.col(c) for c in partition_by]
    out = df.hint("rebalance", *cols) if cols and rebalance else df
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer = writer.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(layer_path(root, layer, table))


COMPLETE = "_complete"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def mark_complete(spark: SparkSession, root: str, layer: str, version: str) -> None:
    """Declare a version of a layer readable: the last step of writing it, an empty file."""
    fs, target = _file_system(spark, f"{layer_path(root, layer, COMPLETE)}/{version}")
    fs.create(target, True).close()


def complete_versions(spark: SparkSession, root: str, layer: str) -> list[str]:
    """Versions of a layer that were written to the end, oldest first."""
    fs, target = _file_system(spark, layer_path(root, layer, COMPLETE))
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def current_version(spark: SparkSession, root: str, layer: str) -> str:
    versions = complete_versions(spark, root, layer)
    if not versions:
        raise FileNotFoundError(f"no complete version of {layer} under {root}")
    return versions[-1]


def list_tables(spark: SparkSession, root: str, layer: str) -> list[str]:
    """Names of the folders of a layer, or of a table's partitions."""
    fs, target = _file_system(spark, f"{root.rstrip('/')}/{layer}")
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


def drop_path(spark: SparkSession, root: str, path: str) -> None:
    fs, target = _file_system(spark, f"{root.rstrip('/')}/{path}")
    fs.delete(target, True)


def drop_versions(spark: SparkSession, root: str, layer: str, keep: int) -> None:
    """Delete all but the newest complete versions: the mark first, then the tables."""
    for version in complete_versions(spark, root, layer)[: -max(1, keep)]:
        for part in (f"{COMPLETE}/{version}", version):
            fs, target = _file_system(spark, layer_path(root, layer, part))
            fs.delete(target, True)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Name frames so that SQL text can query them."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def save_tables(tables: Mapping[str, DataFrame], database: str | None = None) -> DataFrame:
    """Persist each frame as a catalog table, one at a time, leaving other tables alone.

    Returns (tabla, filas) counted from what was written.
    """
    counts = None
    for name, df in tables.items():
        target = f"{database}.{name}" if database else name
        df.write.mode("overwrite").format("parquet").saveAsTable(target)
        row = df.sparkSession.table(target).agg(F.count(F.lit(1)).alias("filas"))
        row = row.select(F.lit(name).alias("tabla"), "filas")
        counts = row if counts is None else counts.union(row)
    return counts


def create_star_view(
    spark: SparkSession,
    name: str = "v_reservas_full",
    database: str | None = None,
    temporary: bool = False,
) -> None:
    """Wide view over the star's tables: persisted ones of ``database``, or temporary views."""
    prefix = f"{database}." if database else ""
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    target = name if temporary else f"{prefix}{name}"
    # The columns are those of ``wide_view``, qualified because dimensions share column names.
    columns = ", ".join(f"{text} AS {column}" for column, text in WIDE_COLUMNS.items())
    joins = " ".join(
        f"JOIN {prefix}dim_{d} {d} ON fact.{d}_sk = {d}.{d}_sk" for d in WIDE_DIMS
    )
    spark.sql(
        f"CREATE OR REPLACE {kind} {target} AS SELECT {columns} "
        f"FROM {prefix}fact_reservas fact {joins}"
    )


def write_extract(results: Mapping[str, DataFrame], root: str) -> None:
    """Serving extract: one JSON-lines dataset per result set."""
    for name, df in results.items():
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(
            f"{root.rstrip('/')}/{name}"
        )


# A list in a serving document has no more rows than this: a consumer reads it whole.
DOCUMENT_ROWS = 10_000


def json_document(
    spark: SparkSession,
    lists: Mapping[str, tuple[DataFrame, Sequence[Column | str]]],
    objects: Mapping[str, DataFrame],
) -> DataFrame:
    """One row with one JSON object (``value``): ``lists`` as arrays of objects in the given order,
    one-row ``objects`` as objects, both under their names with their columns' types and names.

    Nulls are written. A list of more than ``DOCUMENT_ROWS`` rows is an error, met before they are
    gathered; an object without a row is null.
    """
    parts = []
    for name, (df, order) in lists.items():
        row = F.struct(F.row_number().over(Window.orderBy(*order)).alias("n"), F.struct("*").alias("r"))
        # One more than allowed is enough to know.
        rows = df.limit(DOCUMENT_ROWS + 1).select(row.alias("row"))
        message = F.lit(f"{name} has more than {DOCUMENT_ROWS} rows")
        checked = F.when(
            F.count(F.lit(1)) > DOCUMENT_ROWS, F.raise_error(message).cast("int")
        ).otherwise(0)
        sorted_rows = F.transform(F.array_sort(F.collect_list("row")), lambda x: x["r"])
        parts.append(
            rows.agg(sorted_rows.alias("rows"), checked.alias("ok"))
            .select(F.when(F.col("ok") == 0, F.col("rows")).alias("rows")).scalar().alias(name)
        )
    for name, df in objects.items():
        parts.append(df.select(F.struct("*")).scalar().alias(name))
    options = {"ignoreNullFields": "false"}
    return spark.range(1).select(F.to_json(F.struct(*parts), options).alias("value"))


def write_document(document: DataFrame, path: str) -> None:
    """Write a one-row text frame as the single file ``path``, replacing it in one rename."""
    spark = document.sparkSession
    folder = f"{path}.tmp"
    document.coalesce(1).write.mode("overwrite").text(folder)
    fs, written = _file_system(spark, folder)
    (part,) = [f.getPath() for f in fs.listStatus(written) if f.getPath().getName().startswith("part-")]
    _, target = _file_system(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    kind = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    target = fs.makeQualified(target)
    context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(part), target, how)
    fs.delete(written, True)
