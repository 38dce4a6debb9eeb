"""Tables published in versions behind views that one insert switches together."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

# Names of the table of published versions, of the stored tables, and of their version column.
PUBLISHED, STORED, VERSION = "publicadas", "todas_{}", "version"


def _name(database: str, table: str) -> str:
    return f"`{database}`.`{table}`"


def _exists(spark: SparkSession, database: str, table: str) -> bool:
    return spark.catalog.tableExists(f"{database}.{table}")


def published_versions(spark: SparkSession, database: str) -> list[str]:
    """Published versions of a database, oldest first."""
    if not _exists(spark, database, PUBLISHED):
        return []
    rows = spark.table(f"{database}.{PUBLISHED}").groupBy("version").agg(F.min("n").alias("n"))
    return [r.version for r in rows.orderBy("n").collect()]


def publish_tables(
    spark: SparkSession, tables: Mapping[str, DataFrame], database: str, version: str
) -> DataFrame:
    """Persist frames as one version of ``database`` and switch its views to it.

    Each frame is written to a partition of a stored table that keeps all versions; readers see
    views of the frame's name that show the newest published one. The last step inserts one row
    into the table of published versions, and that is what switches every view at once: a failure
    before it leaves all of them on the version before, and a version that failed is replaced when
    its name is published again. Views read one partition, chosen when a query starts.

    Returns (tabla, filas) counted from what was written. A frame's columns must stay those of the
    first version. Names of versions may not be published twice.
    """
    known = published_versions(spark, database)
    if version in known:
        raise ValueError(f"version {version} of {database} is published already")
    counts = None
    for name, df in tables.items():
        stored = STORED.format(name)
        rows = df.withColumn(VERSION, F.lit(version))
        if _exists(spark, database, stored):
            # By position, so the columns are put into the order of the first version.
            target = f"{database}.{stored}"
            ordered = rows.select(*spark.table(target).columns)
            ordered.write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).insertInto(target)
        else:
            rows.write.format("parquet").partitionBy(VERSION).saveAsTable(f"{database}.{stored}")
        seen = spark.table(f"{database}.{stored}").where(F.col(VERSION) == version)
        row = seen.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias("tabla"), "filas")
        counts = row if counts is None else counts.union(row)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_name(database, PUBLISHED)} (version STRING, n BIGINT) "
        "USING parquet"
    )
    for name, df in tables.items():
        if not _exists(spark, database, name):
            columns = ", ".join(f"`{c}`" for c in df.columns)
            newest = f"(SELECT max_by(version, n) FROM {_name(database, PUBLISHED)})"
            spark.sql(
                f"CREATE VIEW {_name(database, name)} AS SELECT {columns} "
                f"FROM {_name(database, STORED.format(name))} WHERE {VERSION} = {newest}"
            )
    _switch(spark, database, version, len(known) + 1)
    return counts


def _switch(spark: SparkSession, database: str, version: str, n: int) -> None:
    """One row in one file: the commit of this insert is the switch."""
    row = spark.createDataFrame([(version, n)], "version string, n bigint").coalesce(1)
    row.write.insertInto(f"{database}.{PUBLISHED}")


def drop_published(spark: SparkSession, database: str, tables: list[str], keep: int) -> None:
    """Delete all but the newest published versions of the stored tables."""
    for version in published_versions(spark, database)[: -max(1, keep)]:
        for name in tables:
            quoted = version.replace("'", "\\'")
            spark.sql(
                f"ALTER TABLE {_name(database, STORED.format(name))} "
                f"DROP IF EXISTS PARTITION ({VERSION} = '{quoted}')"
            )
