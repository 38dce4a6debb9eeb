from datetime import datetime

import pathlib

import pytest
from pyspark.sql import functions as F

import bookings
from medalake.session import stage, staging
from medalake.operators import changes
from medalake.plans import run
from medalake.schemas import BRONZE
from medalake.__main__ import jdbc_options, parse
from medalake.sources.jdbc import (
    HashSplit, KeySplit, RangeSplit, bounds_query, range_options, read_jdbc,
)
from medalake.sources.layers import (
    TASKS_PER_CORE, in_splits, read_layer, write_extract, write_layer,
)
from medalake.sources.snapshots import (
    list_snapshots, read_snapshot, snapshot_label, write_snapshot,
)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def test_snapshots(spark, root):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    write_snapshot(df, root, "t", "synthetic", datetime(2026, 1, 1, 10, 0, 5))
    write_snapshot(df.limit(1), root, "t", "jdbc", datetime(2026, 1, 1, 10, 1))
    assert list_snapshots(spark, root, "t") == ["20260101_1000", "20260101_1001"]
    latest = read_snapshot(spark, root, "t", schema="id long, name string").collect()
    assert [(r.id, r._fuente, r._extraido_en) for r in latest] == [
        (1, "jdbc", datetime(2026, 1, 1, 10, 1))
    ]
    # A rerun in the same minute replaces its own snapshot and no other.
    write_snapshot(df.where("id = 2"), root, "t", "jdbc", datetime(2026, 1, 1, 10, 1, 30))
    assert [r.id for r in read_snapshot(spark, root, "t").collect()] == [2]
    assert read_snapshot(spark, root, "t", "20260101_1000").count() == 2


def test_missing_snapshot(spark, root):
    (spark.range(1).write.parquet(f"{root}/bronze/t/other"))
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, root, "t")


def test_label_is_minute_stamp():
    assert snapshot_label(datetime(2026, 3, 4, 5, 6, 7)) == "20260304_0506"


def test_layer_is_replaced(spark, root):
    for n in (5, 3):
        write_layer(spark.range(n), root, "silver", "t")
    assert read_layer(spark, root, "silver", "t", "id long").count() == 3
    months = spark.range(100).withColumn("m", (F.col("id") % 3).cast("string"))
    for df in (months, months.where("m <> '0'")):
        write_layer(df, root, "gold", "f", partition_by=["m"])
    back = read_layer(spark, root, "gold", "f")
    assert {r.m for r in back.select("m").distinct().collect()} == {1, 2}
    assert len(back.inputFiles()) == 2  # one file per small partition


def test_extract_keeps_nulls(spark, root):
    write_extract({"x": spark.createDataFrame([(1, None)], "a int, b string")}, root)
    assert spark.read.text(f"{root}/x").first().value == '{"a":1,"b":null}'


def test_stage_reads_back_from_the_shared_folder(spark):
    df = stage(spark.range(10).withColumn("x", F.lit("a")))
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert df.count() == 10 and all(folder in f for f in df.inputFiles())
    plan = df.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan


def test_staged_tables_go_with_their_block(spark):
    with staging(spark):
        (file, *_) = stage(spark.range(5)).inputFiles()
        assert pathlib.Path(file.removeprefix("file://")).exists()
    assert not pathlib.Path(file.removeprefix("file://")).exists()


def test_jdbc_splits(spark):
    """What is sent to a database; none is opened here."""
    split = RangeSplit("fecha_reserva", "2024-01-01", "2025-01-01", 64)
    assert range_options(split) == {
        "partitionColumn": "fecha_reserva", "lowerBound": "2024-01-01",
        "upperBound": "2025-01-01", "numPartitions": "64",
    }
    assert bounds_query("t", "c") == "(SELECT min(c) AS lo, max(c) AS hi FROM t) bounds"
    with pytest.raises(ValueError, match="split"):
        read_jdbc(spark, "jdbc:none", "reservas")
    with pytest.raises(ValueError, match="mode"):
        run.open_source(spark, "csv", "x")


def test_key_ranges_cover_every_row_once(spark):
    predicates = KeySplit("k", ["m", "c", "o'x"]).predicates()
    df = spark.createDataFrame([(x,) for x in ["a", "c", "d", "m", "o'x", "z", None]], "k string")
    parts = [df.where(p).count() for p in predicates]
    assert len(parts) == 4 and sum(parts) == 7
    assert KeySplit("k", []).predicates() == ["1 = 1"]
    assert KeySplit("k", ["m"], "BINARY").predicates()[1] == "k COLLATE BINARY >= 'm'"


def test_residue_classes_cover_every_row_once(spark):
    df = spark.createDataFrame([(x,) for x in [-7, -1, 0, 1, 5, 12, None]], "k int")
    parts = [df.where(p).count() for p in HashSplit("k", 3).predicates()]
    assert sum(parts) == 7 and len(parts) == 3


def test_command_line_reads_jdbc_options():
    options = parse([
        "--mode", "jdbc", "--location", "jdbc:none", "--root", "/x", "--property", "user=a",
        "--split", "reservas:fecha_reserva:2024-01-01:2025-01-01:8",
    ])
    splits, properties = jdbc_options(options)
    assert splits == {"reservas": RangeSplit("fecha_reserva", "2024-01-01", "2025-01-01", 8)}
    assert properties == {"user": "a"}


def test_parquet_source(spark, root):
    for name, df in bookings.source(spark).items():
        df.write.parquet(f"{root}/{name}")
    tables = run.open_source(spark, "parquet", root)
    assert set(tables) == set(BRONZE) and tables["reservas"].count() > bookings.N


def test_parts_whose_rows_differ(spark):
    def state(rows):
        df = spark.createDataFrame(rows, "k string, m string, v int")
        return changes.fingerprints(df, ["k"], ["v"], ["m"])

    same = [(f"s{i}", "a", i) for i in range(20)]
    then = same + [("u", "b", 1), ("moved", "c", 2), ("gone", "e", 3), ("n", None, 4), (None, "f", 5)]
    now = same[::-1] + [("u", "b", 9), ("moved", "d", 2), ("new", "g", 3), ("n", None, 4), (None, "f", 5)]
    old, new = state(then), state(now)
    found = changes.changed_parts(old, new, ["k"], "m")
    assert sorted(found) == ["b", "c", "d", "e", "g"]
    whole = changes.changed_keys(old, new, ["k"], ["m"])
    here = changes.changed_keys(
        *[df.where(changes.F.col("m").isin(found)) for df in (old, new)], ["k"], ["m"]
    )
    assert sorted(map(tuple, here.collect())) == sorted(map(tuple, whole.collect()))
    assert changes.changed_parts(state(then), state(then), ["k"], "m") == []
    assert changes.changed_parts(state([]), state([("n", None, 4)]), ["k"], "m") == [None]


def test_small_files_share_tasks(spark, root):
    cores = spark.sparkContext.defaultParallelism
    files = 2 * TASKS_PER_CORE * cores
    df = spark.range(files * 5).selectExpr("id", "id % 2 AS part").repartition(files)
    write_layer(df, root, "silver", "t", partition_by=["part"], rebalance=False)
    # A limit below the 4 MB that Spark counts for a file gives every file a task.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        stored = read_layer(spark, root, "silver", "t")
        found = in_splits(stored, root, "silver", "t")
        assert stored.rdd.getNumPartitions() > files
        assert found.rdd.getNumPartitions() == TASKS_PER_CORE * cores
        assert sorted(r.id for r in found.collect()) == list(range(files * 5))
        plan = found.where("part = 1").select("id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    # Filters and columns still reach the scan.
    assert "PartitionFilters: [isnotnull(part" in plan and "ReadSchema: struct<id:bigint>" in plan
