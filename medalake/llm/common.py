"""What several operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from medalake.session import stage

__all__ = ["columns", "components", "released", "stage", "table", "whole_text"]

# Fixed schemas of the text tables, so that no job infers them.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Only the named columns, so that further columns of the input cannot clash with new ones."""
    return df.select(*[F.col(n) for n in names])


def released(batches: Iterator) -> Iterator:
    """A task's batches; at its end its worker, which the next task uses again, gives memory that
    it no longer needs back to the system."""
    yield from batches
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def whole_text(name: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def components(edges: DataFrame, a: str = "a", b: str = "b", node: str = "node") -> DataFrame:
    """Connected components of undirected edges: ``node`` and ``root``, its component's least node.

    Every round each node takes the least root among its neighbours' and its own, then the root of
    that root, so paths halve and the rounds grow with the logarithm of a component's diameter. A
    node of many edges is reduced by a partial minimum before its shuffle. Each round is written
    and read back, which bounds the plan and survives lost executors. Nulls are no nodes.
    """
    both = edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
    both = both.union(both.select("y", "x")).where("x IS NOT NULL AND y IS NOT NULL").distinct()
    both = stage(both)
    roots = stage(both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("r")))
    while True:
        near = both.join(roots.select(F.col("x").alias("y"), "r"), "y").select("x", "r")
        least = near.union(roots).groupBy("x").agg(F.min("r").alias("r"))
        # The root's own root, and hooking: a root learns the least root that its members saw.
        hooks = (
            least.join(roots.select("x", F.col("r").alias("old")), "x")
            .groupBy(F.col("old").alias("x")).agg(F.min("r").alias("hook"))
        )
        hooked = stage(
            least.join(hooks, "x", "left").select("x", F.least("r", "hook").alias("r"))
        )
        upper = hooked.select(F.col("x").alias("r"), F.col("r").alias("up"))
        new = stage(hooked.join(upper, "r").select("x", F.col("up").alias("r")))
        changed = new.join(roots.select("x", F.col("r").alias("old")), "x").where("r < old")
        if changed.isEmpty():
            return new.select(F.col("x").alias(node), F.col("r").alias("root"))
        roots = new
