"""What several operators share: tables, durable cuts of lineage, size-checked broadcasts, components."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameyard.functions.durable import BROADCAST_ROWS, bounded_broadcast, materialize, release, shared_dir

__all__ = ["BROADCAST_ROWS", "bounded_broadcast", "connected_components", "give_back", "materialize", "release", "shared_dir", "small_batches", "table"]


def give_back() -> None:
    """Return to the system what a Python worker has freed: it lives on beside the JVM and would hold it while later
    stages run. For the end of tasks that held much."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Queries that run inside hand at most so many rows at once to Python workers (Spark's own default is 10,000): the
    JVM and the workers each hold a batch or two, which counts where the rows are whole texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _is_star_forest(e: DataFrame) -> bool:
    """Whether every node of edges u > v is either an end with one edge or a centre."""
    ends = e.select(F.col("u").alias("x"), F.lit(1).alias("up")).unionAll(e.select(F.col("v").alias("x"), F.lit(0).alias("up")))
    odd = ends.groupBy("x").agg(F.sum("up").alias("ups"), F.min("up").alias("least")).where("ups > 1 OR (ups = 1 AND least = 0)")
    return not odd.limit(1).count()


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Components of an undirected graph given as rows (u, v): returns (node, component) with the smallest node of
    each component, for the nodes that have an edge. Alternating large-star and small-star rounds; each is an
    aggregation with map-side combine and a join that Spark may split, so that one node may have most edges.
    Self-loops and repeated edges are allowed; no edges give no rows."""
    e = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    for _ in range(rounds):
        if _is_star_forest(e):
            break
        # large star: neighbours larger than u are linked to the least of u's neighbourhood
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least, "u").where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        )
        # small star: u and its smaller neighbours are linked to the least of them
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        nxt = materialize(
            large.join(small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v"))).distinct()
        )
        release(e)
        e = nxt
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    # now every edge runs from a node to the least node of its component
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
