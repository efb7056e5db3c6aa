"""Connected components of a link table, and ranks inside groups of any size, as Spark joins and groupings."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.sources.lake import Scratch

MAX_ROUNDS = 60
BATCH = 1000        # rows that Spark hands to Python at a time, so that texts of one batch are a few MB


def release(spark: SparkSession) -> None:
    """Between phases: Spark's cleaner deletes shuffle files of finished jobs once both garbage collectors have run."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Tables written inside hand ``BATCH`` rows at a time to Python; the session's own setting comes back afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = spark.conf.get(name)
    spark.conf.set(name, str(min(BATCH, int(own)) if int(own) > 0 else BATCH))
    try:
        yield
    finally:
        spark.conf.set(name, own)


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``: the smallest node reachable, by alternating star contraction.

    Large-star hangs a node's larger neighbours under its smallest one, small-star its smaller ones; both keep the
    components. A round is two groupings and joins, written to the shared folder; it ends when no edge moves, seen by the number of edges and a sum of their hashes. A node with
    many neighbours is a skewed join side, which adaptive execution splits. Nulls, loops and repeated links are ignored.
    """
    before = None
    edges = scratch.write(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(smallest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = scratch.write(large)
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(smallest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .unionByName(smallest.select("u", F.col("m").alias("v"))).distinct())
        small = scratch.write(small)
        now = _content(small)
        if now == before:
            out = small.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return out.unionByName(small.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        edges, before = small, now
    raise RuntimeError(f"links did not settle in {MAX_ROUNDS} rounds")


def _content(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(hashed), F.sum("v"), F.sum("u")).first())


def rank_in_group(df: DataFrame, keys: list[str], order: list[Column], spread: Column, name: str = "rank",
                  rows_per_part: int = 20_000) -> DataFrame:
    """Adds ``name``: 0-based place of a row among those with equal ``keys``, by (part of ``spread``, ``order``).

    ``spread`` is a 64-bit hash column. It cuts every group into parts of about ``rows_per_part`` rows or less, ranked one by
    one; a small table of part sizes gives each part its first rank. So no task ever holds a whole large group.
    """
    total = df.count()
    parts = max(1, -(-total // rows_per_part))
    df = df.withColumn("_part", F.pmod(spread, F.lit(parts)))
    sizes = df.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_size"))
    upto = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.withColumn("_first", F.coalesce(F.sum("_size").over(upto), F.lit(0))).drop("_size")
    inside = Window.partitionBy(*keys, "_part").orderBy(*order)
    ranked = df.withColumn("_inside", F.row_number().over(inside) - 1)
    on = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in [*keys, "_part"]]
    joined = ranked.alias("l").join(first.alias("r"), on, "left")
    kept = [F.col(f"l.{c}") for c in df.columns if c != "_part"]
    return joined.select(*kept, (F.col("r._first") + F.col("l._inside")).alias(name))
