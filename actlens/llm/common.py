"""What the corpus operators share: reading tables, shared storage, Arrow maps and components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actlens.functions.arrow import BATCH_ROWS, arrow_map, column_of, ship, texts_of
from actlens.sources.scratch import Scratch, shared_dir

__all__ = ["BATCH_ROWS", "Scratch", "arrow_map", "column_of", "components", "largest", "ship", "shared_dir", "spread_join", "table", "texts_of"]

#: Keys that are joined by broadcast, the largest ones: every other key has less than a HOT-th of all rows.
HOT = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of a data directory; any path that Spark's readers open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def largest(firsts: DataFrame, keys: list[str]) -> DataFrame:
    """The ``HOT`` rows of the largest ``n``, ties by key."""
    return firsts.orderBy(F.desc("n"), *keys).limit(HOT)


def spread_join(rows: DataFrame, firsts: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the columns that ``firsts`` has for their keys; rows of other keys are left out.

    ``firsts`` has one row a key, with ``n``, the number of rows of that key. The ``HOT`` largest keys are joined by
    broadcast, so that no key brings more than a ``HOT``-th of the rows to one task; all sizes of tables go the same way.
    """
    hot = largest(firsts, keys).drop("n")
    here = rows.join(F.broadcast(hot), keys)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(firsts.drop("n"), keys)
    return here.unionByName(rest)


def components(scratch: Scratch, edges: DataFrame, limit: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b long): each node with the smallest node it can reach.

    Alternates large-star and small-star steps, each a minimum per node with map-side combine and a join
    back, until the edges stop changing; no neighbour list is ever gathered. Returns (node, component)
    for every node that has an edge. Loops and repeated edges do no harm; empty edges give no rows.
    """
    both = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    star = scratch.few(both)
    mark = None
    for _ in range(limit):
        # each step is written, so that the plans stay short for the driver
        two = star.unionAll(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = scratch.few(two.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n"))
        large = scratch.few(spread_join(two.where("b > a"), low, ["a"]).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        least = scratch.few(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")))
        small = spread_join(large, least, ["a"]).select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        new = scratch.few(small.where("a <> b").distinct())
        scratch.drop(low, large, least)
        now = tuple(new.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        scratch.drop(star)
        star = new
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"the components did not settle in {limit} rounds")
    nodes = star.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionAll(star.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
