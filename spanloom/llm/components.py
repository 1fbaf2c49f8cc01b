"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node tells its larger neighbours the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    # the neighbours of a node are joined to its one row, so a hub's list is never gathered
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node tells its smaller neighbours, and itself, the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """Columns node, component (its smallest node) of all nodes on ``edges`` (u, v).

    Every round is written to the shared folder.  It ends when a round leaves
    the edges as they were, which is when all components are stars.
    """
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = F.struct(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    seen = now.select(mark).first()[0]
    for _ in range(most):
        if not seen[0]:
            break
        after = stored(_small_star(_large_star(now)), "edges")
        discard(now)
        now, last, seen = after, seen, after.select(mark).first()[0]
        if last == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    if seen[0]:
        raise RuntimeError(f"not connected after {most} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
