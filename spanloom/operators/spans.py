"""Sets of intervals: what two sets cover together, both, one without the other, or only one of them.

One sweep over starts and stops.  Times are dealt to stretches, each with the
depth that it opens with, so the intervals of one key are many tasks, and no
interval ever meets another one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stretches import running

#: When a moment belongs to a set, by the numbers of intervals of both sides that hold it.
KINDS = {
    "union": lambda a, b: (a > 0) | (b > 0),
    "intersection": lambda a, b: (a > 0) & (b > 0),
    "difference": lambda a, b: (a > 0) & (b == 0),
    "exclusion": lambda a, b: (a > 0) != (b > 0),
}


def _events(intervals: DataFrame, by: str, name: str) -> DataFrame:
    ends = F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias(name)), F.struct(F.col("stop").alias("at"), F.lit(-1).alias(name)))
    return intervals.where("start < stop").select(by, F.inline(ends))


def depths(one: DataFrame, other: DataFrame | None, by: str, width: float) -> DataFrame:
    """``by``, at, and of both sides (a, b) the change at that time and the depth from it on; one row for each time."""
    events = _events(one, by, "change_a").withColumn("change_b", F.lit(0))
    if other is not None:
        events = events.unionByName(_events(other, by, "change_b").withColumn("change_a", F.lit(0)))
    times = events.groupBy(by, "at").agg(F.sum("change_a").alias("change_a"), F.sum("change_b").alias("change_b"))
    return running(times, [by], "at", width, sums={"a": F.col("change_a"), "b": F.col("change_b")})


def interval_sets(one: DataFrame, other: DataFrame, by: str, width: float, kinds: tuple[str, ...] = tuple(KINDS)) -> DataFrame:
    """``by``, kind, start and stop: the longest stretches that each set covers, of intervals (``by``, start, stop).

    Half open: intervals that touch are one stretch.  Those that are empty,
    turned round or without an end count for nothing.
    """
    swept = depths(one, other, by, width)
    turn = lambda kind: KINDS[kind](F.col("a"), F.col("b")) != KINDS[kind](F.col("a") - F.col("change_a"), F.col("b") - F.col("change_b"))
    turned = swept.select(by, "at", F.explode(F.array_compact(F.array(*[F.when(turn(k), F.lit(k)) for k in kinds]))).alias("kind"))
    # a set opens and closes by turns, so the n-th pair of turns is its n-th stretch
    numbered = running(turned, [by, "kind"], "at", width, sums={"n": F.lit(1)})
    pairs = numbered.groupBy(by, "kind", F.floor((F.col("n") - 1) / 2).alias("pair")).agg(F.min("at").alias("start"), F.max("at").alias("stop"))
    return pairs.select(by, "kind", "start", "stop")


def peak_depth(intervals: DataFrame, by: str, width: float, most: int | None = None) -> DataFrame:
    """``by``, peak (the most intervals at once) and at (when first); with ``most`` also whether the peak is within it."""
    found = depths(intervals, None, by, width).groupBy(by).agg(F.max(F.struct(F.col("a").alias("peak"), (-F.col("at")).alias("early"))).alias("top"))
    out = found.select(by, F.col("top.peak").alias("peak"), (-F.col("top.early")).alias("at"))
    return out if most is None else out.withColumn("fits", F.col("peak") <= most)


def covered_length(found: DataFrame, by: list[str | Column]) -> DataFrame:
    """``by``, n and length of stretches (start, stop)."""
    return found.groupBy(*by).agg(F.count("*").alias("n"), F.sum(F.col("stop") - F.col("start")).alias("length"))
