"""Trails of moving points, and starts that depend on the lengths before them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stretches import running


def trails(points: DataFrame, key: str, at: str, value: str, length: float, width: float) -> DataFrame:
    """``points`` with n, oldest and total: the points of ``key`` within ``length`` before each (it included), the first time and the sum of values.

    A range frame over time.  Points are dealt to stretches of ``width`` and
    also to those that their trail still reaches, so a long key is many tasks.
    """
    own = F.floor(F.col(at) / width)
    dealt = points.withColumn("stretch", F.explode(F.sequence(own, F.floor((F.col(at) + length) / width))))
    frame = Window.partitionBy(key, "stretch").orderBy(at).rangeBetween(-length, 0)
    found = dealt.withColumns({"n": F.count("*").over(frame), "oldest": F.min(at).over(frame), "total": F.sum(value).over(frame)})
    return found.where(F.col("stretch") == own).select(*points.columns, "n", "oldest", "total")


def lagged_starts(items: DataFrame, by: str, order: str, length: str, lag_percent: int, width: float) -> DataFrame:
    """``items`` with ``begin`` and ``end``: each begins when ``lag_percent`` of the one before has passed; 100 is one after the other, 0 all at once."""
    share = F.floor(F.col(length) * lag_percent / 100)
    found = running(items, [by], order, width, sums={"passed": share})
    begin = F.col("passed") - share
    return found.withColumns({"begin": begin, "end": begin + F.col(length)}).drop("passed")


def squished(progress: Column, low: float, high: float) -> Column:
    """A progress of 0 to 1 that runs within [low, high] of the whole."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (progress - low) / (high - low)))
