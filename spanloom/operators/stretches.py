"""Running values along a key whose rows may be a third of all: by stretches, with a summary of each.

A key's rows are dealt to stretches of its order, so they are many tasks; the
summary of a stretch is one row, and only the summaries are put in one order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running(rows: DataFrame, by: list[str], order: str, width: float | None, sums: dict[str, Column] | None = None, maxima: dict[str, Column] | None = None, before: bool = False, then: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` with the sum or maximum of each given column over the rows of ``by`` up to and including this one (``before``: without it).

    ``order`` is a number, and with the columns ``then`` different for all rows
    of a ``by``; a stretch holds the rows within one ``width`` of ``order``.
    Without a ``width`` a ``by`` is one task's window, which reads ``rows`` once
    instead of twice.  Nulls count for nothing; a sum over nothing is 0, a
    maximum null.
    """
    sums, maxima = sums or {}, maxima or {}
    names = [*sums, *maxima]
    kind = lambda n: F.sum if n in sums else F.max
    upto = (Window.unboundedPreceding, -1 if before else Window.currentRow)
    if width is None:
        over = Window.partitionBy(*by).orderBy(order, *then).rowsBetween(*upto)
        return rows.withColumns({**{n: F.coalesce(F.sum(c).over(over), F.lit(0)) for n, c in sums.items()}, **{n: F.max(c).over(over) for n, c in maxima.items()}})
    dealt = rows.withColumns({**sums, **maxima, "stretch": F.floor(F.col(order) / width)})
    inside = Window.partitionBy(*by, "stretch").orderBy(order, *then).rowsBetween(*upto)
    earlier = Window.partitionBy(*by).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    whole = dealt.groupBy(*by, "stretch").agg(*[kind(n)(n).alias(n) for n in names])
    opening = whole.select(*by, "stretch", *[kind(n)(n).over(earlier).alias(f"opening_{n}") for n in names])
    both = opened(dealt.withColumns({n: kind(n)(n).over(inside) for n in names}), opening, by)
    total = lambda n: F.coalesce(F.col(n), F.lit(0)) + F.coalesce(f"opening_{n}", F.lit(0)) if n in sums else F.greatest(n, f"opening_{n}")
    return both.select(*[c for c in rows.columns if c not in names], *[total(n).alias(n) for n in names])


def opened(rows: DataFrame, opening: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` with what their stretch opens with: the other columns of ``opening`` (``by``, stretch, ...)."""
    keys = [*by, "stretch"]
    same = reduce(Column.__and__, [F.expr(f"l.`{c}` <=> o.`{c}`") for c in keys])
    return rows.alias("l").join(opening.alias("o"), same).select("l.*", *[f"o.{c}" for c in opening.columns if c not in keys])
