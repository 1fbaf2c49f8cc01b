"""Joins, complements and positions of intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stretches import opened, running


def _buckets(start: Column, stop: Column, width: float) -> Column:
    """The buckets that [start, stop) touches; a later-than-stop start touches its own."""
    first = F.floor(start / width)
    return F.sequence(first, F.greatest(first, F.ceil(stop / width) - 1))


def overlap_join(ranges: DataFrame, tokens: DataFrame, width: float) -> DataFrame:
    """Ranges with the tokens of their source that overlap them (half open).

    Both sides are dealt to buckets of ``width``, so a long source is many
    groups; a pair is kept in the bucket where the later of both starts lies.
    Columns: those of ``ranges``, and pos, type, text, token_start, token_stop.
    """
    left = ranges.withColumn("bucket", F.explode(_buckets(F.col("start"), F.col("stop"), width)))
    right = tokens.where("start is not null and stop is not null").select("source", "pos", "type", "text", F.col("start").alias("token_start"), F.col("stop").alias("token_stop"))
    right = right.withColumn("bucket", F.explode(_buckets(F.col("token_start"), F.col("token_stop"), width)))
    found = left.join(right, ["source", "bucket"]).where((F.col("token_stop") > F.col("start")) & (F.col("token_start") < F.col("stop")))
    found = found.where(F.col("bucket") == F.floor(F.greatest("start", "token_start") / width))
    return found.select(*ranges.columns, "pos", "type", "text", "token_start", "token_stop")


def offsets(ranges: DataFrame, width: float | None = None) -> DataFrame:
    """``ranges`` with ``offset``: where each begins in the output.

    With a ``width`` a list is dealt to stretches of so many ``ord``; sums of
    whole numbers are the same either way.
    """
    return running(ranges, ["edl_id"], "ord", width, sums={"offset": F.col("stop") - F.col("start")}, before=True)


def silences(ranges: DataFrame, tokens: DataFrame, least: float, width: float) -> DataFrame:
    """edl_id, ord, gap_start, gap_stop: stretches of ``least`` or more without a token.

    A range that no token overlaps has none.
    """
    inside = overlap_join(ranges, tokens, width).where("type is null or type <> 'spacing'")
    by = Window.partitionBy("edl_id", "ord").orderBy("pos")
    gap = lambda low, high: F.struct(low.alias("gap_start"), high.alias("gap_stop"))
    before = F.greatest("start", F.max("token_stop").over(by.rowsBetween(Window.unboundedPreceding, -1)))
    upto = F.greatest("start", F.max("token_stop").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    tail = F.when(F.lead("pos").over(by).isNull(), gap(upto, F.col("stop")))
    rows = inside.select("edl_id", "ord", gap(before, F.greatest("start", "token_start")).alias("inner"), tail.alias("tail"))
    found = rows.select("edl_id", "ord", F.inline(F.array_compact(F.array("inner", "tail"))))
    return found.where(F.col("gap_stop") - F.col("gap_start") >= least)


def snap(edges: DataFrame, boundaries: DataFrame, width: float | None = None) -> DataFrame:
    """``edges`` (source, at, ...) with ``snapped``: the nearest boundary (source, at), the earlier of two.

    An as-of join in both directions without pairs: edges and boundaries of a
    source in one order, the last and the next boundary carried along.  With a
    ``width`` a source is dealt to stretches of so much time, each of which is
    told the last boundary before it and the next one after it.  A null time
    snaps to nothing.
    """
    names = [c for c in edges.columns if c not in ("source", "at")]
    marks = boundaries.where("at is not null").select("source", "at", *[F.lit(None).cast(edges.schema[c].dataType).alias(c) for c in names], F.col("at").alias("mark"))
    both = edges.select("source", "at", *names, F.lit(None).cast(edges.schema["at"].dataType).alias("mark")).unionByName(marks)
    both = both if width is None else both.withColumn("stretch", F.floor(F.col("at") / width))
    by = Window.partitionBy("source") if width is None else Window.partitionBy("source", "stretch")
    # both are running frames, each in its own order: a frame to the end would be gone through anew for every row
    so_far = lambda order: F.last("mark", ignorenulls=True).over(by.orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    found = both.withColumns({"low": so_far(F.asc("at")), "high": so_far(F.desc("at"))})
    if width is not None:
        whole = both.groupBy("source", "stretch").agg(F.min("mark").alias("first"), F.max("mark").alias("last"))
        beyond = lambda order: Window.partitionBy("source").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        whole = whole.select("source", "stretch", F.max("last").over(beyond(F.asc("stretch"))).alias("below"), F.min("first").over(beyond(F.desc("stretch"))).alias("above"))
        found = opened(found, whole, ["source"]).withColumns({"low": F.coalesce("low", "below"), "high": F.coalesce("high", "above")})
    nearest = F.when(F.col("high").isNull() | (F.col("at") - F.col("low") <= F.col("high") - F.col("at")), F.col("low")).otherwise(F.col("high"))
    return found.where("mark is null").select("source", "at", *names, F.when(F.col("at").isNotNull(), nearest).alias("snapped"))


def pad_edges(ranges: DataFrame, before: float, after: float, low: float, high: float) -> DataFrame:
    """Ranges widened on both sides, not below 0, and whether both paddings lie in [low, high]."""
    ok = F.lit(low <= before <= high and low <= after <= high)
    return ranges.withColumns({"start": F.greatest(F.col("start") - before, F.lit(0)), "stop": F.col("stop") + after, "allowed": ok})


def boundary_windows(placed: DataFrame, around: float) -> DataFrame:
    """The stretch around each cut in the output (``placed``: see offsets), within the whole."""
    length = F.max(F.col("offset") + F.col("stop") - F.col("start")).over(Window.partitionBy("edl_id"))
    cuts = placed.withColumn("total", length).where("ord > 0")
    return cuts.select("edl_id", "ord", F.col("offset").alias("at"), F.greatest(F.lit(0), F.col("offset") - around).alias("low"), F.least("total", F.col("offset") + around).alias("high"))


def inspection_windows(placed: DataFrame, around: float, ends: float, middles: int = 3) -> DataFrame:
    """edl_id, kind, n, low and high: the stretches of an output to look at.

    ``start`` and ``end``, ``middles`` evenly spaced points (``middle``), and
    the stretch around each ``cut``, all within the whole.
    """
    whole = placed.groupBy("edl_id").agg(F.max(F.col("offset") + F.col("stop") - F.col("start")).alias("total"))
    row = lambda kind, n, low, high: F.struct(F.lit(kind).alias("kind"), F.lit(n).alias("n"), low.cast("double").alias("low"), high.cast("double").alias("high"))
    total = F.col("total")
    points = [total * (i + 1) / (middles + 1) for i in range(middles)]
    fixed = [row("start", 0, F.lit(0), F.least(total, F.lit(ends))), row("end", 0, F.greatest(F.lit(0), total - ends), total), *[row("middle", i, at, at) for i, at in enumerate(points)]]
    cuts = boundary_windows(placed, around).select("edl_id", F.lit("cut").alias("kind"), F.col("ord").alias("n"), F.col("low").cast("double"), F.col("high").cast("double"))
    return whole.select("edl_id", F.inline(F.array(*fixed))).unionByName(cuts)


def runtime(ranges: DataFrame) -> DataFrame:
    """edl_id, n_ranges and runtime."""
    return ranges.groupBy("edl_id").agg(F.count("*").alias("n_ranges"), F.sum(F.col("stop") - F.col("start")).alias("runtime"))


def best_by(rows: DataFrame, key: str, score: str, tie: str) -> DataFrame:
    """One row for each ``key``: the highest ``score``, ties to the smallest ``tie``.

    An aggregate, so it is combined before the shuffle however few the keys are.
    """
    best = F.max_by(F.struct(tie, score), F.struct(F.col(score), -F.col(tie)))
    return rows.groupBy(key).agg(best.alias("best")).select(key, f"best.{tie}", f"best.{score}")


def latest(rows: DataFrame, by: str, order: str, tie: str) -> DataFrame:
    """The last row of each ``by``, such as the last session in a memory; ties to the largest ``tie``."""
    return rows.groupBy(by).agg(F.max_by(F.struct(*rows.columns), F.struct(order, tie)).alias("row")).select("row.*")


def split_by_presence(items: DataFrame, present: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The items whose key is present, and the others (all copies stay)."""
    keys = present.select(key)
    return items.join(keys, key, "left_semi"), items.join(keys, key, "left_anti")
