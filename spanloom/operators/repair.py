"""Repair of edit lists: faults are found, mended and found again, a bounded number of times."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stretches import opened

#: Faults that a pass mends, and those that it can only report.
MENDED = ("outside", "inside_word", "covered")
REPORTED = ("empty", "late")


@dataclass(frozen=True)
class Repaired:
    """``log``: the faults that each pass met; ``left``: those that remain after the last."""

    ranges: DataFrame
    overlays: DataFrame
    log: DataFrame
    left: DataFrame
    held: tuple[DataFrame, ...] = ()

    def release(self) -> None:
        """Give back what was kept between passes, when the results have been read."""
        for x in self.held:
            x.unpersist()


@dataclass(frozen=True)
class Words:
    """``rows``: words (source, stretch, start, stop) dealt to stretches of ``width``; ``lasts``: the last word of each stretch."""

    rows: DataFrame
    lasts: DataFrame
    width: float


def _by_stretch(rows: DataFrame) -> DataFrame:
    """Dealt to as many partitions as the session sets for shuffles: what is dealt alike need not move again."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "source", "stretch")


def dealt_words(words: DataFrame, width: float) -> Words:
    """``words`` (source, start, stop) for :func:`word_at`, persisted: they move once, however often they are asked for."""
    long = lambda c: F.col(c).cast("long").alias(c)
    rows = _by_stretch(words.where("start is not null and stop is not null").select("source", F.floor(F.col("start") / width).alias("stretch"), long("start"), long("stop"))).persist()
    return Words(rows, rows.groupBy("source", "stretch").agg(F.max(F.struct("start", "stop")).alias("word")).persist(), width)


def word_at(edges: DataFrame, words: Words) -> DataFrame:
    """``edges`` (source, at, ...) with word_start and word_stop: the last word that began before, if it holds the edge inside.

    An as-of join by a running maximum in each stretch; a stretch is told the
    last word before it.  Only the edges move to the words.
    """
    names = [c for c in edges.columns if c not in ("source", "at")]
    left = _by_stretch(edges.select("source", F.floor(F.col("at") / words.width).alias("stretch"), "at", F.struct(F.lit(1), *names).alias("edge")))
    none = lambda rows, c: F.lit(None).cast(rows.schema[c].dataType).alias(c)
    right = words.rows.select("source", "stretch", F.col("start").alias("at"), none(left, "edge"), F.struct("start", "stop").alias("word"))
    both = left.select("*", none(right, "word")).unionByName(right)
    # an edge comes before the words that begin at the same time
    order = Window.partitionBy("source", "stretch").orderBy("at", F.col("edge").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("last", F.max("word").over(order)).where("edge is not null").drop("word")
    asked = left.select("source", "stretch").distinct().select("*", none(words.lasts, "word")).unionByName(words.lasts)
    earlier = Window.partitionBy("source").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    before = asked.groupBy("source", "stretch").agg(F.max("word").alias("word")).select("source", "stretch", F.max("word").over(earlier).alias("before"))
    found = opened(found, before, ["source"]).withColumn("last", F.coalesce("last", "before"))
    inside = F.col("last.stop") > F.col("at")
    return found.select("source", "at", *[F.col(f"edge.{c}").alias(c) for c in names], F.when(inside, F.col("last.start")).alias("word_start"), F.when(inside, F.col("last.stop")).alias("word_stop"))


def _edges(ranges: DataFrame) -> DataFrame:
    """Both ends of each range, with its other columns."""
    return ranges.select(*[c for c in ranges.columns if c not in ("start", "stop")], F.inline(F.array(F.struct(F.lit("start").alias("end"), F.col("start").alias("at")), F.struct(F.lit("stop").alias("end"), F.col("stop").alias("at")))))


def _before(overlays: DataFrame) -> DataFrame:
    """``overlays`` with ``free``: when the earlier ones of their list have all ended."""
    earlier = Window.partitionBy("edl_id").orderBy("start", "z").rowsBetween(Window.unboundedPreceding, -1)
    return overlays.withColumn("free", F.max(F.col("start") + F.col("duration")).over(earlier))


def faults(ranges: DataFrame, overlays: DataFrame, words: Words, lengths: DataFrame) -> DataFrame:
    """edl_id, part (range or overlay), no, kind and amount (of time, or of edges inside a word) of each fault.

    A range may not reach outside of its source (``lengths``: source, length),
    nor begin or end inside a word, nor be empty; an overlay may not begin while
    an earlier one is shown, nor last longer than its list.
    """
    fault = lambda kind, amount: F.when(amount > 0, F.struct(F.lit(kind).alias("kind"), amount.cast("long").alias("amount")))
    known = ranges.join(lengths, "source", "left")
    over = F.greatest(-F.col("start"), F.lit(0)) + F.coalesce(F.greatest(F.col("stop") - F.col("length"), F.lit(0)), F.lit(0))
    empty = (F.col("stop") <= F.col("start")).cast("int")
    rows = known.select("edl_id", F.lit("range").alias("part"), F.col("ord").cast("long").alias("no"), F.inline(F.array_compact(F.array(fault("outside", over), fault("empty", empty)))))
    cut = word_at(_edges(ranges), words).where("word_start is not null").groupBy("edl_id", "ord").agg(F.count("*").alias("amount"))
    cut = cut.select("edl_id", F.lit("range").alias("part"), F.col("ord").cast("long").alias("no"), F.lit("inside_word").alias("kind"), "amount")
    total = ranges.groupBy("edl_id").agg(F.sum(F.greatest(F.col("stop") - F.col("start"), F.lit(0))).alias("total"))
    shown = _before(overlays).join(total, "edl_id", "left")
    late = F.col("start") + F.col("duration") - F.coalesce("total", F.lit(0))
    shown = shown.select("edl_id", F.lit("overlay").alias("part"), F.col("z").cast("long").alias("no"), F.inline(F.array_compact(F.array(fault("covered", F.col("free") - F.col("start")), fault("late", late)))))
    return rows.unionByName(cut).unionByName(shown)


def _nearest(end: str) -> Column:
    low, high, at = F.col(f"{end}.word_start"), F.col(f"{end}.word_stop"), F.col(end + ".at")
    return F.when(low.isNull(), at).when(at - low <= high - at, low).otherwise(high)


def mend(ranges: DataFrame, overlays: DataFrame, words: Words, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One pass: ranges clamped to their source, their edges moved out of words (to the nearer side), overlays shifted to where the earlier ones end."""
    names = ranges.columns
    known = ranges.join(lengths, "source", "left")
    within = lambda c: F.greatest(F.least(F.col(c), F.coalesce("length", F.col(c))), F.lit(0))
    clamped = known.withColumns({"start": within("start"), "stop": within("stop")}).select(*names)
    # the ends carry their range along, so nothing has to be joined to them again
    edges = word_at(_edges(clamped), words)
    side = lambda end: F.max(F.when(F.col("end") == end, F.struct("at", "word_start", "word_stop"))).alias(end)
    others = [F.any_value(c).alias(c) for c in names if c not in ("edl_id", "ord", "start", "stop")]
    both = edges.groupBy("edl_id", "ord").agg(*others, side("start"), side("stop"))
    out = both.withColumns({"start": _nearest("start"), "stop": _nearest("stop")}).select(*names)
    return out, _before(overlays).withColumn("start", F.greatest("start", "free")).drop("free")


def repair(ranges: DataFrame, overlays: DataFrame, words: DataFrame, lengths: DataFrame, width: float, passes: int = 3) -> Repaired:
    """Find and mend ``passes`` times; what is left is reported.

    ``ranges``: edl_id, ord, source, start, stop (whole numbers; edl_id and ord
    tell rows apart); ``overlays``: edl_id, z, start, duration.  Nothing runs
    until a result is read.  What is given and what a pass made is persisted (in memory or on
    disk), so each pass is one plan over the rows of the one before; a lost
    executor's part is made anew.
    """
    # every pass reads these
    dealt, ranges, overlays, lengths = dealt_words(words, width), ranges.persist(), overlays.persist(), lengths.persist()
    log, held = None, [dealt.rows, dealt.lasts, ranges, overlays, lengths]
    for k in range(passes):
        met = faults(ranges, overlays, dealt, lengths).withColumn("pass", F.lit(k + 1))
        log = met if log is None else log.unionByName(met)
        ranges, overlays = (x.persist() for x in mend(ranges, overlays, dealt, lengths))
        held += [ranges, overlays]
    return Repaired(ranges, overlays, log, faults(ranges, overlays, dealt, lengths), tuple(held))
