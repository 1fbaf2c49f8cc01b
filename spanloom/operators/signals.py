"""Envelopes, frame statistics and drawing positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .intervals import overlap_join


def rms_envelope(signals: DataFrame, key: str, values: str, samples: int) -> DataFrame:
    """``key``, i and value: root mean squares of ``samples`` windows, scaled to a maximum of 1.

    A window has n // samples values (at least 1); what is left over is
    dropped, and missing windows are 0.  All of it is array expressions on one
    row, so nothing is shuffled.
    """
    window = F.greatest(F.lit(1), F.floor(F.size(values) / samples))
    square = lambda part: F.aggregate(part, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    level = lambda i: F.when((i + 1) * F.col("window") <= F.size(values), F.sqrt(square(F.slice(F.col(values), (i * F.col("window") + 1).cast("int"), F.col("window").cast("int"))) / F.col("window"))).otherwise(F.lit(0.0))
    rows = signals.select(key, values).withColumn("window", window).withColumn("levels", F.transform(F.sequence(F.lit(0), F.lit(samples - 1)), level))
    rows = rows.withColumn("top", F.array_max("levels"))
    return rows.select(key, F.posexplode("levels").alias("i", "level"), "top").select(key, "i", F.when(F.col("top") > 0, F.col("level") / F.col("top")).otherwise(F.col("level")).alias("value"))


def block_envelope(blocks: DataFrame, samples: int, full_scale: float = 32768.0) -> DataFrame:
    """source, i and value: the envelope of :func:`rms_envelope` from blocks of whole samples (source, total, first, samples).

    ``first`` is the number of a block's first sample and ``total`` how many its
    source has.  Each sample falls in the window of its number, and the squares
    of a window are added up before and after one shuffle, so a recording of any
    length is many tasks and no row holds it.  A source without samples is 0
    throughout.
    """
    window = F.greatest(F.lit(1), F.floor(F.col("total") / samples))
    each = blocks.select("source", "first", window.alias("window"), F.posexplode("samples").alias("at", "x"))
    square = F.col("x").cast("long") * F.col("x").cast("long")
    sums = each.groupBy("source", "window", F.floor((F.col("first") + F.col("at")) / F.col("window")).alias("i")).agg(F.sum(square).alias("squares"))
    levels = sums.where(F.col("i") < samples).groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct("i", F.sqrt(F.col("squares") / F.col("window")).alias("level")))).alias("levels"))
    # of a source's blocks one stands for all; only whole windows count
    rows = blocks.groupBy("source").agg(F.max("total").alias("total")).join(levels, "source", "left").withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))))
    level = F.when((F.col("i") + 1) * window <= F.col("total"), F.try_element_at("levels", F.col("i").cast("long")))
    rows = rows.select("source", "i", F.coalesce(level / full_scale, F.lit(0.0)).alias("level"))
    top = F.max("level").over(Window.partitionBy("source"))
    return rows.withColumn("top", top).select("source", "i", F.when(F.col("top") > 0, F.col("level") / F.col("top")).otherwise(F.col("level")).alias("value"))


def frame_statistics(frames: DataFrame, clip: str) -> DataFrame:
    """y_mean, y_range and sat_mean of each clip from its frames (clip, frame_no, yavg, ymin, ymax, satavg, ybitdepth).

    Means are over the frames that have the value, on a scale of 0 to 1; the
    last depth named holds (8 if none).  Without yavg: 0.5, 0.72 and 0.25; without
    one of the others 0.7 and 0.25.
    """
    depth = F.coalesce(F.max_by("ybitdepth", F.when(F.col("ybitdepth").isNotNull(), F.col("frame_no"))), F.lit(8))
    rows = frames.groupBy(clip).agg(*[F.avg(c).alias(c) for c in ("yavg", "ymin", "ymax", "satavg")], depth.alias("depth"))
    return _scaled(rows, clip)


def line_statistics(values: DataFrame, clip: str) -> DataFrame:
    """The same from statistics lines (clip, pos, key, value; see readers.frame_values), by one aggregate.

    Each line is one frame's value, so no frame has to be put together first.
    """
    of = lambda key: F.when(F.col("key") == key, F.col("value"))
    depth = F.coalesce(F.max_by(of("YBITDEPTH").cast("int"), F.when(F.col("key") == "YBITDEPTH", F.col("pos"))), F.lit(8))
    rows = values.groupBy(clip).agg(*[F.avg(of(key)).alias(key.lower()) for key in ("YAVG", "YMIN", "YMAX", "SATAVG")], depth.alias("depth"))
    return _scaled(rows, clip)


# What stands for a clip that could not be looked at, and for a value that was not named.
UNSEEN = (0.5, 0.72, 0.25)
UNNAMED_RANGE, UNNAMED_SATURATION = 0.7, 0.25


def _scaled(rows: DataFrame, clip: str) -> DataFrame:
    full = F.pow(F.lit(2.0), F.col("depth")) - 1
    seen = F.col("yavg").isNotNull()
    of_all = {
        "y_mean": F.col("yavg") / full,
        "y_range": F.coalesce((F.col("ymax") - F.col("ymin")) / full, F.lit(UNNAMED_RANGE)),
        "sat_mean": F.coalesce(F.col("satavg") / full, F.lit(UNNAMED_SATURATION)),
    }
    return rows.select(clip, *[F.when(seen, x).otherwise(F.lit(unseen)).alias(name) for (name, x), unseen in zip(of_all.items(), UNSEEN)])


def frame_times(start: Column, stop: Column, n: int) -> Column:
    """``n`` times from start to stop, both included; the middle for one or fewer."""
    if n <= 1:
        return F.array((start + stop) / 2)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: start + i * ((stop - start) / (n - 1)))


def ruler_ticks(start: Column, stop: Column, left: int, span: int, ticks: int = 6) -> Column:
    """Array of (i, at, x): evenly spaced times and their places."""
    tick = lambda i: F.struct(i.alias("i"), (start + (i / F.lit(ticks)) * (stop - start)).alias("at"), (F.lit(left) + (i / F.lit(ticks) * span).cast("int")).alias("x"))
    return F.transform(F.sequence(F.lit(0), F.lit(ticks)), tick)


def place(at: Column, start: Column, stop: Column, left: int, span: int) -> Column:
    """A time as a pixel, cut off towards zero."""
    share = (at - start) / F.greatest(F.lit(1e-6), (stop - start).cast("double"))
    return (F.lit(left) + share * span).cast("int")


def thin_labels(ranges: DataFrame, tokens: DataFrame, width: float, shortest: float, left: int, span: int, apart: int) -> DataFrame:
    """edl_id, ord, pos, x and text of the labels kept: each at least ``apart`` after the last one kept.

    What is kept depends on what was kept before, so the labels of a range are
    folded in order; a range is one row by then.
    """
    inside = overlap_join(ranges, tokens, width).where("type = 'word'").withColumn("text", T.strip(F.col("text"))).where("text <> ''").where(F.col("token_stop") - F.col("token_start") >= shortest)
    spot = lambda c: place(F.col(c), F.col("start"), F.col("stop"), left, span)
    x = F.floor((spot("token_start") + spot("token_stop")) / 2).cast("int")
    label = F.struct("pos", x.alias("x"), "text")
    rows = inside.groupBy("edl_id", "ord").agg(F.sort_array(F.collect_list(label)).alias("labels"))
    none = F.filter("labels", lambda _: F.lit(False))
    first = F.lit(-9999)
    fold = F.aggregate(
        "labels",
        F.struct(none.alias("kept"), first.alias("last")),
        lambda s, x: F.when(x["x"] - s["last"] >= apart, F.struct(F.concat(s["kept"], F.array(x)).alias("kept"), x["x"].alias("last"))).otherwise(s),
    )
    return rows.select("edl_id", "ord", F.inline(fold["kept"]))


# The drawing's sizes in pixels.
FRAME_HEIGHT, MARGIN, APART, STRIP_TOP, LEAST_CONTENT, CANVAS = 180, 50, 4, 50, 1400, 1920


def strip_layout(frames: Column, widest: int = 1 << 30) -> Column:
    """From an array of frames (width, height): the canvas width, and the place and size of each frame.

    Frames get one height.  The canvas grows with them up to ``widest``; if they
    do not fit, all are made smaller and stand in the middle of the strip.  A struct of canvas, drawn
    and places (i, x, y, width, height), by array expressions on one row.
    """
    wide = F.transform(frames, lambda f: (F.lit(FRAME_HEIGHT) * (f["width"] / f["height"])).cast("int"))
    none = F.array().cast("array<int>")
    total = F.aggregate(wide, F.lit(0), lambda a, x: a + x) + F.greatest(F.size(wide) - 1, F.lit(0)) * APART
    canvas = F.least(F.lit(widest), F.greatest(F.lit(CANVAS), F.greatest(F.lit(LEAST_CONTENT), total) + 2 * MARGIN))
    strip = canvas - 2 * MARGIN
    scale = F.when(total <= strip, F.lit(1.0)).otherwise(strip / total)
    widths = F.transform(wide, lambda x: (x * scale).cast("int"))
    gap = F.when(scale == 1.0, F.lit(APART)).otherwise(F.greatest(F.lit(2), (APART * scale).cast("int")))
    height = (F.lit(FRAME_HEIGHT) * scale).cast("int")
    begin = F.aggregate(widths, F.struct(none.alias("xs"), F.lit(MARGIN).alias("at")), lambda s, x: F.struct(F.concat(s["xs"], F.array(s["at"])).alias("xs"), (s["at"] + x + gap).alias("at")))
    top = F.lit(STRIP_TOP) + F.floor((F.lit(FRAME_HEIGHT) - height) / 2).cast("int")
    each = lambda x, i: F.struct(i.alias("i"), x.alias("x"), top.alias("y"), F.element_at(widths, i + 1).alias("width"), height.alias("height"))
    return F.struct(canvas.alias("canvas"), (begin["at"] - MARGIN).alias("drawn"), F.transform(begin["xs"], each).alias("places"))
