"""What is wrong with edit lists, media and results, as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .compose import dealt_overlays


def listed(names: Column) -> Column:
    """Names in order, comma-joined."""
    return F.array_join(F.array_sort(names), ", ")


def range_errors(ranges: DataFrame, sources: DataFrame) -> DataFrame:
    """edl_id, ord and error: one row for each fault of a range; none for a range in order.

    Faults: a missing source, start or stop; a stop that is not after the
    start; a source that ``sources`` (edl_id, source) does not list, with the
    names that it does.  The known names of a list are one row.
    """
    known = sources.groupBy("edl_id").agg(F.collect_set("source").alias("known"))
    rows = ranges.select("edl_id", "ord", "source", "start", "stop").join(known, "edl_id", "left")
    names = F.coalesce("known", F.array().cast(known.schema["known"].dataType))
    lacks = [F.when(F.col(c).isNull(), F.lit(f"{c} is missing")) for c in ("source", "start", "stop")]
    order = F.when(F.col("stop") <= F.col("start"), F.lit("stop must be after start"))
    unknown = F.when(~F.array_contains(names, F.col("source")), F.concat(F.lit("unknown source "), F.col("source").cast("string"), F.lit(", known: "), listed(F.transform(names, lambda x: x.cast("string")))))
    return rows.select("edl_id", "ord", F.explode(F.array_compact(F.array(*lacks, order, unknown))).alias("error"))


def required_path(sources: Column, source: Column) -> Column:
    """The path that a map of sources gives; a source that it lacks stops the query and names the known ones."""
    wrong = F.concat(F.lit("unknown source "), F.coalesce(source, F.lit("null")), F.lit(", known: "), listed(F.map_keys(sources)))
    return F.coalesce(F.try_element_at(sources, source), F.raise_error(wrong).cast("string"))


def failures(rows: DataFrame, by: str, error: str = "error", characters: int = 500) -> DataFrame:
    """``by``, n, n_failed and first_error (the least, shortened) of rows whose ``error`` is null where all went well."""
    return rows.groupBy(by).agg(F.count("*").alias("n"), F.count(error).alias("n_failed"), T.shorten(F.min(error), characters).alias("first_error"))


def covered_cues(cues_: DataFrame, overlays: DataFrame, width: float) -> DataFrame:
    """edl_id, cue_no, z and covered: the cues that an overlay is shown over, and for how long.

    Both sides are dealt to stretches of ``width``; a pair is found where the
    later of both begins.
    """
    shown = dealt_overlays(overlays, width).select("edl_id", "slot", "z", "start", (F.col("start") + F.col("duration")).alias("stop"))
    cut = cues_.select("edl_id", "cue_no", "out_start", "out_stop").withColumn("slot", F.explode(F.sequence(F.floor(F.col("out_start") / width), F.floor(F.col("out_stop") / width))))
    both = cut.join(shown, ["edl_id", "slot"]).where((F.col("out_start") < F.col("stop")) & (F.col("start") < F.col("out_stop")))
    both = both.where(F.col("slot") == F.floor(F.greatest("start", "out_start") / width))
    return both.select("edl_id", "cue_no", "z", (F.least("stop", "out_stop") - F.greatest("start", "out_start")).alias("covered"))
