"""Caption cues on the output timeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import timecode
from .intervals import offsets, overlap_join
from .stretches import running


def cues(ranges: DataFrame, tokens: DataFrame, width: float, shortest: float, words: int = 2, stretch: float | None = None) -> DataFrame:
    """edl_id, ord, chunk, cue_no, out_start, out_stop and text.

    The words of each range go in chunks of ``words``, closed early after
    punctuation.  Offsets come before the join, so a range whose source has no
    tokens still moves the later ones.  A cue that would not last lasts
    ``shortest``.  With a ``stretch`` the cues of a list are numbered by
    stretches of so much time, and its ranges placed by stretches of 1,000.
    """
    spoken = tokens.where("type = 'word'").withColumn("text", T.strip(F.coalesce("text", F.lit("")))).where("text <> ''")
    inside = overlap_join(offsets(ranges, None if stretch is None else 1000), spoken, width)
    order = Window.partitionBy("edl_id", "ord").orderBy("pos")
    run = F.coalesce(F.sum(T.ends_in_break(F.col("text")).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = Window.partitionBy("edl_id", "ord", "run").orderBy("pos")
    rows = inside.withColumn("run", run).withColumn("part", F.floor((F.row_number().over(within) - 1) / words))
    chunks = rows.groupBy("edl_id", "ord", "run", "part").agg(
        F.min("pos").alias("first_pos"),
        F.first("start").alias("start"),
        F.first("stop").alias("stop"),
        F.first("offset").alias("offset"),
        F.min_by("token_start", "pos").alias("begin"),
        F.max_by("token_stop", "pos").alias("end"),
        F.sort_array(F.collect_list(F.struct("pos", "text"))).alias("words"),
    )
    begin = F.greatest(F.lit(0), F.greatest("start", "begin") - F.col("start")) + F.col("offset")
    end = F.greatest(F.lit(0), F.least("stop", "end") - F.col("start")) + F.col("offset")
    timed = chunks.withColumns({"out_start": begin, "out_stop": end, "text": T.caption(F.array_join(F.transform("words", lambda w: w["text"]), " "))})
    timed = timed.withColumn("out_stop", F.when(F.col("out_stop") <= F.col("out_start"), F.col("out_start") + shortest).otherwise(F.col("out_stop")))
    chunk = F.row_number().over(Window.partitionBy("edl_id", "ord").orderBy("first_pos"))
    numbered = running(timed.withColumn("chunk", chunk), ["edl_id"], "out_start", stretch, sums={"cue_no": F.lit(1)}, then=("ord", "chunk"))
    return numbered.select("edl_id", "ord", "chunk", F.col("cue_no").cast("int"), "out_start", "out_stop", "text")


def subtitle_blocks(cues_: DataFrame) -> DataFrame:
    """edl_id, cue_no and block: number, times and text of each cue (times in milliseconds)."""
    times = F.concat(timecode.subtitle_clock(F.col("out_start")), F.lit(" --> "), timecode.subtitle_clock(F.col("out_stop")))
    return cues_.select("edl_id", "cue_no", F.concat_ws("\n", F.col("cue_no").cast("string"), times, "text", F.lit("")).alias("block"))
