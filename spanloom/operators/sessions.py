"""Phrases: tokens in a row, split at silences and changes of speaker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import timecode
from .stretches import opened, running


def _islands(rows: DataFrame, gap: float, width: float | None) -> DataFrame:
    """``rows`` with ``island``, which changes where a silence of ``gap`` lies before a row: the place of the last silence, null before any.

    With a ``width`` a source is dealt to stretches of so many positions.  In a
    stretch only the first spoken token needs an earlier one, so one row for
    each stretch tells where the next ones open.
    """
    silent = F.coalesce(F.col("spacing") & (F.col("stop") - F.col("start") >= gap), F.lit(False))
    end = F.when(F.col("spoken"), F.coalesce("stop", "start"))
    late = lambda ended: F.coalesce(F.col("spoken") & (F.col("start") - ended >= gap), F.lit(False))
    by = ["source"] if width is None else ["source", "stretch"]
    rows = rows if width is None else rows.withColumn("stretch", F.floor(F.col("pos") / width))
    order = Window.partitionBy(*by).orderBy("pos")
    rows = rows.withColumn("ended", F.last(end, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    if width is not None:
        first = F.min(F.when(F.col("spoken"), F.struct("pos", "start")))
        whole = rows.groupBy(*by).agg(first.alias("first"), F.max_by(end, F.when(end.isNotNull(), F.col("pos"))).alias("end"), F.max(F.when(silent | late(F.col("ended")), F.col("pos"))).alias("cut"))
        earlier = Window.partitionBy("source").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
        whole = whole.withColumn("opening_end", F.last("end", ignorenulls=True).over(earlier))
        cut = F.greatest("cut", F.when(F.col("first.start") - F.col("opening_end") >= gap, F.col("first.pos")))
        rows = opened(rows, whole.select(*by, "opening_end", F.max(cut).over(earlier).alias("opening_cut")), ["source"])
        rows = rows.withColumn("ended", F.coalesce("ended", "opening_end"))
    island = F.max(F.when(silent | late(F.col("ended")), F.col("pos"))).over(order)
    return rows.withColumn("island", island if width is None else F.greatest(island, "opening_cut"))


def phrases(tokens: DataFrame, gap: float, width: float | None = None) -> DataFrame:
    """source, phrase_no, start, stop, speaker and text of each phrase.

    A phrase begins where a spacing token of ``gap`` or more lies since the
    last token, where the start is ``gap`` or more after the last token's end,
    or where the speaker differs from the phrase's first one (both known).
    Phrases without text are dropped, but part their neighbours.  Rows keep
    the order of ``pos``; the end is the last token's, even if an earlier token
    ended later.  A token without an end ends where it starts.

    One exchange on ``source`` serves all windows and aggregates, so a source is
    one task.  With a ``width`` a source is dealt to stretches of so many
    positions and then to what lies between two silences; that reads the tokens
    four times, and is for sources too long for a task.
    """
    spacing = F.coalesce("type", F.lit("word")) == "spacing"
    rows = tokens.select("source", "pos", "type", "text", "start", "stop", "speaker", (~spacing & F.col("start").isNotNull()).alias("spoken"), spacing.alias("spacing"))
    rows = _islands(rows, gap, width).where("spoken")
    inside = Window.partitionBy("source", "island").orderBy("pos")
    spoke = F.last("speaker", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    turns = F.first("speaker").over(inside).isNotNull() & (F.col("speaker") != spoke)
    rows = rows.withColumn("turns", F.coalesce(turns, F.lit(False)).cast("int")).withColumn("part", F.sum("turns").over(inside))
    piece = T.piece(F.col("type"), F.col("text"))
    found = rows.groupBy("source", "island", "part").agg(
        F.min("pos").alias("first_pos"),
        F.min_by("start", "pos").alias("start"),
        F.max_by(F.coalesce("stop", "start"), "pos").alias("stop"),
        F.min_by("speaker", "pos").alias("speaker"),
        F.sort_array(F.collect_list(F.when(piece.isNotNull(), F.struct("pos", piece.alias("piece"))))).alias("pieces"),
    )
    found = found.where(F.size("pieces") > 0).withColumn("text", T.attach_punctuation(F.array_join(F.transform("pieces", lambda p: p["piece"]), " ")))
    found = running(found, ["source"], "first_pos", width, sums={"phrase_no": F.lit(1)})
    return found.select("source", F.col("phrase_no").cast("int"), "start", "stop", "speaker", "text")


def source_summary(sources: DataFrame, phrases_: DataFrame) -> DataFrame:
    """source, duration and n_phrases of each row of ``sources``; zeros without phrases."""
    span = F.max_by("stop", "phrase_no") - F.min_by("start", "phrase_no")
    known = phrases_.groupBy("source").agg(span.alias("duration"), F.count("*").alias("n_phrases"))
    return sources.join(known, "source", "left").fillna(0, ["duration", "n_phrases"])


def totals(summary: DataFrame) -> DataFrame:
    return summary.agg(F.count("*").alias("n_sources"), F.coalesce(F.sum("n_phrases"), F.lit(0)).alias("n_phrases"), F.coalesce(F.sum("duration"), F.lit(0)).alias("duration"))


# The report's head, and what stands for a source without phrases.
HEAD = ("# Packed transcripts", "", "Phrase-level, grouped on silences ≥ {gap:.1f}s or speaker change.", "Use `[start-end]` ranges to address cuts in the EDL.", "")
NO_SPEECH = "  _no speech detected_"


def report_lines(sources: DataFrame, phrases_: DataFrame, gap_seconds: float, per_second: float = 1.0) -> DataFrame:
    """source, line_no and line of the packed report on ``sources`` (source); the head has a null source.

    Sorted by source (nulls first) and line_no, the lines are the report.  The
    phrases are read once: the figures of a source come from windows over them,
    in the partitions that they already lie in.
    """
    spark, whole = sources.sparkSession, Window.partitionBy("source")
    span = F.max_by("stop", "phrase_no").over(whole) - F.min_by("start", "phrase_no").over(whole)
    rows = sources.select("source").join(phrases_.withColumns({"n_phrases": F.count("*").over(whole), "duration": span}), "source", "left").fillna(0, ["duration", "n_phrases"])
    heads = spark.createDataFrame([(i + 1, x.format(gap=gap_seconds)) for i, x in enumerate(HEAD)], "line_no int, line string")
    seconds = lambda c: F.col(c) / per_second
    entry = lambda number, text: F.struct(number.cast("int").alias("line_no"), text.alias("line"))
    title = F.concat(F.lit("## "), F.col("source").cast("string"), F.lit("  (duration: "), timecode.duration(seconds("duration")), F.lit(", "), F.col("n_phrases").cast("string"), F.lit(" phrases)"))
    said = F.concat(F.lit("  ["), timecode.clock(seconds("start")), F.lit("-"), timecode.clock(seconds("stop")), F.lit("]"), T.speaker_tag(F.col("speaker").cast("string")), F.lit(" "), F.col("text"))
    silent = F.col("phrase_no").isNull()
    lines = [
        F.when(silent | (F.col("phrase_no") == 1), entry(F.lit(1), title)),
        F.when(silent, entry(F.lit(2), F.lit(NO_SPEECH))).otherwise(entry(F.col("phrase_no") + 1, said)),
        F.when(silent, entry(F.lit(3), F.lit(""))).when(F.col("phrase_no") == F.col("n_phrases"), entry(F.col("n_phrases") + 2, F.lit(""))),
    ]
    body = rows.select("source", F.inline(F.array_compact(F.array(*lines))))
    return heads.select(F.lit(None).cast(sources.schema["source"].dataType).alias("source"), "line_no", "line").unionByName(body)


def handoffs(tokens: DataFrame, low: float, high: float) -> DataFrame:
    """Where the speaker changes: both speakers, the air between, and whether it lies in [low, high]."""
    order = Window.partitionBy("source").orderBy("pos")
    rows = tokens.withColumns({"before": F.lag("speaker").over(order), "air": F.col("start") - F.lag("stop").over(order)})
    return rows.where(F.col("before") != F.col("speaker")).select("source", "pos", "before", "speaker", "air", F.col("air").between(low, high).alias("typical"))


def silence_class(gap: Column, clean: float, least: float) -> Column:
    """How safe a cut in a gap is."""
    return F.when(gap >= clean, "clean").when(gap >= least, "check").otherwise("unsafe")


def token_gaps(tokens: DataFrame) -> DataFrame:
    """source, pos and the gap before each token but the first."""
    order = Window.partitionBy("source").orderBy("pos")
    return tokens.select("source", "pos", (F.col("start") - F.lag("stop").over(order)).alias("gap")).where("gap is not null")


#: Words that a speech pre-scan marks; a parameter, not a claim about language.
FILLERS = ("um", "umm", "uh", "uhh", "er", "hmm")


def filler_counts(tokens: DataFrame, fillers: tuple[str, ...] = FILLERS) -> DataFrame:
    """source, n_tokens and n_fillers."""
    bare = F.lower(F.regexp_replace("text", "[.,!?;:]+$", ""))
    return tokens.groupBy("source").agg(F.count("*").alias("n_tokens"), F.count_if(bare.isin(*fillers)).alias("n_fillers"))
