"""Layers, filter graphs and the plan of a render."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.timecode import fixed

# The style of captions, the tone mapping of wide-range sources, the loudness aims,
# the encoder settings, the length that stands for an unknown one, the long side of a picture, and the fades of sound.
CAPTION_STYLE = "FontName=Helvetica,FontSize=18,Bold=1,PrimaryColour=&H00FFFFFF,OutlineColour=&H00000000,BackColour=&H00000000,BorderStyle=1,Outline=2,Shadow=0,Alignment=2,MarginV=90"
TONE_MAP = "zscale=t=linear:npl=100,format=gbrpf32le,zscale=p=bt709,tonemap=tonemap=hable:desat=0,zscale=t=bt709:m=bt709:r=tv,format=yuv420p"
WIDE_TRANSFERS = ("smpte2084", "arib-std-b67")
LOUDNESS = {"I": -14.0, "TP": -1.0, "LRA": 11.0}
DRAFT, PREVIEW, FINAL = ("ultrafast", "28"), ("medium", "22"), ("fast", "20")
DEFAULT_SECONDS = 10.0
LONG_SIDE, DRAFT_SIDE = "1920", "1280"
FADES, FADE_SECONDS = "afade=t=in:st=0:d=0.03,afade=t=out:st={}:d=0.03", 0.03


def dealt_overlays(overlays: DataFrame, width: float) -> DataFrame:
    """``overlays`` with ``slot``: each of the stretches of ``width`` that it is shown in (both ends included)."""
    return overlays.withColumn("slot", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("start") + F.col("duration")) / width))))


def active_overlays(times: DataFrame, overlays: DataFrame, width: float) -> DataFrame:
    """edl_id, at, z and local: overlays shown at each time (both ends included), and their own time there.

    Both sides are dealt to stretches of ``width``, so a long list is many groups.
    """
    shown = F.col("at").between(F.col("start"), F.col("start") + F.col("duration"))
    found = times.withColumn("slot", F.floor(F.col("at") / width)).join(dealt_overlays(overlays, width), ["edl_id", "slot"]).where(shown)
    return found.select("edl_id", "at", "z", (F.col("at") - F.col("start")).alias("local"))


def top_layer(times: DataFrame, overlays: DataFrame, width: float) -> DataFrame:
    """edl_id, at, z and local of the uppermost overlay; null where none is shown."""
    found = active_overlays(times, overlays, width).groupBy("edl_id", "at").agg(F.max("z").alias("z"), F.max_by("local", "z").alias("local"))
    return times.select("edl_id", "at").distinct().join(found, ["edl_id", "at"], "left")


def overlay_conflicts(overlays: DataFrame, width: float) -> DataFrame:
    """Pairs of overlays of one list that are shown at once (z < other); a pair is found where the later one begins."""
    dealt = dealt_overlays(overlays, width)
    other = dealt.select("edl_id", "slot", F.col("z").alias("other"), F.col("start").alias("other_start"), (F.col("start") + F.col("duration")).alias("other_stop"))
    both = dealt.join(other, ["edl_id", "slot"]).where("z < other").where(F.col("slot") == F.floor(F.greatest("start", "other_start") / width))
    apart = (F.col("start") > F.col("other_stop")) | (F.col("other_start") > F.col("start") + F.col("duration"))
    return both.where(~apart).select("edl_id", "z", "other", F.greatest("start", "other_start").alias("low"), F.least(F.col("start") + F.col("duration"), "other_stop").alias("high"))


def _joined(rows: DataFrame, by: str, order: str, line: Column, separator: str) -> DataFrame:
    lines = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("line"))))
    return rows.groupBy(by).agg(F.array_join(F.transform(lines, lambda x: x["line"]), separator).alias("text"))


def filter_graph(edls: DataFrame, overlays: DataFrame, subtitles: str | None, per_second: float = 1.0) -> DataFrame:
    """edl_id and graph: shifted overlays, each above the ones before, captions last; empty if nothing is to be done.

    ``overlays`` are numbered from 1 in the order of z.
    """
    numbered = overlays.groupBy("edl_id").agg(F.sort_array(F.collect_list(F.struct("z", "start", "duration"))).alias("list"))
    at = lambda o: o["start"] / per_second
    number = lambda i: (i + 1).cast("string")
    below = lambda i: F.when(i == 0, F.lit("[0:v]")).otherwise(F.concat(F.lit("[v"), i.cast("string"), F.lit("]")))
    shift = lambda o, i: F.concat(F.lit("["), number(i), F.lit(":v]setpts=PTS-STARTPTS+"), at(o).cast("string"), F.lit("/TB[a"), number(i), F.lit("]"))
    lay = lambda o, i: F.concat(below(i), F.lit("[a"), number(i), F.lit("]overlay=enable='between(t,"), fixed(at(o), 3), F.lit(","), fixed(at(o) + o["duration"] / per_second, 3), F.lit(")'[v"), number(i), F.lit("]"))
    rows = edls.select("edl_id").join(numbered, "edl_id", "left")
    n = F.coalesce(F.size("list"), F.lit(0))
    n = F.when(n < 0, 0).otherwise(n)
    if subtitles is None:
        last = F.when(n > 0, F.array(F.concat(below(n), F.lit("null[outv]"))))
    else:
        path = F.concat(F.lit("subtitles='"), T.escape_path(F.lit(subtitles)), F.lit(f"':force_style='{CAPTION_STYLE}'[outv]"))
        last = F.array(F.concat(below(n), path))
    none = F.array().cast("array<string>")
    parts = F.concat(F.coalesce(F.transform("list", shift), none), F.coalesce(F.transform("list", lay), none), F.coalesce(last, none))
    return rows.select("edl_id", F.array_join(parts, ";").alias("graph"))


def segment_name(ord_: Column, source: Column) -> Column:
    return F.concat(F.lit("seg_"), F.format_string("%02d", ord_), F.lit("_"), source.cast("string"), F.lit(".mp4"))


def concat_manifest(ranges: DataFrame, folder: str) -> DataFrame:
    """edl_id and text: one line for each segment, in order."""
    line = F.concat(F.lit(f"file '{folder}/"), segment_name(F.col("ord"), F.col("source")), F.lit("'\n"))
    return _joined(ranges, "edl_id", "ord", line, "")


def scale_step(portrait: Column, draft: bool) -> Column:
    long_side = DRAFT_SIDE if draft else LONG_SIDE
    return F.when(portrait, f"scale=-2:{long_side}").otherwise(f"scale={long_side}:-2")


def codec_settings(draft: bool, preview: bool) -> tuple[str, str]:
    """Encoder preset and rate factor."""
    return DRAFT if draft else PREVIEW if preview else FINAL


def fades(seconds: Column) -> Column:
    """Sound fades of 30 ms at both ends."""
    before, after = FADES.split("{}")
    return F.concat(F.lit(before), fixed(F.greatest(F.lit(0.0), seconds - FADE_SECONDS), 3), F.lit(after))


def media_info(probes: DataFrame) -> DataFrame:
    """source, path, transfer, portrait and seconds from probe texts (source, path, transfer, width, height, duration).

    What cannot be read is neither wide nor portrait, and lasts 10 s.
    """
    whole = lambda c: F.trim(c).try_cast("int")
    portrait = F.coalesce(whole(F.col("height")) > whole(F.col("width")), F.lit(False))
    seconds = F.coalesce(F.trim("duration").try_cast("double"), F.lit(DEFAULT_SECONDS))
    return probes.select("source", "path", F.trim("transfer").alias("transfer"), portrait.alias("portrait"), seconds.alias("seconds"))


def render_plan(ranges: DataFrame, media: DataFrame, grade: Column, per_second: float, draft: bool = False, preview: bool = False) -> DataFrame:
    """One row for each range: names, times, video and sound filters, encoder settings.

    ``media``: source, path, transfer and portrait (a null is neither wide nor
    portrait); a range whose source is not listed has a null path.  ``note`` is
    the range's beat, else its note, else empty, where ``ranges`` has such columns.
    """
    preset, rate = codec_settings(draft, preview)
    known = ranges.join(media, "source", "left")
    length = (F.col("stop") - F.col("start")) / per_second
    tone = F.when(F.col("transfer").isin(*WIDE_TRANSFERS), F.lit(TONE_MAP))
    video = F.concat_ws(",", tone, scale_step(F.coalesce("portrait", F.lit(False)), draft), F.nullif(grade, F.lit("")))
    note = T.first_filled(*[F.col(c) for c in ("beat", "note") if c in ranges.columns])
    return known.select(
        "edl_id",
        "ord",
        note.alias("note"),
        "path",
        segment_name(F.col("ord"), F.col("source")).alias("segment"),
        fixed(F.col("start") / per_second, 3).alias("seek"),
        fixed(length, 3).alias("length"),
        video.alias("video"),
        fades(length).alias("sound"),
        F.lit(preset).alias("preset"),
        F.lit(rate).alias("rate"),
    )


def loudness_step(measured: Column) -> Column:
    """The second pass with the measured values (a struct of strings), or one pass without."""
    aims = ":".join(f"{k}={v:g}" for k, v in LOUDNESS.items())
    known = F.concat(F.lit(f"loudnorm={aims}:measured_I="), measured["input_i"], F.lit(":measured_TP="), measured["input_tp"], F.lit(":measured_LRA="), measured["input_lra"], F.lit(":measured_thresh="), measured["input_thresh"], F.lit(":offset="), measured["target_offset"], F.lit(":linear=true"))
    return F.coalesce(known, F.lit(f"loudnorm={aims}"))


def payoff_sync(overlays: DataFrame, payoffs: DataFrame, reveal: float, hold: float) -> DataFrame:
    """Overlays moved so that the reveal ends on the payoff word (edl_id, z, at, said), and whether they last long enough.

    ``least``: the narration and the hold after it; ``held``: how long the last
    frame is to be held beyond what the overlay lasts now, 0 if it is ``enough``.
    """
    both = overlays.join(payoffs, ["edl_id", "z"])
    least = F.col("said") + hold
    held = F.greatest(F.lit(0), least - F.col("duration"))
    return both.select("edl_id", "z", F.greatest(F.lit(0), F.col("at") - reveal).alias("start"), least.alias("least"), held.alias("held"), (held == 0).alias("enough"))
