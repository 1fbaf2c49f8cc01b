"""One query for each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import grading, text, timecode
from ..operators import alignment, checks, compose, cues, intervals, motion, reactive, sessions, signals, slips, spans
from ..operators import repair as repairs
from ..sources import readers
from ..sources.tables import BUCKET, conversation_overlays, conversation_ranges, conversation_tokens, event_tokens, order_clips, table, turns
from ..streaming.sessions import gap_sessions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

GAP = 500
EVENT_GAP = 6 * 3600 * 1_000_000
PAGE_EXTENSIONS = (".html", ".htm", *readers.MEDIA_EXTENSIONS)

#: Stretches that overlays are dealt to, in milliseconds.
WIDTH_MS = 60_000


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _ranges(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    tokens = conversation_tokens(spark, sf_dir)
    return tokens, conversation_ranges(tokens)


@query
def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.phrases(conversation_tokens(spark, sf_dir), GAP)


@query
def phrases_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.phrases(event_tokens(spark, sf_dir), EVENT_GAP)


@query
def long_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases for sources longer than a task: by stretches of 50 tokens, so that even short ones are many."""
    return sessions.phrases(event_tokens(spark, sf_dir), EVENT_GAP, 50)


@query
def explode_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_tokens(spark, sf_dir)


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("source")).distinct()


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.source_summary(_names(spark, sf_dir), phrases(spark, sf_dir))


@query
def source_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(spark, sf_dir).withColumn("duration_text", timecode.duration(F.col("duration") / 1000))


@query
def pack_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.totals(_summary(spark, sf_dir))


@query
def pack_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.report_lines(_names(spark, sf_dir), phrases(spark, sf_dir), gap_seconds=0.5, per_second=1000)


@query
def silence_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = sessions.token_gaps(conversation_tokens(spark, sf_dir))
    return gaps.groupBy("source", sessions.silence_class(F.col("gap"), 400, 150).alias("class")).agg(F.count("*").alias("n"))


@query
def handoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.handoffs(conversation_tokens(spark, sf_dir), 400, 600)


@query
def filler_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.filler_counts(conversation_tokens(spark, sf_dir))


@query
def explode_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranges(spark, sf_dir)[1]


@query
def silences(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens, ranges = _ranges(spark, sf_dir)
    return intervals.silences(ranges, tokens, 400, BUCKET)


@query
def edl_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.offsets(_ranges(spark, sf_dir)[1])


@query
def offsets_missing_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges without a source's tokens have no cues, but move the later ones: here every seventh range lacks them."""
    tokens, ranges = _ranges(spark, sf_dir)
    missing = F.when((F.col("source") + F.col("ord")) % 7 == 0, -1).otherwise(F.col("source"))
    found = cues.cues(ranges.withColumn("source", missing.cast("long")), tokens, BUCKET, 400)
    return found.groupBy("edl_id", "ord").agg(F.count("*").alias("n_cues"), F.min("out_start").alias("first_start"))


@query
def range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens, ranges = _ranges(spark, sf_dir)
    return intervals.overlap_join(ranges, tokens.where("type = 'word'"), BUCKET)


@query
def cue_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens, ranges = _ranges(spark, sf_dir)
    return cues.cues(ranges, tokens, BUCKET, 400)


QUERIES["cues"] = QUERIES.pop("cue_chunks")


@query
def srt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cues.subtitle_blocks(cue_chunks(spark, sf_dir))


@query
def runtime_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runtime against the length of the whole turns; more than 1 s off is not ok."""
    tokens, ranges = _ranges(spark, sf_dir)
    said = turns(tokens).where("speaker = 'assistant'").groupBy(F.col("source").alias("edl_id")).agg(F.sum(F.col("stop") - F.col("start")).alias("declared"))
    return intervals.runtime(ranges).join(said, "edl_id").withColumn("ok", F.abs(F.col("runtime") - F.col("declared")) <= 1000)


@query
def boundary_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.boundary_windows(intervals.offsets(_ranges(spark, sf_dir)[1]), 1500)


@query
def snap_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens, ranges = _ranges(spark, sf_dir)
    edges = ranges.select("source", "ord", F.posexplode(F.array("start", "stop")).alias("edge", "at"))
    marks = tokens.select("source", F.explode(F.array("start", "stop")).alias("at"))
    return intervals.snap(edges, marks)


@query
def long_snap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cut edges against the token edges, by stretches of two seconds."""
    tokens, ranges = _ranges(spark, sf_dir)
    edges = ranges.select("source", "ord", F.posexplode(F.array("start", "stop")).alias("edge", "at"))
    return intervals.snap(edges, tokens.select("source", F.explode(F.array("start", "stop")).alias("at")), 2000)


@query
def long_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cues numbered by stretches of five seconds."""
    tokens, ranges = _ranges(spark, sf_dir)
    return cues.cues(ranges, tokens, BUCKET, 400, stretch=5000)


@query
def pad_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.pad_edges(_ranges(spark, sf_dir)[1], 50, 80, 30, 200)


@query
def rms_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = signals.rms_envelope(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 10)
    return found.withColumn("value", F.round("value", 6))


@query
def frame_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities, prices and taxes of line items as frames of 8 bits."""
    rows = table(spark, sf_dir, "lineitem")
    value = lambda c, by: F.round(F.col(c) * by)
    frames = rows.select(F.col("l_orderkey").alias("clip"), value("l_quantity", 4).alias("yavg"), value("l_discount", 100).alias("ymin"), (value("l_discount", 100) + 120).alias("ymax"), value("l_tax", 1000).alias("satavg"), F.when(F.col("l_linenumber") > 0, 8).alias("ybitdepth"), F.col("l_linenumber").alias("frame_no"))
    found = signals.frame_statistics(frames, "clip")
    return found.select("clip", *[F.round(c, 9).alias(c) for c in ("y_mean", "y_range", "sat_mean")])


@query
def auto_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_clips(spark, sf_dir).select("clip", grading.auto_grade(F.col("y_mean"), F.col("y_range"), F.col("sat_mean")).alias("grade"))


@query
def resolve_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = F.element_at(F.array(*[F.lit(x) for x in ("", "auto", "subtle", "warm_cinematic", "none", "unknown_name", "eq=gamma=1.1")]), (F.col("o_orderkey") % 7 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", grading.resolve_grade(named).alias("grade"))


@query
def frame_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranges(spark, sf_dir)[1].select("edl_id", "ord", F.posexplode(signals.frame_times(F.col("start"), F.col("stop"), 5)).alias("i", "at"))


@query
def ruler_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranges(spark, sf_dir)[1].select("edl_id", "ord", F.inline(signals.ruler_ticks(F.col("start"), F.col("stop"), 50, 1100))).withColumn("at", F.round("at", 3))


@query
def label_thin(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens, ranges = _ranges(spark, sf_dir)
    return signals.thin_labels(ranges, tokens, BUCKET, 50, 50, 1100, 28)


def _layers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    tokens = conversation_tokens(spark, sf_dir)
    return tokens.select(F.col("source").alias("edl_id"), F.col("start").alias("at")), conversation_overlays(tokens)


@query
def overlay_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compose.active_overlays(*_layers(spark, sf_dir), WIDTH_MS)


@query
def top_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compose.top_layer(*_layers(spark, sf_dir), WIDTH_MS)


@query
def overlay_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlays made a minute long, so that some meet."""
    return compose.overlay_conflicts(_layers(spark, sf_dir)[1].withColumn("duration", F.lit(60_000).cast("long")), WIDTH_MS)


@query
def filter_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    edls = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("edl_id")).distinct()
    return compose.filter_graph(edls, _layers(spark, sf_dir)[1], "/edit/master's.srt", 1000)


@query
def concat_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compose.concat_manifest(_ranges(spark, sf_dir)[1], "/edit/clips_graded")


@query
def render_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some ranges have a beat, some only a note, some an empty beat."""
    named = F.element_at(F.array(F.lit("hook"), F.lit(""), F.lit(None)), (F.col("ord") % 3 + 1).cast("int"))
    ranges = _ranges(spark, sf_dir)[1].withColumns({"beat": named, "note": F.when(F.col("ord") % 2 == 0, F.concat(F.lit("turn "), F.col("ord").cast("string")))})
    media = ranges.select("source").distinct().where("source % 11 <> 0").select("source", F.concat(F.lit("/media/"), F.col("source").cast("string"), F.lit(".mp4")).alias("path"), F.when(F.col("source") % 3 == 0, "smpte2084").otherwise("bt709").alias("transfer"), (F.col("source") % 2 == 0).alias("portrait"))
    return compose.render_plan(ranges, media, grading.resolve_grade(F.lit("subtle")), 1000)


@query
def payoff_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each overlay is to be read when the turn's last word begins."""
    tokens = conversation_tokens(spark, sf_dir)
    last = tokens.where("speaker = 'user'").groupBy(F.col("source").alias("edl_id"), F.col("turn").alias("z")).agg(F.max("start").alias("at"), (F.max("stop") - F.min("start")).alias("said"))
    return compose.payoff_sync(conversation_overlays(tokens), last, 800, 1000)


@query
def best_take(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best event of each type on each day."""
    beat = F.concat_ws("/", "event_type", F.date_format("ts", "yyyy-MM-dd"))
    rows = table(spark, sf_dir, "events").select(beat.alias("beat"), "event_id", "value")
    return intervals.best_by(rows, "beat", "value", "event_id")


@query
def easing(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("p_size") / 50
    return table(spark, sf_dir, "part").select("p_partkey", F.round(grading.ease_out(t), 6).alias("ease_out"), F.round(grading.ease_in_out(t), 6).alias("ease_in_out"))


@query
def cdl_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.round(grading.color_transform(F.col("p_size") / 50, 1.1, -0.03, 0.9), 6).alias("value"))


@query
def cache_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.split_by_presence(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")[0]


@query
def cache_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.split_by_presence(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")[1]


@query
def scan_filter_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.with_extension(table(spark, sf_dir, "pages").select("page_id", "url"), "url", PAGE_EXTENSIONS).withColumn("stem", readers.stem(F.col("url")))


@query
def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of users, by the operator that streams use."""
    rows = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    found = gap_sessions(rows, "user_id", "ts", 6 * 3600)
    return found.select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("stop").alias("stop_us"), "n")


@query
def line_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics lines of line items, some of them broken: even orders have 8 bits, odd ones 10."""
    named = lambda key, value: F.concat(F.lit(f"lavfi.signalstats.{key}="), value.cast("string"))
    whole = lambda c, by: F.round(F.col(c) * by).cast("int")
    lines = F.array(
        F.concat(F.lit("frame:"), F.col("l_linenumber").cast("string")),
        named("YBITDEPTH", F.col("l_orderkey") % 2 * 2 + 8),
        named("YAVG", whole("l_quantity", 4)),
        named("YMIN", F.when(F.col("l_linenumber") == 3, "").otherwise(whole("l_discount", 100).cast("string"))),
        named("YMAX", whole("l_discount", 100) + 120),
    )
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("clip"), F.posexplode(lines).alias("pos", "line"))
    found = signals.line_statistics(readers.frame_values(rows), "clip")
    return found.select("clip", *[F.round(c, 9).alias(c) for c in ("y_mean", "y_range", "sat_mean")])


@query
def range_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges with planted faults: turned round, without a start, of unlisted sources."""
    tokens, ranges = _ranges(spark, sf_dir)
    stop = F.when(F.col("ord") % 3 == 1, F.col("start")).otherwise(F.col("stop"))
    start = F.when(F.col("ord") % 5 == 2, F.lit(None)).otherwise(F.col("start")).cast("long")
    sources = ranges.select("edl_id", F.explode(F.array(F.col("source"), F.col("source") + 1)).alias("source")).distinct().where("source % 7 <> 0")
    return checks.range_errors(ranges.withColumns({"stop": stop, "start": start}), sources)


@query
def failure_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of more than 900 characters as failures, with their text as the message."""
    rows = table(spark, sf_dir, "documents").select("source", F.when(F.length("text") > 900, F.col("text")).alias("error"))
    return checks.failures(rows, "source")


@query
def covered_cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens, ranges = _ranges(spark, sf_dir)
    return checks.covered_cues(cues.cues(ranges, tokens, BUCKET, 400), conversation_overlays(tokens), WIDTH_MS)


@query
def inspection_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.inspection_windows(intervals.offsets(_ranges(spark, sf_dir)[1]), 1500, 2000)


@query
def strip_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five frames for each range, on a canvas of 1920 at most."""
    frame = lambda i: F.struct((F.lit(160) + (F.col("ord") * 37 + i * 53) % 400).alias("width"), (F.lit(90) + F.col("source") % 200).cast("int").alias("height"))
    rows = _ranges(spark, sf_dir)[1].withColumn("layout", signals.strip_layout(F.array(*[frame(i) for i in range(5)]), 1920))
    return rows.select("edl_id", "ord", "layout.canvas", "layout.drawn", F.inline("layout.places"))


@query
def media_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and prices of parts as probe texts, some of them unreadable."""
    probes = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("source"),
        F.concat(F.lit("/media/"), F.col("p_partkey").cast("string")).alias("path"),
        F.lit(" bt709 ").alias("transfer"),
        F.when(F.col("p_partkey") % 5 == 0, "N/A").otherwise((F.col("p_size") * 40).cast("string")).alias("width"),
        F.lit("1080").alias("height"),
        F.when(F.col("p_partkey") % 3 == 0, "N/A").otherwise(F.concat((F.col("p_partkey") % 90).cast("string"), F.lit(".5"))).alias("duration"),
    )
    return compose.media_info(probes)


@query
def sampling_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranges(spark, sf_dir)[1].select("edl_id", "ord", F.round(grading.sampling_rate(10, (F.col("stop") - F.col("start")) / 1000), 6).alias("rate"))


@query
def saturation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The colour model on three channels, then the saturation."""
    channels = [grading.color_transform(F.col("p_size") / by, 1.1, -0.03, 0.9) for by in (50, 60, 80)]
    made = grading.saturate(*channels, 0.88)
    return table(spark, sf_dir, "part").select("p_partkey", *[F.round(c, 6).alias(name) for name, c in zip(("red", "green", "blue"), made)])


@query
def latest_entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), "event_type")
    return intervals.latest(rows, "user_id", "at", "event_id")


@query
def default_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents have a transcript beside their take."""
    name = F.col("doc_id").cast("string")
    folder = F.concat(F.lit("/takes/"), (F.col("doc_id") % 10).cast("string"), F.lit("/"))
    videos = table(spark, sf_dir, "documents").select("doc_id", F.concat(folder, name, F.lit(".v1.mp4")).alias("path"))
    files = table(spark, sf_dir, "labels").select(F.concat(folder, F.lit("edit/transcripts/"), name, F.lit(".v1.json")).alias("path"))
    return readers.default_transcripts(videos, files)


@query
def resolved_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.element_at(F.array(*[F.lit(x) for x in ("/abs/a.mp4", "a.mp4", "./b/a.mp4", "../a.mp4", "b/../../c//a.mp4")]), (F.col("p_partkey") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", text.resolve_path(given, F.lit("/edit/one")).alias("path"))


@query
def false_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slips.false_starts(conversation_tokens(spark, sf_dir), width=BUCKET)


@query
def slip_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = conversation_tokens(spark, sf_dir)
    return slips.slip_counts(tokens, slips.false_starts(tokens, width=BUCKET), sessions.FILLERS)


def _stretches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The user's turns, 2 s longer on both sides, and overlays made a minute long."""
    tokens = conversation_tokens(spark, sf_dir)
    said = turns(tokens).where("speaker = 'user'").select("source", (F.col("start") - 2000).alias("start"), (F.col("stop") + 2000).alias("stop"))
    shown = conversation_overlays(tokens).select(F.col("edl_id").alias("source"), "start", (F.col("start") + 60_000).alias("stop"))
    return said, shown


@query
def interval_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.interval_sets(*_stretches(spark, sf_dir), "source", WIDTH_MS)


@query
def peak_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most overlays at once, six of which may be seen together."""
    return spans.peak_depth(_stretches(spark, sf_dir)[1], "source", WIDTH_MS, 6)


@query
def block_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as whole samples in blocks of 16."""
    whole = F.transform("embedding", lambda x: F.round(x.cast("double") * 1000).cast("smallint"))
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("source"), F.size("embedding").cast("long").alias("total"), whole.alias("all"))
    cut = rows.select("source", "total", "all", F.explode(F.sequence(F.lit(0), F.col("total") - 1, F.lit(16))).alias("first"))
    found = signals.block_envelope(cut.select("source", "total", "first", F.slice("all", (F.col("first") + 1).cast("int"), 16).alias("samples")), 10, 1000.0)
    return found.withColumn("value", F.round("value", 6))


def _mended(spark: SparkSession, sf_dir: str) -> repairs.Repaired:
    """Every fifth range reaches outside of its source, others are cut in mid-word; overlays last a minute."""
    # ranges, overlays, lengths and words are all made of the tokens, which are found once
    tokens = conversation_tokens(spark, sf_dir).select("source", "turn", "speaker", "start", "stop").persist()
    ranges = conversation_ranges(tokens)
    lengths = tokens.groupBy("source").agg(F.max("stop").alias("length"))
    early, later = F.when(F.col("ord") % 5 == 0, 20_000).otherwise(0), F.when(F.col("ord") % 5 == 4, 90_000).otherwise(0)
    planted = ranges.withColumns({"start": F.col("start") - early, "stop": F.col("stop") + later})
    overlays = conversation_overlays(tokens).withColumn("duration", F.lit(9000).cast("long"))
    return repairs.repair(planted, overlays, tokens, lengths, BUCKET)


@query
def repair_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of three passes met, and (as a fourth) what is left."""
    found = _mended(spark, sf_dir)
    return found.log.unionByName(found.left.withColumn("pass", F.lit(4)))


@query
def repaired_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mended(spark, sf_dir).ranges


@query
def trails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of each user over the two days before each, the value in cents."""
    day = 24 * 3600 * 1_000_000
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), F.round(F.col("value") * 100).cast("long").alias("cents"))
    return motion.trails(rows, "user_id", "at", "cents", 2 * day, 7 * day)


@query
def lagged_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn begins when 30 % of the one before has passed."""
    rows = turns(conversation_tokens(spark, sf_dir)).select("source", "turn", (F.col("stop") - F.col("start")).alias("length"))
    return motion.lagged_starts(rows, "source", "turn", "length", 30, 4)


@query
def squished(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.round(motion.squished(F.col("p_size") / 50, 0.25, 0.75), 6).alias("progress"))


@query
def matched_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each of the user's turns against their next one, word by word: how many stay, move, are added and dropped."""
    word = F.filter(F.split(F.lower(F.regexp_replace("text", "[.,!?;:]", "")), "[ \t-\r]+"), lambda w: w != "")
    rows = table(spark, sf_dir, "conversations").where("role = 'user'").select("conv_id", "turn", word.alias("words"))
    after = F.lead("words").over(Window.partitionBy("conv_id").orderBy("turn"))
    pairs = rows.select(F.concat_ws("/", "conv_id", "turn").alias("take"), "words", after.alias("next")).where("next is not null")
    parts = alignment.matched_parts(pairs, "take", "words", "next")
    number = lambda kind: F.count_if(F.col("kind") == kind).alias(f"n_{kind}")
    return parts.groupBy("take").agg(*[number(kind) for kind in ("matched", "moved", "added", "dropped")])


@query
def reactive_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part's value is its size, that of the part of half its number, and for every fifth twice that of a tenth; some need a later one, which makes cycles, or none that is there."""
    key = F.col("p_partkey")
    parts = table(spark, sf_dir, "part")
    own = parts.select(key.cast("string").alias("name"), F.col("p_size").cast("long").alias("own"))
    need = lambda when, of, weight: F.when(when, F.struct(F.floor(of).cast("string").alias("needs"), F.lit(weight).cast("long").alias("weight")))
    needs = parts.select(key.cast("string").alias("name"), F.inline(F.array_compact(F.array(need(key > 1, key / 2, 1), need((key % 5 == 0) & (key > 9), key / 10, 2), need(key % 97 == 0, key * 2, 1)))))
    return reactive.reactive_values(own, needs)


@query
def loudness_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loudness objects in logs: some missing, some without a key, the others taken over."""
    whole = F.concat(F.lit("[Parsed] x\n{\n"), F.concat_ws(",\n", *[F.concat(F.lit(f'"{k}" : "'), (F.col("o_orderkey") % (17 + i)).cast("string"), F.lit('.5"')) for i, k in enumerate(readers.LOUDNESS_KEYS)]), F.lit(', "other": "1"\n}\nend'))
    log = F.when(F.col("o_orderkey") % 5 == 0, "no object here").when(F.col("o_orderkey") % 5 == 1, F.replace(whole, F.lit("input_tp"), F.lit("input_xx"))).otherwise(whole)
    return readers.loudness(table(spark, sf_dir, "orders").select("o_orderkey", log.alias("log"))).select("o_orderkey", compose.loudness_step(F.col("measured")).alias("step"))
