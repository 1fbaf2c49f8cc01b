"""Golden cases, random inputs against plain loops, readers, writers, plans and streams."""

import json
import random
import wave
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from spanloom.functions import grading, text, timecode
from spanloom.operators import checks, compose, intervals, sessions, signals
from spanloom.sources import readers, writers
from spanloom.streaming.sessions import gap_sessions, speaker_sessions

TOKENS = "source string, pos int, type string, text string, start double, stop double, speaker string"


def plain_phrases(tokens, gap):
    """(start, stop, speaker, text) by walking the tokens once."""
    out, now, ended = [], [], None

    def close():
        words = [w for w in (((f"({t.strip()})" if k == "audio_event" and not t.strip().startswith("(") else t.strip()) if (t or "").strip() else "") for k, t, *_ in now) if w]
        if words:
            said = " ".join(words)
            for mark in ",.?!":
                said = said.replace(" " + mark, mark)
            last = now[-1]
            out.append((now[0][2], last[3] if last[3] is not None else last[2], now[0][4], said))
        now.clear()

    for kind, said, start, stop, who in tokens:
        if kind == "spacing":
            if start is not None and stop is not None and stop - start >= gap:
                close()
            continue
        if start is None:
            continue
        if now and now[0][4] is not None and who is not None and who != now[0][4]:
            close()
        if ended is not None and start - ended >= gap:
            close()
        now.append((kind or "word", said, start, stop, who))
        ended = stop if stop is not None else start
    close()
    return out


@pytest.mark.parametrize("width", [None, 1, 3, 1000])
def test_phrases_equal_a_plain_walk(spark, width):
    rng, rows, want = random.Random(4), [], {}
    for n in range(60):
        at, tokens = 0.0, []
        for _ in range(rng.randint(0, 25)):
            start = at + rng.choice([0, 0.25, 0.5, 0.75, -0.25])
            stop = start + rng.choice([0.25, 0.5, 1.0])
            at = stop
            tokens.append((rng.choice(["word", "word", "word", "spacing", "audio_event", None]), rng.choice(["a", "b", " ", ",", "(x)", None]), rng.choice([start, start, start, None]), rng.choice([stop, stop, stop, None]), rng.choice(["A", "B", None])))
        rows += [(str(n), i, *t) for i, t in enumerate(tokens)]
        want[str(n)] = plain_phrases(tokens, 0.5)
    got = {str(n): [] for n in range(60)}
    for r in sessions.phrases(spark.createDataFrame(rows, TOKENS), 0.5, width).orderBy("source", "phrase_no").collect():
        got[r["source"]].append((r["start"], r["stop"], r["speaker"], r["text"]))
    assert got == want


def test_interval_join_has_no_nested_loop_and_equals_pairs(spark):
    rng = random.Random(7)
    ranges = [(1, i, rng.choice("ab"), float(s := rng.randint(0, 500)), float(s + rng.randint(1, 120))) for i in range(60)]
    tokens = [(rng.choice("ab"), i, "word", "t", float(s := rng.randint(0, 600)), float(s + rng.randint(0, 90)), None) for i in range(200)]
    left = spark.createDataFrame(ranges, "edl_id int, ord int, source string, start double, stop double")
    found = intervals.overlap_join(left, spark.createDataFrame(tokens, TOKENS), 50)
    want = sorted((r[1], t[1]) for r in ranges for t in tokens if r[2] == t[0] and t[5] > r[3] and t[4] < r[4])
    assert sorted((r["ord"], r["pos"]) for r in found.collect()) == want
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


def test_presence_is_a_semi_join(spark):
    hits, pending = intervals.split_by_presence(spark.createDataFrame([("a",), ("a",), ("b",)], "k string"), spark.createDataFrame([("a",), ("a",)], "k string"), "k")
    assert hits.count() == 2 and pending.count() == 1


def test_golden_formats(spark):
    row = spark.range(1).select(
        timecode.clock(F.lit(0.125)).alias("a"), timecode.clock(F.lit(2.675)).alias("b"), timecode.duration(F.lit(59.97)).alias("c"), timecode.duration(F.lit(119.97)).alias("d"),
        timecode.subtitle_clock(timecode.to_milliseconds(F.lit(3661.0005))).alias("e"), timecode.to_milliseconds(F.lit(0.0025)).alias("f"), text.strip(F.lit("\x1c x ")).alias("g"),
    ).first()
    assert tuple(row) == ("000.12", "002.67", "60.0s", "1m 60.0s", "01:01:01,000", 2, "x")


@pytest.mark.parametrize(("stats", "want"), [((0.50, 0.72, 0.25), "eq=contrast=1.030:saturation=0.980"), ((0.30, 0.50, 0.10), "eq=contrast=1.080:gamma=1.100:saturation=1.040"), ((0.70, 0.90, 0.50), "eq=contrast=1.030:gamma=0.970:saturation=0.960")])
def test_golden_grades(spark, stats, want):
    assert spark.range(1).select(grading.auto_grade(*map(F.lit, stats))).first()[0] == want


def test_frame_text_to_statistics(spark):
    lines = ["frame:0", "lavfi.signalstats.YAVG=128", "lavfi.signalstats.YMIN=10", "lavfi.signalstats.YMAX=x=210", "lavfi.signalstats.SATAVG=bad", "lavfi.signalstats.YBITDEPTH=8"]
    values = readers.frame_values(spark.createDataFrame([("c", i, x) for i, x in enumerate(lines)], "clip string, pos int, line string"))
    assert {r["key"]: r["value"] for r in values.collect()} == {"YAVG": 128.0, "YMIN": 10.0, "YMAX": 210.0, "YBITDEPTH": 8.0}
    frames = spark.createDataFrame([("c", 1, 127.5, None, None, None, None)], "clip string, frame_no int, yavg double, ymin double, ymax double, satavg double, ybitdepth int")
    assert tuple(signals.frame_statistics(frames, "clip").first()) == ("c", 0.5, 0.7, 0.25)


def test_loudness_from_logs(spark):
    whole = {k: "1" for k in readers.LOUDNESS_KEYS}
    logs = ["noise { old } " + json.dumps(whole) + " tail", json.dumps(whole)[:-1], json.dumps({"input_i": "1"}), "} {", "", None]
    got = readers.loudness(spark.createDataFrame([(x,) for x in logs], "log string")).select("measured", compose.loudness_step(F.col("measured")).alias("step")).collect()
    assert [r["measured"] is not None for r in got] == [True, False, False, False, False, False]
    assert got[0]["step"].startswith("loudnorm=I=-14:TP=-1:LRA=11:measured_I=1") and got[1]["step"] == "loudnorm=I=-14:TP=-1:LRA=11"


def test_files(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "take.1.json").write_text(json.dumps({"words": [{"type": "word", "text": "Hi", "start": 0, "end": 1, "speaker_id": "speaker_0"}, {"text": "you"}]}))
    rows = readers.read_transcripts(spark, str(tmp_path / "t")).orderBy("pos").collect()
    assert [tuple(r) for r in rows] == [("take.1", 0, "word", "Hi", 0.0, 1.0, "speaker_0"), ("take.1", 1, None, "you", None, None, None)]
    (tmp_path / "e.json").write_text(json.dumps({"sources": {"a": "/a.mp4"}, "ranges": [{"source": "a", "start": 1, "end": 2, "beat": "", "note": "n"}, {"source": "b", "start": 0, "end": 1}]}))
    edls = readers.read_edls(spark, str(tmp_path / "e.json"))
    assert [tuple(r) for r in readers.edl_ranges(edls).orderBy("ord").collect()] == [("e", 0, "a", "/a.mp4", 1.0, 2.0, "n"), ("e", 1, "b", None, 0.0, 1.0, "")]
    assert readers.edl_overlays(edls).count() == 0
    (tmp_path / "m").mkdir()
    for name in ("x.mp4", "y.M4V", "z.mov", "n.txt"):
        (tmp_path / "m" / name).write_text("media")
    assert sorted(r["stem"] for r in readers.list_files(spark, str(tmp_path / "m")).collect()) == ["x", "z"]
    (tmp_path / "w").mkdir()
    with wave.open(str(tmp_path / "w" / "s.wav"), "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(16000), w.writeframes(b"\x00\x40\x00\xc0")
    (tmp_path / "w" / "broken.wav").write_text("no")
    assert {r["source"]: r["values"] for r in readers.read_pcm(spark, str(tmp_path / "w")).collect()} == {"s": [0.5, -0.5], "broken": []}
    out = str(tmp_path / "cache")
    for value in ("first", "second"):
        writers.write_new(spark.createDataFrame([("k", value), (value, value)], "key string, v string"), out, "key")
    assert {r["key"]: r["v"] for r in spark.read.parquet(out).collect()} == {"k": "first", "first": "first", "second": "second"}
    writers.write_lines(spark.createDataFrame([(2, "b"), (1, "a")], "n int, line string"), str(tmp_path / "report"), "n")
    assert "".join(p.read_text() for p in sorted((tmp_path / "report").glob("part-*"))) == "a\nb\n"


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["source", "phrase_no", "start", "stop", "speaker", "text"]


def test_streams_equal_batches(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").cast("string").alias("source"), F.col("ts").cast("timestamp").alias("at"), F.lit(None).cast("string").alias("speaker"))
    ordered = events.orderBy("at")
    ordered.limit(500).coalesce(1).write.parquet(str(tmp_path / "in"))
    ordered.offset(500).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def streamed(build, name):
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        q = build(stream).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(180)
        return {(r["source"], r["start"], r["stop"], r["n"]) for r in spark.table(name).collect()}

    want = {(r["source"], r["start"], r["stop"], r["n"]) for r in gap_sessions(events, "source", "at", 6 * 3600).collect()}
    # what the watermark, an hour behind the last event, has passed is closed
    passed = events.agg(F.max("at")).first()[0] - timedelta(hours=7)
    closed = {w for w in want if w[2] < passed}
    by_gap = streamed(lambda s: gap_sessions(s, "source", "at", 6 * 3600, "1 hour"), "by_gap")
    assert closed and closed <= by_gap <= want
    by_speaker = streamed(lambda s: speaker_sessions(s, 6 * 3600, "1 hour"), "by_speaker")
    assert closed <= by_speaker <= want


def test_streamed_sessions_split_by_speaker(spark, tmp_path):
    start = datetime(2024, 1, 1)
    said = [("a", 0, "x"), ("a", 1, None), ("a", 2, "x"), ("a", 3, "y"), ("a", 4, "y"), ("b", 0, None), ("b", 1, "x"), ("b", 2, "y"), ("a", 60, "x"), ("b", 60, "y"), ("c", 900, "z")]
    schema = "source string, at timestamp, speaker string"
    for k, part in enumerate((said[:5][::-1], said[5:])):  # a batch need not be in order
        spark.createDataFrame([(s, start + timedelta(minutes=m), who) for s, m, who in part], schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"part={k}"))
    stream = spark.readStream.schema(f"{schema}, part int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = speaker_sessions(stream, 1800, "1 minute").writeStream.format("memory").queryName("said").outputMode("append").option("checkpointLocation", str(tmp_path / "point")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(r["source"], int((r["start"] - start).total_seconds()) // 60, int((r["stop"] - start).total_seconds()) // 60, r["speaker"], r["n"]) for r in spark.table("said").collect()}
    assert got == {("a", 0, 2, "x", 3), ("a", 3, 4, "y", 2), ("b", 0, 2, None, 3), ("a", 60, 60, "x", 1), ("b", 60, 60, "y", 1)}


def test_pcm_of_another_form_has_no_values(spark, tmp_path):
    for name, channels, width in (("good", 1, 2), ("stereo", 2, 2), ("bytes", 1, 1)):
        with wave.open(str(tmp_path / f"{name}.wav"), "wb") as w:
            w.setnchannels(channels)
            w.setsampwidth(width)
            w.setframerate(16_000)
            w.writeframes(b"\x00\x40" * 8)
    got = {r["source"]: len(r["values"]) for r in readers.read_pcm(spark, str(tmp_path)).collect()}
    assert got == {"good": 8, "stereo": 0, "bytes": 0}


def test_long_source_snaps_in_linear_time(spark):
    n = 20_000
    edges = spark.range(n).select(F.lit(1).alias("source"), (F.col("id") * 7 + 3).alias("at"))
    marks = spark.range(n).select(F.lit(1).alias("source"), (F.col("id") * 10).alias("at"))
    wrong = intervals.snap(edges, marks).where(F.col("snapped") != F.when(F.col("at") % 10 <= 5, F.floor(F.col("at") / 10) * 10).otherwise(F.ceil(F.col("at") / 10) * 10))
    assert wrong.where(f"at <= {10 * (n - 1)}").count() == 0


@pytest.mark.parametrize("width", [None, 1, 7, 1000])
def test_snapping_equals_a_search(spark, width):
    rng = random.Random(5)
    edges = [(s, rng.choice((None, *range(-40, 160))), i) for i, s in enumerate(rng.choices(("hot", "hot", "b", "bare"), k=80))]
    marks = [(rng.choice(("hot", "hot", "b", "other")), rng.choice((None, *range(-50, 170)))) for _ in range(60)]
    frames = spark.createDataFrame(edges, "source string, at int, n int"), spark.createDataFrame(marks, "source string, at int")
    got = {r["n"]: r["snapped"] for r in intervals.snap(*frames, width).collect()}
    near = lambda s, at: min((m for k, m in marks if k == s and m is not None), key=lambda m: (abs(m - at), m), default=None)
    assert got == {n: None if at is None else near(s, at) for s, at, n in edges}


@pytest.mark.parametrize("width", [None, 2, 50])
def test_offsets_of_fractions_and_null_lists(spark, width):
    rows = [(e, i, 0.25 * i, 0.25 * i + 0.5 * (i % 4)) for e in ("a", None) for i in range(9)]
    got = {(r["edl_id"], r["ord"]): r["offset"] for r in intervals.offsets(spark.createDataFrame(rows, "edl_id string, ord int, start double, stop double"), width).collect()}
    assert got == {(e, i): sum(0.5 * (k % 4) for k in range(i)) for e in ("a", None) for i in range(9)}


def test_a_hot_source_is_many_tasks(spark):
    """A third of all tokens, 30,000, in one source: no window of tokens holds more than a stretch or an island of it."""
    from pyspark.sql import functions as F

    rows = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 1000).alias("source"), F.col("id").alias("pos"), F.lit("word").alias("type"), F.lit("a").alias("text"), (F.col("id") + F.floor(F.col("id") / 300) * 900).alias("start"))
    tokens = rows.withColumns({"stop": F.col("start") + 1, "speaker": F.lit(None).cast("string")})
    plan = sessions.phrases(tokens, 500, 1000)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "[pos#" in line]
    assert windows and all(", stretch#" in line or ", island#" in line for line in windows)
    got = sessions.phrases(tokens, 500, 1000).groupBy("source").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("letters")).where("source = -1").collect()[0]
    assert (got["n"], got["letters"]) == (300, 2 * 30_000 - 300)


def test_unlisted_source_stops_a_strict_read(spark, tmp_path):
    (tmp_path / "cut.json").write_text(json.dumps({"sources": {"B": "b.mp4", "A": "../a.mp4"}, "ranges": [{"source": "A", "start": 0, "end": 1}, {"source": "C", "start": 0, "end": 1}]}))
    edls = readers.read_edls(spark, str(tmp_path))
    assert [r.path for r in readers.edl_ranges(edls, "/takes/one").orderBy("ord").collect()] == ["/takes/a.mp4", None]
    with pytest.raises(Exception, match="unknown source C, known: A, B"):
        readers.edl_ranges(edls, strict=True).collect()


def test_range_errors_of_odd_rows(spark):
    ranges = spark.createDataFrame([("e", 0, "A", 0.0, 1.0), ("e", 1, None, 0.0, None), ("e", 2, "Z", 2.0, 1.0), ("none", 0, "A", 0.0, 1.0)], "edl_id string, ord int, source string, start double, stop double")
    sources = spark.createDataFrame([("e", "B"), ("e", "A")], "edl_id string, source string")
    got = sorted(tuple(r) for r in checks.range_errors(ranges, sources).collect())
    assert got == [("e", 1, "source is missing"), ("e", 1, "stop is missing"), ("e", 2, "stop must be after start"), ("e", 2, "unknown source Z, known: A, B"), ("none", 0, "unknown source A, known: ")]
    assert checks.range_errors(ranges.limit(0), sources).count() == 0


def test_statistics_lines(spark):
    text = ["frame:0", "lavfi.signalstats.YBITDEPTH=8", "lavfi.signalstats.YAVG=100", "lavfi.signalstats.YBITDEPTH=10", "lavfi.signalstats.YAVG=x", "lavfi.signalstats.YAVG=200"]
    lines = spark.createDataFrame([("a", i, x) for i, x in enumerate(text)] + [("dark", 0, "lavfi.signalstats.YMAX=9")], "clip string, pos int, line string")
    got = {r.clip: (round(r.y_mean, 6), r.y_range, r.sat_mean) for r in signals.line_statistics(readers.frame_values(lines), "clip").collect()}
    assert got == {"a": (round(150 / 1023, 6), 0.7, 0.25), "dark": (0.5, 0.72, 0.25)}


def test_memory_keeps_the_last_session(spark, tmp_path):
    path = str(tmp_path / "memory")
    for n, note in ((1, "first"), (2, "second")):
        writers.append_entry(spark.createDataFrame([("p", n, note)], "project string, session int, note string"), path)
    assert [tuple(r) for r in intervals.latest(spark.read.parquet(path), "project", "session", "note").collect()] == [("p", 2, "second")]


def test_phrases_of_a_report_are_read_once(spark, sf_dir):
    from spanloom.plans.queries import QUERIES

    plan = lambda name: QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan("pack_lines").count("Scan parquet") == 2  # the names, and the tokens once
    assert plan("silences").count("SortMergeJoin") + plan("silences").count("HashJoin") == 1


def test_report_of_a_silent_source(spark):
    tokens = spark.createDataFrame([("a", 0, "word", "hi", 0.0, 1.0, "speaker_0"), ("a", 1, "word", "there", 2.0, 3.5, "speaker_0")], TOKENS)
    sources = spark.createDataFrame([("a",), ("b",)], "source string")
    lines = sessions.report_lines(sources, sessions.phrases(tokens, 0.5), 0.5).orderBy("source", "line_no").collect()
    assert [r.line for r in lines[5:]] == ["## a  (duration: 3.5s, 2 phrases)", "  [000.00-001.00] S0 hi", "  [002.00-003.50] S0 there", "", "## b  (duration: 0.0s, 0 phrases)", "  _no speech detected_", ""]


def test_tokens_stay_in_as_many_tasks_as_the_session_sets(spark, sf_dir):
    """Words shrink so far that partitions joined by what is read would be one task here."""
    from spanloom.plans.queries import QUERIES

    for name in ("snap_asof", "phrases"):
        assert QUERIES[name](spark, sf_dir).select(F.spark_partition_id()).distinct().count() > 2, name


def test_turns_of_tokens_stay_in_many_tasks(spark, sf_dir):
    """What interval sets and snapping by stretches are made of."""
    from spanloom.sources.tables import conversation_tokens, turns

    assert turns(conversation_tokens(spark, sf_dir)).select(F.spark_partition_id()).distinct().count() > 2


def test_words_are_dealt_to_more_tasks_as_more_is_read(spark, tmp_path):
    """A session that sets few partitions gets more of them for a longer table, so the words of a task stay bounded."""
    from spanloom.sources.tables import SPREAD, conversation_tokens

    rows = spark.range(400).selectExpr("id as conv_id", "0L as turn", "'user' as role", "'one two three' as text")
    found = []
    with_few = spark.newSession()
    with_few.conf.set("spark.sql.shuffle.partitions", "3")
    with_few.conf.set("spark.sql.files.openCostInBytes", str(1 << 27))  # a file is a split
    for files in (1, 4):
        rows.repartition(files).write.parquet(f"{tmp_path}/{files}/conversations.parquet")
        tokens = conversation_tokens(with_few, f"{tmp_path}/{files}")
        assert tokens.count() == 1200
        found.append(tokens.rdd.getNumPartitions())
    assert found == [SPREAD, 4 * SPREAD]
