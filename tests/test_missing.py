"""Streams out of order, split sound, write-once files, requests, false starts and interval sets."""

import json
import random
import struct
import threading
import wave
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from spanloom.operators import checks, sessions, signals, slips, spans, stretches
from spanloom.sources import cache, pcm, readers
from spanloom.sources import requests as asked
from spanloom.streaming.phrases import stream_phrases

ZERO = datetime(2024, 1, 1, tzinfo=timezone.utc)
STREAM = "source string, pos long, type string, text string, start timestamp, stop timestamp, speaker string"


def spoken(rng, n_sources=4, n=160):
    """Tokens in tenths of a second, with silences, changes of speaker, blanks, missing ends and speakers."""
    rows = []
    for s in range(n_sources):
        at = 0
        for pos in range(n):
            at += rng.choice((0, 1, 2, 2, 9)) if pos else 0
            length = rng.choice((1, 2, 3))
            kind = rng.choice(("word", "word", "word", "spacing", "audio_event", None))
            text = " " if kind == "spacing" else rng.choice(("one", "two,", ".", " ", None, "(sigh)", "x"))
            rows.append((f"s{s}", pos, kind, text, at, None if rng.random() < 0.1 else at + (6 if kind == "spacing" and rng.random() < 0.3 else length), rng.choice(("A", "A", "A", "B", None))))
            at += length
    return rows


def as_times(rows):
    moment = lambda t: None if t is None else ZERO + timedelta(milliseconds=100 * t)
    return [(s, p, k, t, moment(a), moment(b), w) for s, p, k, t, a, b, w in rows]


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset(name)


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_of_shuffled_tokens_equals_phrases(spark, rocks, tmp_path, seed):
    rng = random.Random(seed)
    rows = spoken(rng)
    # a token comes up to 3 s late, in micro-batches of 40; the last ones push the watermark on
    order = sorted(as_times(rows), key=lambda r: r[4] + timedelta(seconds=3 * rng.random()))
    batches = [order[i : i + 40] for i in range(0, len(order), 40)]
    end = max(r[4] for r in order) + timedelta(seconds=60)
    batches += [[("end", k, "word", "end", end + timedelta(seconds=9 * k), None, None)] for k in range(3)]
    folder = tmp_path / "in"
    folder.mkdir()
    whole = lambda t: None if t is None else t.strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    for i, batch in enumerate(batches):
        (folder / f"{i:03}.json").write_text("\n".join(json.dumps(dict(zip(("source", "pos", "type", "text", "start", "stop", "speaker"), (s, p, k, t, whole(a), whole(b), w), strict=True))) for s, p, k, t, a, b, w in batch))
    import os

    for i, f in enumerate(sorted(folder.iterdir())):
        os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    stream = spark.readStream.schema(STREAM).option("maxFilesPerTrigger", 1).json(str(folder))
    run = stream_phrases(stream, 0.5, "4 seconds").writeStream.format("memory").queryName(f"phrases{seed}").outputMode("append").option("checkpointLocation", str(tmp_path / "point")).trigger(availableNow=True).start()
    run.awaitTermination()
    state = [p["stateOperators"][0]["numRowsTotal"] for p in run.recentProgress if p["stateOperators"]]
    got = sorted((r["source"], r["start"], r["stop"], r["speaker"], r["text"]) for r in spark.table(f"phrases{seed}").where("source <> 'end'").collect())
    batch = sessions.phrases(spark.createDataFrame([r for r in rows], "source string, pos int, type string, text string, start int, stop int, speaker string"), 5)
    moment = lambda c: F.timestamp_micros(F.col(c).cast("long") * 100_000 + int(ZERO.timestamp()) * 1_000_000)
    want = sorted((r["source"], r["a"], r["b"], r["speaker"], r["text"]) for r in batch.select("source", moment("start").alias("a"), moment("stop").alias("b"), "speaker", "text").collect())
    assert got == want and len(want) > 60
    assert max(state) < len(rows) / 2  # what waits, not what was read


def wav(path, values, rate=16_000, channels=1, width=2, extra=b""):
    with wave.open(str(path), "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        w.writeframes(np.asarray(values, "<i2").tobytes() if width == 2 else bytes(len(values)))
    if extra:  # a chunk between format and sound
        raw = path.read_bytes()
        path.write_bytes(raw[:4] + struct.pack("<I", len(raw) + len(extra)) + raw[8:36] + b"LIST" + struct.pack("<I", len(extra)) + extra + raw[36:])


def test_sound_is_split_and_its_envelope_equals_the_array_form(spark, tmp_path):
    rng = np.random.default_rng(1)
    sounds = {"a": rng.integers(-32768, 32768, 10_007), "short": rng.integers(-9, 9, 7), "silent": np.zeros(500, int), "none": np.zeros(0, int)}
    for name, values in sounds.items():
        wav(tmp_path / f"{name}.wav", values, extra=b"xyz \n" + bytes(3) if name == "a" else b"")
    wav(tmp_path / "stereo.wav", np.zeros(50), channels=2)
    (tmp_path / "broken.wav").write_bytes(b"RIFF1234")
    (tmp_path / "other.txt").write_text("no sound")
    blocks = pcm.read_sound(spark, str(tmp_path), split_bytes=1000)
    assert blocks.rdd.getNumPartitions() > 25
    rows = blocks.collect()
    assert {r["source"] for r in rows if r["error"]} == {"stereo", "broken"} and max(len(r["samples"]) for r in rows) <= 500
    for name, values in sounds.items():
        mine = sorted((r["first"], r["samples"]) for r in rows if r["source"] == name)
        assert [x for _, part in mine for x in part] == values.tolist() and {r["total"] for r in rows if r["source"] == name} == {len(values)}
    for samples in (10, 64):
        level = {(r["source"], r["i"]): r["value"] for r in signals.block_envelope(blocks, samples).collect()}
        array = readers.read_pcm(spark, str(tmp_path / "*.wav"))
        assert level == {(r["source"], r["i"]): r["value"] for r in signals.rms_envelope(array, "source", "values", samples).collect()}


def test_an_hour_of_sound_is_many_tasks(spark, tmp_path):
    values = (np.arange(3600 * 16_000) * 7919 % 65_536 - 32_768).astype(np.int16)
    wav(tmp_path / "hour.wav", values)
    blocks = pcm.read_sound(spark, str(tmp_path / "hour.wav"), split_bytes=8 << 20)
    assert blocks.rdd.getNumPartitions() == 14
    got = [r["value"] for r in signals.block_envelope(blocks, 200).orderBy("i").collect()]
    levels = np.sqrt((values.astype(np.int64) ** 2).reshape(200, -1).sum(1) / (len(values) // 200)) / 32768
    assert got == pytest.approx((levels / levels.max()).tolist(), abs=1e-12)


def test_cache_files_are_written_once(spark, tmp_path):
    folder = str(tmp_path / "cache")
    rows = spark.createDataFrame([("/takes/a.mp4", "1"), ("/other/a.mov", "2"), ("/takes/b.c.mp4", "3"), (None, "4"), ("/takes/b.c.mp4", "3")], "path string, words string")
    clashes = cache.write_once(rows, folder, content=F.to_json(F.struct("words")))
    assert [(r["stem"], r["n"], r["paths"]) for r in clashes.collect()] == [("a", 2, ["/other/a.mov", "/takes/a.mp4"])]
    there = lambda: {f.name: f.read_text() for f in (tmp_path / "cache").iterdir()}
    assert there() == {"a.json": '{"words":"2"}', "b.c.json": '{"words":"3"}'}
    cache.write_once(rows.withColumn("words", F.lit("new")).unionByName(spark.createDataFrame([("c.mp4", "5")], "path string, words string")), folder, content=F.to_json(F.struct("words")))
    assert there() == {"a.json": '{"words":"2"}', "b.c.json": '{"words":"3"}', "c.json": '{"words":"5"}'}
    with pytest.raises(Exception, match="never overwrites"):
        rows.selectExpr("path AS stem", "words AS content").write.format("write_once").mode("overwrite").save(folder)


def test_two_writers_and_an_aborted_job(spark, tmp_path):
    folder = tmp_path / "cache"
    rows = spark.range(200).select(F.format_string("/t/v%03d.mp4", "id").alias("path")).repartition(8)
    errors = []

    def write(mark):
        try:
            spark._jvm.org.apache.spark.sql.classic.SparkSession.setActiveSession(spark._jsparkSession)  # of this thread: sources are looked up in it
            cache.write_once(rows, str(folder), content=F.lit(mark))
        except Exception as e:  # pragma: no cover
            errors.append(e)

    both = [threading.Thread(target=write, args=(mark,)) for mark in ("one", "two")]
    [t.start() for t in both]
    [t.join() for t in both]
    assert not errors, [str(e.java_exception)[:3000] for e in errors]
    assert sorted(f.name for f in folder.iterdir()) == [f"v{i:03}.json" for i in range(200)] and {f.read_text() for f in folder.iterdir()} <= {"one", "two"}
    bad = spark.range(40).repartition(4).select(F.col("id").cast("string").alias("stem"), F.when(F.col("id") == 17, F.raise_error(F.lit("no answer"))).otherwise("x").alias("content"))
    (tmp_path / "none").mkdir()
    with pytest.raises(Exception, match="no answer|Writing job aborted|aborted"):
        bad.write.format("write_once").mode("append").save(str(tmp_path / "none"))
    assert list((tmp_path / "none").iterdir()) == []


def test_a_task_that_outlives_its_job_leaves_no_file(tmp_path):
    writer = cache._Writer(str(tmp_path))

    def rows():
        yield Row(stem="a", content="x")
        writer.abort([])
        yield Row(stem="b", content="y")

    with pytest.raises(FileNotFoundError):
        writer.write(rows())
    assert list(tmp_path.iterdir()) == []


PROVIDER = '''
import json, pathlib

def transcript(path, options):
    """Answers with the file's own text; `flaky` fails at first, `bad` always."""
    tried = pathlib.Path(options["log"]) / pathlib.Path(path).name
    n = len(tried.read_text()) if tried.exists() else 0
    tried.write_text("x" * (n + 1))
    if "bad" in path or ("flaky" in path and n == 0):
        raise ConnectionError("status 500: " + "y" * 900)
    return json.dumps({"words": [{"type": "word", "text": pathlib.Path(path).read_text(), "start": 0.0, "end": 1.0, "speaker_id": options["speaker"]}]})
'''


def test_requests_retry_and_report(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "log").mkdir()
    (tmp_path / "file_backed_provider.py").write_text(PROVIDER)
    spark.sparkContext.addPyFile(str(tmp_path / "file_backed_provider.py"))
    for name in ("good.wav", "flaky.wav", "bad.wav", "skipped.txt"):
        (tmp_path / "in" / name).write_text(name)
    answers = asked.ask(spark, str(tmp_path / "in"), "file_backed_provider:transcript", extensions=".wav", retries=2, waitSeconds=0.01, log=str(tmp_path / "log"), speaker="s1")
    assert answers.rdd.getNumPartitions() == 3
    rows = {r["source"]: r for r in answers.collect()}
    assert rows["good"]["attempts"] == 1 and rows["flaky"]["attempts"] == 2 and rows["flaky"]["error"] is None
    assert rows["bad"]["attempts"] == 3 and rows["bad"]["answer"] is None and rows["bad"]["error"].startswith("ConnectionError: status 500") and len(rows["bad"]["error"]) == 500
    kept = spark.createDataFrame(list(rows.values()), answers.schema)
    assert sorted((r["source"], r["text"], r["speaker"]) for r in asked.answer_tokens(kept).collect()) == [("flaky", "flaky.wav", "s1"), ("good", "good.wav", "s1")]
    assert [(r["n"], r["n_failed"]) for r in checks.failures(kept.withColumn("all", F.lit(1)), "all").collect()] == [(3, 1)]


def plain_false_starts(words, longest=4):
    out, i = [], 0
    while i < len(words):
        n = next((n for n in range(longest, 0, -1) if i + 2 * n <= len(words) and words[i : i + n] == words[i + n : i + 2 * n]), 0)
        if n:
            out.append((i, n))
        i += n or 1
    return out


@pytest.mark.parametrize("width", [5, 16, 4096])
def test_false_starts_equal_a_walk(spark, width):
    rng = random.Random(width)
    said = {f"s{k}": [rng.choice("ab" if k % 2 else "abcdefgh") for _ in range(rng.choice((0, 1, 7, 120)))] for k in range(12)}
    said["hot"] = ["no"] * 300 + [rng.choice("xyz") for _ in range(900)]
    said["i was"] = "I was I was, I was there".split()
    rows = [(s, 3 * i + 1, "word", w.upper() + rng.choice(("", ",", "...")), 0, 1, None) for s, ws in said.items() for i, w in enumerate(ws)]
    rows += [(s, 3 * i + 2, kind, text, 0, 1, None) for s in said for i, (kind, text) in enumerate([("spacing", " "), ("word", None), ("word", "..."), ("audio_event", "a")])]
    tokens = spark.createDataFrame(rows, "source string, pos int, type string, text string, start int, stop int, speaker string").repartition(3)
    got = sorted((r["source"], r["pos"], r["length"]) for r in slips.false_starts(tokens, width=width).collect())
    assert got == sorted((s, 3 * i + 1, n) for s, ws in said.items() for i, n in plain_false_starts([w.lower().rstrip(",") for w in ws]))
    counts = {r["source"]: r["n_false_starts"] for r in slips.slip_counts(tokens, slips.false_starts(tokens, width=width), ("a",)).collect()}
    assert counts["i was"] == 2 and counts["hot"] >= 299


def test_false_starts_move_their_words_once(spark):
    """What both readings of the runs need is moved once (before, both moved it: 13 exchanges)."""
    rows = [(s, i, "word", "a b c"[i % 5 % 3 * 2]) for s in range(4) for i in range(1, 60)]
    found = slips.false_starts(spark.createDataFrame(rows, "source int, pos int, type string, text string").repartition("source"), width=8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") <= 11


@pytest.mark.parametrize("width", [3, 10_000])
def test_interval_sets_equal_moments(spark, width):
    rng = random.Random(width)
    draw = lambda n: [(rng.choice(("hot", "hot", "b", None)), a := rng.randrange(-20, 120), a + rng.choice((-1, 0, 1, 2, 9, 30))) for _ in range(n)]
    one, other = [*draw(60), ("b", None, 5), ("b", 3, None)], draw(50)
    frame = lambda rows: spark.createDataFrame(rows, "k string, start int, stop int")
    kinds = {"union": lambda a, b: a or b, "intersection": lambda a, b: a and b, "difference": lambda a, b: a and not b, "exclusion": lambda a, b: a != b}
    want = []
    for k in {r[0] for r in one + other}:
        held = [{t for kk, a, b in side if kk == k and None not in (a, b) for t in range(a, b)} for side in (one, other)]
        for kind, rule in kinds.items():
            inside = [t for t in range(-30, 200) if rule(t in held[0], t in held[1])]
            starts, stops = [t for t in inside if t - 1 not in inside], [t + 1 for t in inside if t + 1 not in inside]
            want += [(str(k), kind, a, b) for a, b in zip(starts, stops, strict=True)]
    got = spans.interval_sets(frame(one), frame(other), "k", width)
    assert sorted((str(r["k"]), r["kind"], r["start"], r["stop"]) for r in got.collect()) == sorted(want)
    depth = lambda k, t: sum(kk == k and None not in (a, b) and a <= t < b for kk, a, b in one)
    for r in spans.peak_depth(frame(one), "k", width, 6).collect():
        top = max(depth(r["k"], t) for t in range(-30, 200))
        assert (r["peak"], r["fits"]) == (top, top <= 6) and r["at"] == min(t for t in range(-30, 200) if depth(r["k"], t) == top)


def test_running_values_of_a_hot_key(spark):
    rows = [("hot" if i % 3 else str(i % 7), i, i % 11 if i % 5 else None) for i in range(600)]
    table = spark.createDataFrame(rows, "k string, i int, x int").repartition(5)
    for width in (1, 13, 1000):
        got = stretches.running(table, ["k"], "i", width, sums={"total": F.col("x")}, maxima={"top": F.col("x")}).collect()
        assert len(got) == len(rows)
        for r in got:
            before = [x for k, i, x in rows if k == r["k"] and i <= r["i"] and x is not None]
            assert (r["total"], r["top"]) == (sum(before), max(before, default=None))
