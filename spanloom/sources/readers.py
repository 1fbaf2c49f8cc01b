"""Files of the editing model as DataFrames."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import embedded_object, first_filled, resolve_path
from ..operators.checks import required_path

# The extensions of media files, by case; the keys of statistics lines and of loudness objects.
MEDIA_EXTENSIONS = (".mp4", ".MP4", ".mov", ".MOV", ".mkv", ".MKV", ".avi", ".AVI", ".m4v")
STATISTICS_PREFIX, STATISTICS_KEYS = "lavfi.signalstats.", ("YAVG", "YMIN", "YMAX", "SATAVG", "YBITDEPTH")
LOUDNESS_KEYS = ("input_i", "input_tp", "input_lra", "input_thresh", "target_offset")

TOKEN = "struct<type:string,text:string,start:double,end:double,speaker_id:string>"
TRANSCRIPT = f"words array<{TOKEN}>"
EDL = (
    "sources map<string,string>, ranges array<struct<source:string,start:double,end:double,beat:string,note:string>>, "
    "grade string, overlays array<struct<file:string,start_in_output:double,duration:double>>, subtitles string, total_duration_s double"
)


def stem(path: Column) -> Column:
    """The file name without folder and last extension."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")


def extension(path: Column) -> Column:
    """The last extension of a file name, with its dot; empty without one."""
    return F.regexp_extract(path, r"[^/](\.[^./]+)$", 1)


def with_extension(paths: DataFrame, column: str, extensions: tuple[str, ...] = MEDIA_EXTENSIONS) -> DataFrame:
    """The rows whose path ends in one of the extensions (by case)."""
    return paths.where(extension(F.col(column)).isin(*extensions))


def list_files(spark: SparkSession, folder: str, extensions: tuple[str, ...] = MEDIA_EXTENSIONS) -> DataFrame:
    """path and stem of the files of a folder, not below it; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(folder).select("path")
    return with_extension(found, "path", extensions).withColumn("stem", stem(F.col("path")))


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """Tokens of transcript files: source (the file's stem), pos, type, text, start, stop, speaker."""
    files = spark.read.schema(TRANSCRIPT).json(path, multiLine=True).select(stem(F.col("_metadata.file_name")).alias("source"), "words")
    each = files.select("source", F.posexplode("words").alias("pos", "w"))
    return each.select("source", "pos", "w.type", "w.text", "w.start", F.col("w.end").alias("stop"), F.col("w.speaker_id").alias("speaker"))


def default_transcripts(videos: DataFrame, files: DataFrame) -> DataFrame:
    """``videos`` (path, ...) with ``transcript``: the file in its folder's edit/transcripts, null where ``files`` (path) has none."""
    folder = F.regexp_extract("path", "^(.*/)?[^/]*$", 1)
    wanted = F.concat(folder, F.lit("edit/transcripts/"), stem(F.col("path")), F.lit(".json"))
    there = files.select(F.col("path").alias("transcript")).distinct()
    return videos.withColumn("wanted_transcript", wanted).join(there, F.col("wanted_transcript") == F.col("transcript"), "left").drop("wanted_transcript")


def read_edls(spark: SparkSession, path: str) -> DataFrame:
    """Edit lists, one row each, with edl_id from the file's stem."""
    return spark.read.schema(EDL).json(path, multiLine=True).withColumn("edl_id", stem(F.col("_metadata.file_name")))


def edl_ranges(edls: DataFrame, folder: str | None = None, strict: bool = False) -> DataFrame:
    """edl_id, ord, source, path, start, stop and note of each range.

    An unlisted source has a null path, or stops the query if ``strict``.
    Paths that are not absolute lie below ``folder``, where it is given.
    """
    each = edls.select("edl_id", "sources", F.posexplode("ranges").alias("ord", "r"))
    note = first_filled(F.col("r.beat"), F.col("r.note"))
    path = required_path(F.col("sources"), F.col("r.source")) if strict else F.try_element_at("sources", F.col("r.source"))
    path = path if folder is None else resolve_path(path, F.lit(folder))
    return each.select("edl_id", "ord", "r.source", path.alias("path"), "r.start", F.col("r.end").alias("stop"), note.alias("note"))


def edl_overlays(edls: DataFrame) -> DataFrame:
    """edl_id, z, file, start and duration of each overlay; none for a missing list."""
    each = edls.select("edl_id", F.posexplode(F.coalesce("overlays", F.array().cast("array<struct<file:string,start_in_output:double,duration:double>>"))).alias("z", "o"))
    return each.select("edl_id", "z", "o.file", F.col("o.start_in_output").alias("start"), "o.duration")


def frame_values(lines: DataFrame) -> DataFrame:
    """clip, pos, key and value of the statistics lines (clip, pos, line); others are skipped."""
    key = F.regexp_extract("line", f"({'|'.join(STATISTICS_KEYS)})", 1)
    value = F.substring_index("line", "=", -1).try_cast("double")
    return lines.where(F.col("line").contains(STATISTICS_PREFIX) & F.col("line").contains("=")).select("clip", "pos", key.alias("key"), value.alias("value")).where("key <> '' and value is not null")


def loudness(logs: DataFrame, column: str = "log") -> DataFrame:
    """``logs`` with ``measured``: the loudness object in a log text, null if it is missing, broken or incomplete."""
    fields = ",".join(f"{k}:string" for k in LOUDNESS_KEYS)
    parsed = F.from_json(embedded_object(F.col(column)), f"struct<{fields}>")
    whole = F.forall(F.array(*[parsed[k] for k in LOUDNESS_KEYS]), lambda x: x.isNotNull())
    return logs.withColumn("measured", F.when(whole, parsed))


def read_pcm(spark: SparkSession, path: str) -> DataFrame:
    """source and values (-1 to 1) of mono 16-bit WAV files; none if a file cannot be read or is of another form."""
    import io
    import wave

    import numpy as np

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for content in batch["content"]:
                try:
                    with wave.open(io.BytesIO(content)) as w:
                        raw = w.readframes(w.getnframes()) if (w.getnchannels(), w.getsampwidth()) == (1, 2) else b""
                    rows.append((np.frombuffer(raw[: len(raw) // 2 * 2], "<i2").astype(np.float32) / 32768).tolist())
                except (wave.Error, EOFError):
                    rows.append([])
            yield pd.DataFrame({"source": batch["source"], "values": rows})

    files = spark.read.format("binaryFile").load(path).select(stem(F.col("path")).alias("source"), "content")
    return files.mapInPandas(decode, T.StructType([T.StructField("source", T.StringType()), T.StructField("values", T.ArrayType(T.FloatType()))]))
