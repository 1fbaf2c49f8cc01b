"""WAV files as rows of samples: a data source that splits the sound of a file by byte ranges."""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "source string, rate int, total long, first long, samples array<smallint>, error string"
#: Bytes of sound in a partition, and samples in a row.
SPLIT_BYTES, ROW_SAMPLES = 32 << 20, 1 << 14
_TO_THE_END = 0xFFFFFFFF  # what a writer that does not know the length leaves


@dataclass(frozen=True)
class SoundRange(InputPartition):
    path: str
    low: int
    high: int


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def wav_layout(file: BinaryIO, size: int) -> tuple[int, int, int]:
    """Rate, and first and last byte (exclusive) of the sound of a mono 16-bit file; the chunks before it are skipped."""
    if file.read(4) not in (b"RIFF", b"RF64") or file.read(8)[4:] != b"WAVE":
        raise ValueError("not a WAV file")
    rate = 0
    while len(head := file.read(8)) == 8:
        name, length = head[:4], struct.unpack("<I", head[4:])[0]
        at = file.tell()
        if name == b"data":
            if not rate:
                raise ValueError("no format before the sound")
            stop = size if length == _TO_THE_END else min(size, at + length)
            return rate, at, at + (stop - at) // 2 * 2
        if name == b"fmt ":
            kind, channels, rate, _, _, bits = struct.unpack("<HHIIHH", file.read(16))
            if (channels, bits) != (1, 16) or kind not in (1, 0xFFFE):
                raise ValueError("not mono 16-bit sound")
        file.seek(at + length + length % 2)
    raise ValueError("no sound")


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.split = max(2, int(options.get("splitbytes", SPLIT_BYTES)) // 2 * 2)
        self.row = int(options.get("rowsamples", ROW_SAMPLES))

    def partitions(self) -> Sequence[SoundRange]:
        """Ranges of each file's size: a header is read by the tasks, not here."""
        store, path = open_store(self.path)
        info = store.get_file_info(path)
        files = [info] if info.is_file else store.get_file_info(fs.FileSelector(path))
        found = [(f.path, f.size) for f in files if f.is_file and f.extension.lower() == "wav"]
        return [SoundRange(p, low, low + self.split) for p, size in sorted(found) for low in range(0, max(size, 1), self.split)]

    def read(self, part: SoundRange) -> Iterator[pa.RecordBatch]:
        name = part.path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
        store, _ = open_store(self.path)
        try:
            with store.open_input_file(part.path) as file:
                rate, low, high = wav_layout(file, file.size())
                total = (high - low) // 2
                if part.low == 0 and not total:
                    yield self._rows(name, rate, 0, 0, pa.array([], pa.int16()), None)
                at, stop = low + part.low, min(high, low + part.high)
                while at < stop:
                    file.seek(at)
                    data = file.read(min(2 * self.row, stop - at))
                    yield self._rows(name, rate, total, (at - low) // 2, pa.Array.from_buffers(pa.int16(), len(data) // 2, [None, pa.py_buffer(data)]), None)
                    at += len(data)
        except (OSError, ValueError, struct.error) as e:
            if part.low == 0:
                yield self._rows(name, 0, 0, 0, pa.array([], pa.int16()), str(e)[:500])

    @staticmethod
    def _rows(name: str, rate: int, total: int, first: int, samples: pa.Array, error: str | None) -> pa.RecordBatch:
        values = pa.ListArray.from_arrays(pa.array([0, len(samples)], pa.int32()), samples)
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([rate], pa.int32()), pa.array([total], pa.int64()), pa.array([first], pa.int64()), values, pa.array([error], pa.string())], ["source", "rate", "total", "first", "samples", "error"])


class PcmSource(DataSource):
    """Format ``pcm``: source (the file's stem), rate, total (samples of the file), first (number of the row's first sample), samples and error.

    Options: ``path`` (a file, or a folder of .wav files), ``splitBytes``
    (bytes of sound in a partition) and ``rowSamples`` (samples in a row).  A
    file that cannot be read, or is of another form than mono 16-bit, is one row
    with an error and no samples; one without sound is one row too.  Samples are
    little-endian in the file and taken as they are.
    """

    @classmethod
    def name(cls) -> str:
        return "pcm"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader({k.lower(): v for k, v in self.options.items()})


def read_sound(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The samples of WAV files below ``path``; see :class:`PcmSource`."""
    spark.dataSource.register(PcmSource)
    return spark.read.format("pcm").option("path", path).option("splitBytes", split_bytes).load()
