"""A data source of requests to a pluggable provider, such as a speech recogniser."""

from __future__ import annotations

import importlib
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .pcm import open_store
from .readers import TRANSCRIPT

#: (path, options) -> the answer's text; whatever it raises is a failed attempt.
Provider = Callable[[str, dict[str, str]], str]
CHARACTERS = 500


@dataclass(frozen=True)
class Request(InputPartition):
    path: str


def provider_of(name: str) -> Provider:
    """The function that ``module:function`` names."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options
        self.retries = int(options.get("retries", 2))
        self.wait = float(options.get("waitseconds", 1.0))

    def partitions(self) -> Sequence[Request]:
        store, path = open_store(self.options["path"])
        wanted = tuple(x.strip() for x in self.options.get("extensions", "").split(",") if x.strip())
        found = store.get_file_info(fs.FileSelector(path))
        return [Request(p) for p in sorted(f.path for f in found if f.is_file) if p.endswith(wanted or "")]

    def read(self, part: Request) -> Iterator[tuple]:
        name = part.path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
        provider = provider_of(self.options["provider"])
        error = None
        for attempt in range(1, self.retries + 2):
            try:
                yield name, part.path, provider(part.path, self.options), None, attempt
                return
            except Exception as e:  # a provider may fail in any way; the row says how
                error = f"{type(e).__name__}: {e}"[:CHARACTERS]
                if attempt <= self.retries:
                    time.sleep(self.wait * 2 ** (attempt - 1))
        yield name, part.path, None, error, self.retries + 1


class RequestSource(DataSource):
    """Format ``requests``: source, path, answer, error and attempts; one row and one task for each file of a folder.

    Options: ``path``, ``extensions`` (comma-separated, all by default),
    ``provider`` (``module:function``, imported by the tasks), ``retries`` and
    ``waitSeconds`` (doubled after each failure); all options, in lower case,
    go to the provider.  A request that fails to the last is a row with an
    error, so it fails no job.
    """

    @classmethod
    def name(cls) -> str:
        return "requests"

    def schema(self) -> str:
        return "source string, path string, answer string, error string, attempts int"

    def reader(self, schema) -> DataSourceReader:
        return _Reader({k.lower(): v for k, v in self.options.items()})


def ask(spark: SparkSession, folder: str, provider: str, **options: str | int | float) -> DataFrame:
    """The answers of ``provider`` to the files of ``folder``; see :class:`RequestSource`."""
    spark.dataSource.register(RequestSource)
    return spark.read.format("requests").options(path=folder, provider=provider, **options).load()


def answer_tokens(answers: DataFrame) -> DataFrame:
    """source, pos, type, text, start, stop and speaker of the answers that are transcripts."""
    words = answers.select("source", F.posexplode(F.from_json("answer", TRANSCRIPT)["words"]).alias("pos", "w"))
    return words.select("source", "pos", "w.type", "w.text", "w.start", F.col("w.end").alias("stop"), F.col("w.speaker_id").alias("speaker"))
