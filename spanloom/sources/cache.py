"""A cache of files that are written once, as a data source for writing."""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator
from contextlib import suppress
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from .readers import stem


@dataclass
class _Written(WriterCommitMessage):
    names: list[tuple[str, str]]  # of the temporary file, of the final one


class _Writer(DataSourceWriter):
    """Tasks write temporary files into a folder of the run; the driver links them to their names when all tasks are done."""

    def __init__(self, folder: str):
        self.folder, self.run = folder, f".{uuid.uuid4().hex}"
        (Path(folder) / self.run).mkdir()

    def write(self, rows: Iterator[Row]) -> _Written:
        names = []
        for row in rows:
            if not row["stem"] or "/" in row["stem"]:
                raise ValueError(f"not a file name: {row['stem']!r}")
            final = f"{row['stem']}.json"
            if (Path(self.folder) / final).exists():
                continue  # written before: never touched again
            own = f"{self.run}/{uuid.uuid4().hex}"
            with open(Path(self.folder) / own, "w", encoding="utf-8") as f:
                f.write(row["content"] or "null")
                f.flush()
                os.fsync(f.fileno())
            names.append((own, final))
        return _Written(names)

    def commit(self, messages: list[_Written | None]) -> None:
        for own, final in sorted(n for m in messages if m for n in m.names):
            try:
                os.link(Path(self.folder) / own, Path(self.folder) / final)  # whole and at once, or not at all
            except FileExistsError:
                pass  # another writer was first
        self._clear()

    def abort(self, messages: list[_Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        """The temporary files of this run, of failed attempts too; tasks that still run can make no more."""
        own = Path(self.folder) / self.run
        gone = own.with_name(f"{own.name}-gone")
        with suppress(FileNotFoundError):
            own.rename(gone)  # at once, so none comes between listing and removal
        shutil.rmtree(gone, ignore_errors=True)


class WriteOnce(DataSource):
    """Format ``write_once``: rows (stem, content) as ``<path>/<stem>.json``; mode append.

    A file that is there stays as it is.  A file appears whole or not at all,
    and none appears before every task of the job has succeeded.  ``path`` is a
    folder that all executors and the driver share, on a file system with hard
    links.
    """

    @classmethod
    def name(cls) -> str:
        return "write_once"

    def schema(self) -> str:
        return "stem string, content string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("write_once never overwrites: use mode append")
        return _Writer(self.options["path"])


def stem_clashes(rows: DataFrame, path: str = "path") -> DataFrame:
    """stem, n and paths: the stems that several paths share, as each can have one file only."""
    own = rows.where(F.col(path).isNotNull()).select(stem(F.col(path)).alias("stem"), F.col(path).alias("path")).distinct()
    return own.groupBy("stem").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("path")).alias("paths")).where("n > 1")


def write_once(rows: DataFrame, folder: str, path: str = "path", content: Column | None = None) -> DataFrame:
    """Write one ``<stem>.json`` for each stem of ``path`` that has none yet; returns the clashes (see :func:`stem_clashes`).

    Of several paths with one stem the least is written.  ``content``: the text
    of a file, by default the row as JSON.
    """
    rows.sparkSession.dataSource.register(WriteOnce)
    os.makedirs(folder, exist_ok=True)
    text = F.to_json(F.struct(*rows.columns)) if content is None else content
    each = rows.where(F.col(path).isNotNull()).select(stem(F.col(path)).alias("stem"), F.struct(F.col(path).alias("path"), text.alias("content")).alias("own"))
    each.groupBy("stem").agg(F.min("own").alias("own")).select("stem", F.col("own.content").alias("content")).write.format("write_once").mode("append").save(folder)
    return stem_clashes(rows, path)
