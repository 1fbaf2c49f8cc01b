"""Tables in the folder that driver and executors share.

Several operators cut their lineage by writing an intermediate table.  It goes
under ``spark.checkpoint.dir``, read from the session, so any executor can read
any part and a lost executor costs nothing but the tasks it was running.  Where
the setting is missing, a session of a local master (as in tests) gets a folder
of its own, and any other session an error.

A result may read such a table until it has been written, so tables stay until
the process ends; inside ``with scratch():`` they go when the block is left, by
which time its results must have been written.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: What is to be done at the end: of the process, then of each open block of scratch().
_ends: list[list[Callable[[], None]]] = [[]]


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        master = spark.conf.get("spark.master", "local")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        place = tempfile.mkdtemp(prefix="spanloom-")
        spark.conf.set("spark.checkpoint.dir", place)
    return place.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def at_end(action: Callable[[], None], keep: bool = False) -> None:
    """Have ``action`` run when the block of :func:`scratch` is left, or (``keep``) the one around it, or the process ends."""
    _ends[max(0, len(_ends) - 2) if keep else -1].append(action)


def _run(actions: list[Callable[[], None]]) -> None:
    while actions:
        action = actions.pop()
        try:
            action()
        except Exception:  # the session is gone; the folder's owner cleans up
            continue


@contextmanager
def scratch() -> Iterator[None]:
    """Deletes, at its end, the tables and variables that were made inside."""
    _ends.append([])
    try:
        yield
    finally:
        _run(_ends.pop())


atexit.register(_run, _ends[0])


def stored(df: DataFrame, what: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; ``keep``: see :func:`at_end`."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/spanloom/{what}-{uuid.uuid4().hex}"

    def drop() -> None:
        _delete(spark, path)

    at_end(drop, keep)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._spanloom_drop = drop
    return out


def discard(df: DataFrame | None) -> None:
    """Delete a table of :func:`stored` that nothing reads any more."""
    drop = getattr(df, "_spanloom_drop", None)
    for actions in _ends:
        if drop in actions:
            actions.remove(drop)
            drop()


@contextmanager
def small_batches(spark: SparkSession, size: int = 4 << 20) -> Iterator[None]:
    """Has what is written inside go to Python in batches of about ``size`` bytes, which are held on either side."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)
