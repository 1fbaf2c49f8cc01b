"""Reports and caches as files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_lines(lines: DataFrame, path: str, *order: str, column: str = "line") -> None:
    """Text files which, read in the order of their names, hold the lines in the order of the columns."""
    lines.orderBy(*order).select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def append_entry(rows: DataFrame, path: str) -> None:
    """Append a session's rows to a memory; operators.intervals.latest reads the last one."""
    rows.write.mode("append").parquet(path)


def write_new(rows: DataFrame, path: str, key: str) -> None:
    """Append the rows whose key is not yet in the table at ``path``; what is there is never overwritten."""
    spark = rows.sparkSession
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        rows = rows.join(spark.read.parquet(path).select(key), key, "left_anti")
    rows.dropDuplicates([key]).write.mode("append").parquet(path)
