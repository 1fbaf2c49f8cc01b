"""The shared tables in the roles of tokens, ranges, overlays, frames and signals.

Times are whole milliseconds (microseconds for events), so sums are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Width of the buckets of interval joins, in milliseconds.
BUCKET = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Tasks that the words of one split of a table are dealt to.
SPREAD = 32


def dealt(rows: DataFrame, by: str, splits: int) -> DataFrame:
    """``rows`` dealt by ``by`` to as many partitions as the session sets for shuffles, and to ``SPREAD`` for each split that is read at least.

    Texts grow many times when they are parted into words, so what is read tells
    little of a task's memory, and partitions may not be joined by it.  A split
    is of a bounded size, so a task's share is too, however long the table is
    and however few partitions the session sets.
    """
    return rows.repartition(max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), SPREAD * splits), by)


def conversation_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of each conversation, spoken at a fixed pace (with the column turn)."""
    words = F.filter(F.split("text", "[ \t-\r]+"), lambda w: w != "")
    said = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("source"), "turn", F.col("role").alias("speaker"), "text")
    # whole texts are moved, and parted into words where they lie then: what is sent takes less room than the words
    rows = dealt(said, "source", said.rdd.getNumPartitions()).select("source", "turn", "speaker", F.posexplode(words).alias("i", "text"))
    last = F.substring("text", -1, 1)
    rows = rows.withColumn("length", 60 * F.length("text")).withColumn("step", F.col("length") + F.when(last.isin(".", "!", "?"), 600).when(last.isin(",", ";", ":"), 250).otherwise(40))
    order = Window.partitionBy("source").orderBy("turn", "i")
    start = F.coalesce(F.sum("step").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    return rows.select("source", F.row_number().over(order).alias("pos"), F.lit("word").alias("type"), "text", start.alias("start"), (start + F.col("length")).alias("stop"), "speaker", "turn")


def event_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of each user as tokens: errors are spacing, signups audio events."""
    rows = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "error", "spacing").when(F.col("event_type") == "signup", "audio_event").otherwise("word")
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    length = F.round(F.col("value") * 1000).cast("long") * F.when(F.col("event_type") == "error", 1_000_000).otherwise(1000)
    who = F.get_json_object("props", "$.k").cast("int") % 3
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return rows.select(F.col("user_id").alias("source"), F.row_number().over(order).alias("pos"), kind.alias("type"), F.col("event_type").alias("text"), start.alias("start"), (start + length).alias("stop"), F.when(who == 1, "A").when(who == 2, "B").alias("speaker"))


def turns(tokens: DataFrame) -> DataFrame:
    """source, turn, speaker, and where each turn starts and stops."""
    return tokens.groupBy("source", "turn", "speaker").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))


def conversation_ranges(tokens: DataFrame) -> DataFrame:
    """One edit list for each conversation: the assistant's turns, cut in mid-word on purpose."""
    own = turns(tokens).where("speaker = 'assistant'").withColumns({"start": F.col("start") + 137, "stop": F.col("stop") - 211}).where("stop > start")
    number = F.row_number().over(Window.partitionBy("source").orderBy("turn")) - 1
    return own.select(F.col("source").alias("edl_id"), number.alias("ord"), "source", "start", "stop")


def conversation_overlays(tokens: DataFrame) -> DataFrame:
    """An overlay of 1.5 s at each of the user's turns."""
    own = turns(tokens).where("speaker = 'user'")
    return own.select(F.col("source").alias("edl_id"), F.col("turn").alias("z"), "start", F.lit(1500).cast("long").alias("duration"))


def order_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame statistics of each order, from sums of whole numbers."""
    whole = lambda c, by: F.sum(F.round(F.col(c) * by).cast("long"))
    n = F.count("*")
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("clip"))
    return rows.agg((whole("l_quantity", 1) / (50 * n)).alias("y_mean"), (F.lit(0.45) + 4 * whole("l_discount", 100) / (100 * n)).alias("y_range"), (6 * whole("l_tax", 100) / (100 * n)).alias("sat_mean"))
