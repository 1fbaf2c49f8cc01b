"""False starts: words that are said again at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stretches import running


def _word() -> Column:
    return F.lower(F.regexp_replace("text", "[.,!?;:]+$", ""))


def spoken_words(tokens: DataFrame) -> DataFrame:
    """source, pos, text and word: the words of ``tokens`` that are not blank, in lower case without a mark at the end."""
    return tokens.where("type = 'word'").select("source", "pos", "text", _word().alias("word")).where("word <> ''")


def false_starts(tokens: DataFrame, longest: int = 4, width: int = 4096) -> DataFrame:
    """source, pos, length and said: runs of 1 to ``longest`` words which the same words follow at once.

    From left to right: where several lengths fit the longest counts, and the
    search goes on behind the run, so in "I was I was I was there" the first
    two pairs are false starts.  ``pos`` is that of the run's first word.

    Words are numbered and dealt to stretches of ``width`` that reach a little
    over their ends, so a long source is many tasks; only runs that overlap are
    walked through, one chain of them at a time.
    """
    # only the text moves, and the word is made of it again: so all that is read twice is moved once
    numbered = running(spoken_words(tokens).drop("word"), ["source"], "pos", width, sums={"k": F.lit(1)})
    near = F.sequence(F.floor((F.col("k") - 2 * longest) / width), F.floor((F.col("k") + longest) / width))
    dealt = numbered.withColumn("stretch", F.explode(near)).repartition("source", "stretch").withColumn("word", _word())
    order = Window.partitionBy("source", "stretch").orderBy("k")
    same = [F.coalesce(F.col("word") == F.lead("word", n).over(order), F.lit(False)).cast("int") for n in range(1, longest + 1)]
    rows = dealt.withColumns({f"same{n}": c for n, c in enumerate(same, 1)})
    fits = [F.when(F.sum(f"same{n}").over(order.rowsBetween(0, n - 1)) == n, F.lit(n)) for n in range(1, longest + 1)]
    rows = rows.withColumn("length", F.coalesce(*reversed(fits))).withColumn("ahead", F.collect_list("text").over(order.rowsBetween(0, longest - 1)))
    reach = F.max(F.when(F.col("length").isNotNull(), F.col("k") + F.col("length"))).over(order.rowsBetween(-longest, -1))
    rows = rows.withColumn("fresh", F.coalesce(F.col("k") >= reach, F.lit(True)))
    found = rows.where((F.col("stretch") == F.floor(F.col("k") / width)) & F.col("length").isNotNull())
    # runs that overlap follow the last one that begins afresh
    found = running(found.select("source", "k", "pos", "length", F.array_join(F.slice("ahead", 1, F.col("length")), " ").alias("said"), "fresh"), ["source"], "pos", width, maxima={"chain": F.when(F.col("fresh"), F.col("k"))})
    chains = found.groupBy("source", "chain").agg(F.sort_array(F.collect_list(F.struct("k", "pos", "length", "said"))).alias("runs"))
    none = F.struct(F.lit(0).cast("long").alias("upto"), F.slice("runs", 1, 0).alias("taken"))
    step = lambda acc, run: F.when(run["k"] >= acc["upto"], F.struct((run["k"] + run["length"]).alias("upto"), F.concat(acc["taken"], F.array(run)).alias("taken"))).otherwise(acc)
    taken = chains.select("source", F.explode(F.aggregate("runs", none, step)["taken"]).alias("run"))
    return taken.select("source", "run.pos", "run.length", "run.said")


def slip_counts(tokens: DataFrame, starts: DataFrame, fillers: tuple[str, ...]) -> DataFrame:
    """source, n_words, n_fillers, n_false_starts and n_said_again (words): the pre-scan of a source."""
    words = spoken_words(tokens).groupBy("source").agg(F.count("*").alias("n_words"), F.count_if(F.col("word").isin(*fillers)).alias("n_fillers"))
    again = starts.groupBy("source").agg(F.count("*").alias("n_false_starts"), F.sum("length").alias("n_said_again"))
    return words.join(again, "source", "left").fillna(0, ["n_false_starts", "n_said_again"])
