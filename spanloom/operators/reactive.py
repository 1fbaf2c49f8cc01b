"""Named values that depend on others, from those that need nothing upwards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reactive_values(own: DataFrame, needs: DataFrame) -> DataFrame:
    """name, value, level, cyclic and missing of each name.

    A value is its own part (``own``: name, own; rows of one name are added) and,
    for each row of ``needs`` (name, needs, weight), the weight times the value
    needed.  ``level`` is the longest way down, so the order of levels is one of
    evaluation.  A name that leads to a cycle (``cyclic``) or to a name that is
    not there (``missing``) has no value.

    Runs a round for each level (and for each step away from a missing name), of
    the names that were settled in the round before, so the work grows with the
    rows of ``needs`` and not with the ways through them.  What a round leaves is
    kept by a local checkpoint.  No limit of recursion holds.
    """
    known = own.groupBy("name").agg(F.sum("own").alias("own"), F.lit(True).alias("known"))
    ways = needs.where("name is not null and needs is not null").select("name", "needs", "weight")
    numbers = ways.groupBy("name").agg(F.count("*").alias("n"))
    # dealt by the name needed once, so that only the names just settled move
    ways = ways.join(numbers, "name").join(known, "name", "left").repartition("needs").persist()
    kind = own.select("own").crossJoin(needs.select("weight")).select(F.sum(F.lit(1).cast("long") * F.col("weight") * F.col("own"))).schema[0].dataType

    news = lambda settled, value, level, missing: [settled.alias("settled"), value.cast(kind).alias("value"), level.cast("int").alias("level"), missing.alias("missing")]
    none, yes, no = F.lit(None), F.lit(True), F.lit(False)
    lowest = known.join(numbers, "name", "left_anti").select("name", *news(yes, F.col("own"), F.lit(0), F.col("name").isNull()))
    absent = ways.select(F.col("needs").alias("name")).distinct().join(known, "name", "left_anti").join(numbers, "name", "left_anti").select("name", *news(yes, none, F.lit(0), yes))
    unknown = ways.where("known is null").select("name").distinct().select("name", *news(no, none, none, yes))
    told = lowest.unionByName(absent).unionByName(unknown).localCheckpoint()
    found, waiting = [told.where("settled")], None
    while not told.isEmpty():
        got = ways.join(told.withColumnRenamed("name", "needs"), "needs").select("name", "n", "own", "known", F.col("settled").cast("long").alias("met"), (F.col("weight") * F.col("value")).cast(kind).alias("value"), (F.col("level") + 1).alias("level"), (F.col("missing") | F.col("known").isNull()).alias("missing"), F.col("known").isNull().alias("told"))
        got = got if waiting is None else got.unionByName(waiting)
        firsts = [F.first(c).alias(c) for c in ("n", "own", "known")]
        met = got.groupBy("name").agg(*firsts, F.sum("met").alias("met"), F.sum("value").cast(kind).alias("value"), F.max("level").alias("level"), F.bool_or("missing").alias("missing"), F.bool_or("told").alias("told")).localCheckpoint()
        whole = F.when(F.col("own").isNull(), F.col("value")).otherwise(F.col("own") + F.coalesce("value", F.lit(0)))
        settled, open_ = met.where("met = n").select("name", *news(yes, whole, F.col("level"), F.col("missing"))), met.where("met < n")
        told = settled.unionByName(open_.where("missing and not told").select("name", *news(no, none, none, yes)))
        found, waiting = [*found, settled], open_.withColumn("told", F.col("missing"))
    ways.unpersist()

    done = found[0]
    for part in found[1:]:
        done = done.unionByName(part)
    if waiting is not None:
        # nothing settles what waits now: it leads to a cycle
        done = done.unionByName(waiting.select("name", *news(no, none, none, F.col("missing"))))
    out = known.alias("k").join(done.alias("d"), F.expr("k.name <=> d.name"), "left")
    cyclic, missing = ~F.coalesce("d.settled", no), F.coalesce("d.missing", no)
    return out.select("k.name", F.when(~(cyclic | missing), F.col("d.value")).alias("value"), F.when(~cyclic, F.col("d.level")).alias("level"), cyclic.alias("cyclic"), missing.alias("missing"))
