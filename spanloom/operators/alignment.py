"""Two sequences matched by parts: what stays, moves, is added or dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _next_row(above: Column, item: Column, right: Column) -> Column:
    """A row of lengths of common subsequences from the one above; both start with a 0."""
    best = lambda row, j: F.greatest(F.element_at(row, -1), F.get(above, j + 1), F.get(above, j) + (F.get(right, j) == item).cast("int"))
    return F.aggregate(F.sequence(F.lit(0), F.size(right) - 1), F.array(F.lit(0)), lambda row, j: F.concat(row, F.array(best(row, j))))


def matched_positions(left: Column, right: Column) -> tuple[Column, Column]:
    """The table of lengths of two arrays (columns), and, over a column ``lengths`` that holds it, the pairs (i, j) of a longest common subsequence.

    The table is a fold over ``left``, one row for each item; the walk back is a
    fold over as many steps as there are items in both.  Neither array may be
    empty or hold nulls.
    """
    first = F.array(F.array_repeat(F.lit(0), F.size(right) + 1))
    table = F.aggregate(left, first, lambda rows, item: F.concat(rows, F.array(_next_row(F.element_at(rows, -1), item, right))))
    none = F.array().cast("array<struct<i:int,j:int>>")
    begin = F.struct(F.size(left).alias("i"), F.size(right).alias("j"), none.alias("pairs"))

    def step(at: Column, _: Column) -> Column:
        i, j = at["i"], at["j"]
        cell = lambda a, b: F.get(F.get(F.col("lengths"), a), b)
        alike = F.get(left, i - 1) == F.get(right, j - 1)
        pair = F.struct((i - 1).alias("i"), (j - 1).alias("j"))
        taken = F.struct((i - 1).alias("i"), (j - 1).alias("j"), F.concat(F.array(pair), at["pairs"]).alias("pairs"))
        up, back = F.struct((i - 1).alias("i"), j.alias("j"), at["pairs"].alias("pairs")), F.struct(i.alias("i"), (j - 1).alias("j"), at["pairs"].alias("pairs"))
        return F.when((i == 0) | (j == 0), at).when(alike, taken).when(cell(i - 1, j) >= cell(i, j - 1), up).otherwise(back)

    walk = F.aggregate(F.sequence(F.lit(1), F.size(left) + F.size(right)), begin, step)["pairs"]
    return table, walk


def matched_parts(pairs: DataFrame, key: str, left: str, right: str, key_map: dict[str, str] | None = None) -> DataFrame:
    """``key``, kind, item, from and to: the parts of two arrays of strings, one pair for each ``key``.

    ``matched`` items are those of a longest common subsequence; of the others
    the n-th of the left and the n-th of the right with one text are ``moved``;
    what then stands alone is ``dropped`` or ``added``.  ``key_map``: items of
    the left that count as others.  Null arrays are empty, null items count for
    nothing.
    """
    plain = lambda c: F.filter(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: x.isNotNull())
    own = plain(left)
    if key_map:
        named = F.create_map(*[F.lit(x) for pair in key_map.items() for x in pair])
        own = F.transform(own, lambda x: F.coalesce(F.try_element_at(named, x), x))
    rows = pairs.select(key, own.alias("a"), plain(right).alias("b"))
    some = (F.size("a") > 0) & (F.size("b") > 0)
    table, walk = matched_positions(F.col("a"), F.col("b"))
    rows = rows.withColumn("lengths", F.when(some, table)).withColumn("pairs", F.coalesce(F.when(some, walk), F.array().cast("array<struct<i:int,j:int>>")))
    # positions without a pair, each with the how-many-th of its text it is among them
    alone = lambda items, place: F.array_except(F.sequence(F.lit(1), F.size(items)), F.transform("pairs", lambda p: p[place] + 1))
    rest = lambda items, place: F.when(F.size(items) > 0, F.transform(alone(items, place), lambda k: F.struct(F.element_at(items, k).alias("item"), (k - 1).alias("at"))))
    rows = rows.select(key, "a", "pairs", rest("a", "i").alias("left_alone"), rest("b", "j").alias("right_alone"))
    nth = lambda items, x, k: F.size(F.filter(F.slice(items, 1, k), lambda y: y["item"] == x["item"]))
    place = lambda matched, item, from_, to, n: F.struct(F.lit(matched).alias("matched"), item.alias("item"), from_.cast("int").alias("from"), to.cast("int").alias("to"), n.alias("nth"))
    none = F.lit(None)
    both = [
        F.transform("pairs", lambda p: place(True, F.get("a", p["i"]), p["i"], p["j"], p["i"])),
        F.transform("left_alone", lambda x, k: place(False, x["item"], x["at"], none, nth(F.col("left_alone"), x, k))),
        F.transform("right_alone", lambda x, k: place(False, x["item"], none, x["at"], nth(F.col("right_alone"), x, k))),
    ]
    each = rows.select(key, F.explode(F.flatten(F.array_compact(F.array(*both)))).alias("part")).select(key, "part.*")
    found = each.groupBy(key, "matched", "item", "nth").agg(F.max("from").alias("from"), F.max("to").alias("to"))
    kind = F.when(F.col("matched"), "matched").when(F.col("to").isNull(), "dropped").when(F.col("from").isNull(), "added").otherwise("moved")
    return found.select(key, kind.alias("kind"), "item", "from", "to")
