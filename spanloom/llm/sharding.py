"""Sharding by a k-d tree over metadata.

A node of the tree splits its rows along the dimension that is widest in it
(as a share of the whole table's extent) at the weighted quantile that gives
each side the bytes of its leaves: the weighted median for an even number of
leaves.  The quantile is found by histograms: each pass is one aggregation
over all nodes of a level and returns a bounded number of bins to the driver,
which narrows down the bin that holds the cut.

Rows are ordered by (dimension, group, tie, copy), so equal values can be cut
too.  The rule on groups of equal texts: a group lies in one shard, unless it
weighs more than ``whole`` (2 %) of an ideal shard and a cut falls inside it;
then it is cut there by the hash of (doc_id, text), and rows that are equal in
both by a number of their own.  So a group that holds a third of
all rows is spread over the shards that its bytes fill, and keeping smaller
groups whole moves no cut by more than half of ``whole`` of a shard.

Everything on the rows is DataFrame operations.

Defined cases: a null text weighs nothing but the constant; an empty table
gives an empty result; rows equal in everything may lie in
different shards, if they are too heavy for one; a null doc_id
is a value like others; with fewer rows than shards some shards are empty;
texts of any length are measured whole and never cut; other columns, whatever
their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored


_LOW, _HIGH = -(2**63), 2**63 - 1


@dataclass
class _Node:
    """A subtree of ``leaves`` shards from ``first``; ``cut`` tells its left rows."""

    first: int
    leaves: int
    weight: int = 0
    dim: str = ""
    cut: list[tuple[str, int | None]] = field(default_factory=list)
    left: _Node | None = None
    right: _Node | None = None
    # while the cut is sought: values fixed so far, the range of the next column, what is still to go left
    low: int = 0
    high: int = 0
    below: int | None = None  # the largest value under that range
    want: float = 0.0
    fixed: list[int] = field(default_factory=list)

    def goes_left(self, keys: list[str]) -> Column:
        out = None
        for name, value in reversed(list(zip([self.dim, *keys], self.cut_values(), strict=False))):
            here = F.lit(False) if value is None else F.col(name) <= value
            out = here if out is None else (F.col(name) < value) | ((F.col(name) == value) & out)
        return out

    def cut_values(self) -> list[int | None]:
        return [v for _, v in self.cut]


def kd_shards(rows: DataFrame, shards: int, weight: str, dims: list[str], keys: list[str], whole: float = 0.02, bins: int = 512) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1); ``dims`` and ``keys`` (the group, then what tells its rows apart) are long columns."""
    every = rows.agg(F.sum(weight).alias("w"), *[f(d).alias(f"{n}_{d}") for d in dims for n, f in (("low", F.min), ("high", F.max))]).first()
    root = _Node(0, shards)
    if every["w"] is None:
        return rows.withColumn("shard", F.lit(0))
    extent = {d: max(1, every[f"high_{d}"] - every[f"low_{d}"]) for d in dims}
    ideal = every["w"] / shards
    level = [root]
    while any(n.leaves > 1 for n in level):
        open_nodes = [n for n in level if n.leaves > 1]
        placed = rows.withColumn("node", _place(root, keys))
        facts = {r["node"]: r for r in placed.groupBy("node").agg(F.sum(weight).alias("w"), *[f(d).alias(f"{k}_{d}") for d in dims for k, f in (("low", F.min), ("high", F.max))]).collect()}
        for n in open_nodes:
            r = facts.get(n.first)
            if r is None:  # no rows: any cut will do
                n.dim, n.cut = dims[0], [(dims[0], None)]
                continue
            n.dim = max(dims, key=lambda d: (r[f"high_{d}"] - r[f"low_{d}"]) / extent[d])
            n.low, n.high, n.want = r[f"low_{n.dim}"], r[f"high_{n.dim}"], r["w"] * (n.leaves // 2) / n.leaves
        _find_cuts(placed, [n for n in open_nodes if not n.cut], weight, keys, ideal, whole, bins)
        for n in open_nodes:
            half = n.leaves // 2
            n.left, n.right = _Node(n.first, half), _Node(n.first + half, n.leaves - half)
        level = [child for n in level for child in ((n.left, n.right) if n.left else (n,))]
    return rows.withColumn("shard", _place(root, keys))


def _place(node: _Node, keys: list[str]) -> Column:
    """The first leaf of the deepest node grown so far that a row lies in."""
    if node.left is None:
        return F.lit(node.first)
    return F.when(node.goes_left(keys), _place(node.left, keys)).otherwise(_place(node.right, keys))


def _find_cuts(placed: DataFrame, nodes: list[_Node], weight: str, keys: list[str], ideal: float, whole: float, bins: int) -> None:
    while nodes:
        value = within = None
        for n in nodes:
            columns = [n.dim, *keys]
            at = len(n.fixed)
            mine = F.col("node") == n.first
            for name, v in zip(columns, n.fixed, strict=False):
                mine &= F.col(name) == v
            mine &= F.col(columns[at]).between(n.low, n.high)
            value = F.when(mine, F.col(columns[at])) if value is None else value.when(mine, F.col(columns[at]))
            share = (F.col(columns[at]).cast("double") - float(n.low)) / float(max(1, n.high - n.low))
            share = F.least(F.floor(share * bins), F.lit(bins - 1))
            within = F.when(mine, share) if within is None else within.when(mine, share)
        found = placed.select("node", weight, value.alias("value"), within.alias("bin")).where("bin is not null")
        found = found.groupBy("node", "bin").agg(F.sum(weight).alias("w"), F.min("value").alias("low"), F.max("value").alias("high")).collect()
        left_over = []
        for n in nodes:
            own = sorted((r["bin"], r["w"], r["low"], r["high"]) for r in found if r["node"] == n.first)
            before, below = 0, n.below
            for _, w, low, high in own:
                if before + w >= n.want:
                    break
                before, below = before + w, high
            columns, at = [n.dim, *keys], len(n.fixed)
            prefix = list(zip(columns, n.fixed, strict=False))
            small = w <= 0.0005 * ideal or (low == high and at >= 1 and (at == len(keys) or w <= whole * ideal))
            if small:
                n.cut = [*prefix, (columns[at], high if n.want - before > w / 2 else below)]
            elif low < high:
                n.low, n.high, n.below, n.want = low, high, below, n.want - before
                left_over.append(n)
            else:
                n.fixed.append(low)
                n.low, n.high, n.below, n.want = _LOW, _HIGH, None, n.want - before
                left_over.append(n)
        nodes = left_over


def with_slots(rows: DataFrame, order: str, bits: int) -> DataFrame:
    """``rows`` with ``slot``: 0, 1, 2 ... within each shard, in the order of the long column ``order``.

    A shard is numbered in ``2**bits`` ranges of ``order``: their counts, one row
    for each shard and range, are summed up, and each range is numbered by itself.
    """
    ranged = rows.withColumn("salt", F.shiftright(order, 64 - bits).cast("int"))
    ahead = Window.partitionBy("shard").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("shard", "salt").count().select("shard", "salt", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("start"))
    number = F.row_number().over(Window.partitionBy("shard", "salt").orderBy(order, "doc_id")) - 1
    # at most shards * 2**bits rows, and bits is bounded by its caller
    return ranged.join(F.broadcast(starts), ["shard", "salt"]).withColumn("slot", F.col("start") + number).drop("salt", "start")


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of each document (doc_id, text).

    The dimensions are functions of the text (bytes, bytes beyond one for each
    character, lines), so equal texts meet the same cuts.
    """
    text = F.coalesce("text", F.lit(""))
    size = F.octet_length(text).cast("long")
    rows = docs.select(
        F.col("doc_id"),
        (size + 8).alias("size"),
        F.crc32(text).alias("text_crc32"),
        size.alias("bytes"),
        (size - F.length(text)).alias("wide"),
        (size - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))).alias("lines"),
        F.xxhash64(text).alias("group"),
        F.xxhash64("doc_id", text).alias("tie"),
        # tells rows apart that are equal in both; the rows are written, so it stays
        F.xxhash64(F.monotonically_increasing_id()).alias("copy"),
    )
    rows = stored(rows, "metadata")
    placed = kd_shards(rows, shards, "size", ["bytes", "wide", "lines"], ["group", "tie", "copy"])
    bits = min(12, max(2, (rows.count() // (shards * 100_000)).bit_length()))
    return with_slots(placed.withColumn("order", F.xxhash64("tie", "copy")), "order", bits).select("doc_id", "size", "text_crc32", "shard", "slot")
