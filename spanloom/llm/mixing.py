"""Mixing sources to target weights.

The words of each source, document after document, are packed into blocks of a
fixed number of words, smaller ones in small sources, which would miss their
targets by whole blocks otherwise.  How many blocks a source gives is fixed by its target;
how many of them each output shard takes is a multinomial draw from what is
left.  The slots so given to a source are numbered, and a keyed pseudorandom
permutation maps the number of a slot to the index of a block: each pass over
a source takes every block once, in another order than the blocks lie in.
Blocks and slots are then joined by source and index.

Sources are rows of a table at every step, however many there are: they are
numbered in order by ranges, targets are levelled by a few aggregates, and the
multinomial draws go in two steps, first over a fixed number of groups of
sources (one small table on the driver), then within each group in a task.
Positions within a source are summed up in ranges of a hash of doc_id, so a
source that holds a third of all rows is many tasks.

Defined cases: a null or blank text has size 0 and is never taken; a null
source is a source, after all others; a source without words has target 0;
rows that repeat a doc_id are mixed as rows of their own; texts of any length
are only counted, and lie in as many blocks as they need; an empty table gives
an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored
from .vectors import U, mix


@dataclass(frozen=True)
class MixConfig:
    #: Words of a block; fewer in a source of whose target that would be less than ``least`` blocks.
    block: int = 128
    least: int = 100
    #: Output shards.
    shards: int = 64
    #: Slots drawn at a time.
    span: int = 1 << 20
    #: Groups of sources for the first of the two draws.
    groups: int = 256
    #: Weights of the sources in order, repeating, and the most passes over one source.
    weights: tuple[int, ...] = (1, 2, 3)
    passes: int = 3
    seed: int = 17


def n_words(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` (null: 0)."""
    return F.size(F.split(F.concat(F.lit(" "), F.coalesce(text, F.lit("")), F.lit(" ")), "[ \t-\r]+")) - 2


def block_words(target: Column, config: MixConfig) -> Column:
    """Words of a block of a source: the configured number, or so few that a small target is many blocks (1 at least)."""
    return F.greatest(F.lit(1), F.least(F.lit(config.block), F.floor(target / config.least))).cast("long")


def numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``source_no``: 0, 1, 2 ... in the order of (missing, name), counted by ranges."""
    spark = sources.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(sources.repartitionByRange(parts, "missing", "name").withColumn("part", F.spark_partition_id()), "sources")
    sizes = sorted(ranged.groupBy("part").count().collect())
    starts, total = [], 0
    for part, n in sizes:  # one row for each partition
        starts.append((part, total))
        total += n
    inside = F.row_number().over(Window.partitionBy("part").orderBy("missing", "name")) - 1
    known = ranged.join(F.broadcast(spark.createDataFrame(starts, "part int, start long")), "part")
    return known.withColumn("source_no", F.col("start") + inside).drop("part", "start")


def with_targets(sources: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """``sources`` (source_no, size) with ``target``: shares of all sizes by weight.

    None is above ``most`` times its size; the excess is reshared by weight.
    Each turn is one aggregate: the words left to each weight unit are those
    of the sources not at their bound, and as they grow more reach it.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("source_no", F.lit(len(weights))) + 1).cast("int"))
    rows = sources.withColumns({"weight": weight, "bound": most * F.col("size")})
    each, full = 0.0, -1
    while True:
        over = F.lit(each) * F.col("weight") > F.col("bound")
        r = rows.where("size > 0").agg(F.count_if(over).alias("full"), F.sum("size").alias("all"), F.sum(F.when(over, F.col("bound"))).alias("fixed"), F.sum(F.when(~over, F.col("weight"))).alias("units")).first()
        if r["all"] is None or r["units"] is None or r["full"] == full:
            break
        full, each = r["full"], float(r["all"] - (r["fixed"] or 0)) / r["units"]
    return rows.withColumn("target", F.when(F.col("size") == 0, F.lit(0.0)).otherwise(F.least(F.lit(each) * F.col("weight"), F.col("bound").cast("double")))).drop("weight", "bound")


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1: a keyed Feistel network, walked until it lands inside."""
    half = max(1, (int(max(n - 1, 1)).bit_length() + 1) // 2)
    mask = U((1 << half) - 1)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> U(half), x & mask
        for turn in range(4):
            left, right = right, left ^ (mix(right + U((key * 4 + turn) * 0x9E3779B97F4A7C15 % 2**64)) & mask)
        return left << U(half) | right

    out = once(index.astype(U))
    while (far := out >= U(n)).any():
        out[far] = once(out[far])
    return out.astype(np.int64)


def shard_counts(wanted: np.ndarray, shards: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Slots of each source in each shard: a multinomial draw for each shard, from the slots not yet given.

    ``shards``: slots of each shard; their sum is that of ``wanted``.
    """
    left, out = wanted.astype(np.int64).copy(), np.zeros((len(shards), len(wanted)), np.int64)
    for i, size in enumerate(shards[:-1].tolist()):
        while size and left.sum():  # a draw above what a source has left is drawn again
            got = np.minimum(rng.multinomial(size, left / left.sum()), left)
            out[i] += got
            left -= got
            size -= int(got.sum())
    out[-1] = left
    return out


@dataclass
class Mixture:
    """``documents``: each row with its source's figures and words taken; ``slots``: (shard, slot, source_no, block)."""

    documents: DataFrame
    slots: DataFrame


def mix_sources(docs: DataFrame, config: MixConfig = MixConfig()) -> Mixture:
    """Mix ``docs`` (doc_id, source, text): the documents of the result have
    doc_id, source, size, source_size, target and taken."""
    spark = docs.sparkSession
    named = {"name": F.coalesce("source", F.lit("")), "missing": F.col("source").isNull()}
    rows = docs.select("doc_id", "source", n_words(F.col("text")).cast("long").alias("size"))
    rows = stored(rows.withColumns(named | {"place": F.xxhash64("doc_id", F.lit(config.seed))}), "sizes")
    total = rows.agg(F.count("*").alias("rows"), F.sum("size").alias("words")).first()

    # one row for each source: its number, target, blocks and slots
    unit = block_words(F.col("target"), config)
    blocks = F.ceil(F.col("size") / F.col("unit"))
    slots = F.when(F.col("size") > 0, F.least(config.passes * blocks, F.round(F.col("target") * blocks / F.col("size")).cast("long"))).otherwise(0)
    listed = with_targets(numbered(rows.groupBy("missing", "name").agg(F.sum("size").alias("size"))), config.weights, config.passes)
    sources = stored(listed.withColumn("unit", unit).withColumns({"blocks": blocks, "wanted": slots, "grp": F.pmod(F.xxhash64("source_no"), F.lit(config.groups)).cast("int")}), "targets")

    # where each document's words begin within its source
    salts = int(min(1 << 20, max(64, total["rows"] // 50_000)))
    known = rows.withColumn("salt", F.pmod("place", F.lit(salts)).cast("int"))
    earlier = Window.partitionBy("missing", "name").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = known.groupBy("missing", "name", "salt").agg(F.sum("size").alias("n")).select("missing", "name", "salt", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    offsets = offsets.join(sources.select("missing", "name", "source_no", F.col("size").alias("source_size"), "target", "unit"), ["missing", "name"])
    inside = Window.partitionBy("missing", "name", "salt").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    laid = known.join(offsets.hint("merge"), ["missing", "name", "salt"]).withColumn("begin", begin).select("doc_id", "source", "size", "source_no", "source_size", "target", "unit", "begin")

    # how many slots each group of sources has in each shard; at most groups x shards numbers
    grouped = dict(sources.groupBy("grp").agg(F.sum("wanted")).collect())
    groups = sorted(grouped)
    every, shards, seed = sum(grouped.values()), config.shards, config.seed
    per_shard = np.diff(every * np.arange(shards + 1, dtype=object) // shards).astype(np.int64)
    by_group = shard_counts(np.array([grouped[g] for g in groups], np.int64), per_shard, np.random.default_rng(seed))
    mine = {g: by_group[:, i] for i, g in enumerate(groups)}

    def share(table: pa.Table) -> pa.Table:
        """Of one group: the slots of each source in each shard, and the number of the first."""
        g = table["grp"][0].as_py()
        own = table.sort_by("source_no")
        no, n, wanted = (own[c].to_numpy() for c in ("source_no", "blocks", "wanted"))
        counts = shard_counts(wanted, mine[g], np.random.default_rng([seed, g]))
        first = np.cumsum(counts, 0) - counts
        shard, s = np.nonzero(counts)
        return pa.table({"shard": pa.array(shard, pa.int32()), "source_no": pa.array(no[s], pa.int64()), "blocks": pa.array(n[s], pa.int64()), "first": pa.array(first[shard, s], pa.int64()), "slots": pa.array(counts[shard, s], pa.int64())})

    plan = stored(sources.where("wanted > 0").select("grp", "source_no", "blocks", "wanted").groupBy("grp").applyInArrow(share, "shard int, source_no long, blocks long, first long, slots long"), "plan")

    names = ["shard", "slot", "source_no", "block"]

    def ranges_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        for shard, s, n, start, count in zip(*(batch[c].to_pylist() for c in ("shard", "source_no", "blocks", "start", "count")), strict=True):
            for a in range(start, start + count, 1 << 16):
                slot = np.arange(a, min(a + (1 << 16), start + count))
                block = np.empty(len(slot), np.int64)
                for turn in np.unique(slot // n):  # each pass has a key of its own
                    own = slot // n == turn
                    block[own] = permuted(slot[own] % n, n, seed + 31 * s + 1009 * int(turn))
                yield np.full(len(slot), shard, np.int32), slot, np.full(len(slot), s), block

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, rows = [], 0
            for some in ranges_of(batch):
                held.append(some)
                rows += len(some[1])
                if rows >= 1 << 16:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held, strict=True)], names)
                    held, rows = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held, strict=True)], names)

    # a source's slots of a shard are cut into ranges of at most ``span`` slots, so no task draws more than a few of them
    ranges = plan.select(
        "shard", "source_no", "blocks", "slots", "first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(config.span).cast("long"))).alias("at")
    )
    ranges = ranges.select("shard", "source_no", "blocks", (F.col("first") + F.col("at")).alias("start"), F.least(F.lit(config.span), F.col("slots") - F.col("at")).alias("count"))
    tasks = max(shards, every // (4 * config.span))
    slots = ranges.repartition(int(tasks), "shard", "source_no", "start").mapInArrow(draw, "shard int, slot long, source_no long, block long")

    # join by index: the pieces of documents in blocks, and how often each block is taken
    drawn = slots.groupBy("source_no", "block").agg(F.count("*").alias("times"))
    end = F.col("begin") + F.col("size")
    pieces = laid.where("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("begin") / F.col("unit")), F.floor((end - 1) / F.col("unit")))))
    words = F.least(end, (F.col("block") + 1) * F.col("unit")) - F.greatest("begin", F.col("block") * F.col("unit"))
    # as many rows as blocks: without the hint it would be broadcast, its size being taken for that of the plan
    taken = pieces.join(drawn.hint("merge"), ["source_no", "block"], "left").groupBy("source_no", "begin", "doc_id", "source", "size", "source_size", "target").agg(F.sum(words * F.coalesce("times", F.lit(0))).alias("taken"))
    none = laid.where("size = 0").select("doc_id", "source", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
    return Mixture(taken.select(*none.columns).unionByName(none), slots)
