"""Approximate nearest neighbours with a hierarchical k-means tree.

The tree is grown in numpy on a bounded sample; every vector is then dealt to
the leaf that greedy descent leads to.  A query walks the tree best bin first:
a priority queue holds the nodes passed by, ordered by the distance of their
centres, and the nearest is opened next, until enough leaves are visited.  How
many are enough is calibrated: some queries are answered by brute force, and
the number of visits widens until the leaves visited hold the wanted share of
their true neighbours.

Equal rows are one before anything else.  Leaves with many vectors or many
visiting queries are cut into blocks by id and vector, so neither a vector that
many ids share nor an id with many vectors makes a large task.
Distances are exact, in double precision, on the original vectors.

Defined cases: vectors that are null, zero, of another length than most, or
that hold a null or non-finite component take no part, nor do rows without an
id; rows that repeat an id count once; with fewer candidates than ``k`` all are
returned; ties go to the smaller id; empty tables give no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sampling import first_by_hash
from .shared import stored

FOUND = "query_id long, vec_id long, score double"


@dataclass(frozen=True)
class TreeConfig:
    #: The most vectors that the tree is grown on.
    sample: int = 20_000
    branching: int = 32
    #: Sampled vectors in a leaf, at most.
    leaf: int = 32
    iterations: int = 8
    #: Queries answered by brute force to calibrate the number of visits, and the recall wanted of them.
    trials: int = 96
    recall: float = 0.95
    #: Vectors, and queries, of one leaf that one task compares.
    block: int = 16_384
    seed: int = 3


class KMeansTree:
    """``children[n]`` (empty for a leaf), ``centres[n]``, ``leaf_of[n]``."""

    def __init__(self) -> None:
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []
        self.leaf_of: list[int] = []
        self.leaves = 0

    @classmethod
    def grow(cls, vectors: np.ndarray, config: TreeConfig) -> KMeansTree:
        tree, rng = cls(), np.random.default_rng(config.seed)
        todo = [(tree._node(vectors.mean(0) if len(vectors) else np.zeros(1)), vectors)]
        while todo:
            node, own = todo.pop()
            spread = own.max(0) - own.min(0) if len(own) else np.zeros(1)
            groups = _k_means(own, config.branching, config.iterations, rng) if len(own) > config.leaf and spread.any() else []
            if len(groups) < 2:
                tree.leaf_of[node] = tree.leaves
                tree.leaves += 1
                continue
            for group in groups:
                child = tree._node(group.mean(0))
                tree.children[node].append(child)
                todo.append((child, group))
        return tree

    def _node(self, centre: np.ndarray) -> int:
        self.centres.append(centre)
        self.children.append([])
        self.leaf_of.append(-1)
        return len(self.centres) - 1

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector by greedy descent."""
        out, todo = np.zeros(len(vectors), np.int32), [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            below = self.children[node]
            if not below:
                out[rows] = self.leaf_of[node]
                continue
            near = _distances(vectors[rows], np.array([self.centres[c] for c in below])).argmin(1)
            todo += [(c, rows[near == i]) for i, c in enumerate(below) if (near == i).any()]
        return out

    def visits(self, query: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            while self.children[node]:
                below = self.children[node]
                far = ((np.array([self.centres[c] for c in below]) - query) ** 2).sum(1)
                best = int(far.argmin())
                for i, c in enumerate(below):
                    if i != best:
                        heapq.heappush(queue, (float(far[i]), c))
                node = below[best]
            yield self.leaf_of[node]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None, :]


def _k_means(own: np.ndarray, k: int, iterations: int, rng: np.random.Generator) -> list[np.ndarray]:
    centres = own[rng.choice(len(own), min(k, len(own)), replace=False)]
    for _ in range(iterations):
        near = _distances(own, centres).argmin(1)
        centres = np.array([own[near == i].mean(0) for i in np.unique(near)])
    near = _distances(own, centres).argmin(1)
    return [own[near == i] for i in np.unique(near)]


def _nearest(ids: np.ndarray, vectors: np.ndarray, queries: list[int], points: np.ndarray, k: int) -> pa.RecordBatch:
    """The ``k`` nearest ids of a block to each query, itself left out, by the nearest row of each."""
    q, v, s = [], [], []
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    one, first = np.unique(ids, return_index=True)
    for query, point in zip(queries, points, strict=True):
        far = np.sqrt(((vectors - point) ** 2).sum(1))
        far = np.minimum.reduceat(far, first) if len(one) < len(ids) else far
        rows = np.flatnonzero(one != query)
        if len(rows) > k:  # all that could be among the first k, with ties
            rows = rows[far[rows] <= np.partition(far[rows], k - 1)[k - 1]]
        rows = rows[np.lexsort((one[rows], far[rows]))][:k]
        q += [query] * len(rows)
        v.append(one[rows])
        s.append(far[rows])
    return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(np.concatenate(v) if v else [], pa.int64()), pa.array(np.concatenate(s) if s else [], pa.float64())], ["query_id", "vec_id", "score"])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int]:
    """vec_id and embedding (doubles) of the rows that take part, equal ones once, and their dimension."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("embedding")).where("vec_id is not null and embedding is not null")
    rows = rows.where(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0))
    dim = rows.agg(F.mode(F.size("embedding"), True)).first()[0] or 0
    return rows.where(F.size("embedding") == dim).distinct(), dim


def _top(found: DataFrame, k: int) -> DataFrame:
    one = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return one.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 10, config: TreeConfig = TreeConfig()) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for each row where ``is_query`` (over vec_id)."""
    rows, dim = usable(vectors)
    if not dim:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = stored(rows, "ann-rows")
    tree, visits = fit(rows, dim, is_query, k, config)
    return search(rows, dim, is_query, k, tree, visits, config)


def fit(rows: DataFrame, dim: int, is_query: Column, k: int, config: TreeConfig) -> tuple[KMeansTree, int]:
    """The tree of a bounded sample of ``rows`` (see usable), and how many leaves a query must visit."""
    spark = rows.sparkSession
    sample = np.array([r["embedding"] for r in first_by_hash(rows, "vec_id", config.sample).collect()])
    tree = KMeansTree.grow(sample, config)
    del sample

    # calibration: a bounded set of queries against every row, and the leaves that hold the answers
    trials = first_by_hash(rows.where(is_query), "vec_id", config.trials).collect()
    asked, points = [r["vec_id"] for r in trials], np.array([r["embedding"] for r in trials]).reshape(-1, dim)

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, config.block):
                part = batch.slice(at, config.block)
                yield _nearest(part["vec_id"].to_numpy(), _matrix(part["embedding"], dim), asked, points, k)

    truth = _top(rows.mapInArrow(brute, FOUND), k) if asked else None
    true = []
    if asked:  # of an id with several vectors, the one nearest to the query
        at = F.broadcast(spark.createDataFrame(list(zip(asked, points.tolist(), strict=True)), "query_id long, point array<double>"))
        far = F.aggregate(F.zip_with("embedding", "point", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
        true = truth.join(rows, "vec_id").join(at, "query_id").groupBy("query_id", "vec_id").agg(F.min_by("embedding", far).alias("embedding")).collect()
    leaves = tree.assign(np.array([r["embedding"] for r in true]).reshape(-1, dim))
    order = {q: {leaf: i + 1 for i, leaf in enumerate(tree.visits(p))} for q, p in zip(asked, points, strict=True)}
    needed = np.array([order[r["query_id"]][leaf] for r, leaf in zip(true, leaves, strict=True)])
    visits = 1
    while len(needed) and (needed <= visits).mean() < config.recall:
        visits += max(1, visits // 4)
    return tree, min(tree.leaves, visits)


def search(rows: DataFrame, dim: int, is_query: Column, k: int, tree: KMeansTree, visits: int, config: TreeConfig) -> DataFrame:
    """Every row dealt to its leaf, every query to the first ``visits`` leaves of its walk, both compared leaf by leaf."""
    shipped = rows.sparkSession.sparkContext.broadcast(tree)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["embedding"], pa.array(own.assign(_matrix(batch["embedding"], dim)), pa.int32())], ["vec_id", "embedding", "leaf"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                pairs = [(i, leaf) for i, p in enumerate(_matrix(part["embedding"], dim)) for leaf, _ in zip(own.visits(p), range(visits))]  # noqa: B905
                at_row = pa.array([i for i, _ in pairs], pa.int64())
                yield pa.RecordBatch.from_arrays([part["vec_id"].take(at_row), part["embedding"].take(at_row), pa.array([leaf for _, leaf in pairs], pa.int32())], ["query_id", "point", "leaf"])

    index = rows.mapInArrow(deal, "vec_id long, embedding array<double>, leaf int")
    asks = rows.where(is_query).mapInArrow(walk, "query_id long, point array<double>, leaf int")
    cut = lambda n: F.ceil(F.col(n) / config.block).cast("int")
    # one row for each leaf of the tree: bounded by the sample
    sizes = index.groupBy("leaf").agg(F.count("*").alias("n")).join(asks.groupBy("leaf").agg(F.count("*").alias("m")), "leaf")
    sizes = F.broadcast(sizes.select("leaf", cut("n").alias("blocks"), cut("m").alias("lots")))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = index.join(sizes, "leaf").withColumn("block", F.pmod(F.xxhash64("vec_id", "embedding"), F.col("blocks")).cast("int")).withColumn("lot", spread("lots")).select("leaf", "block", "lot", "vec_id", "embedding")
    right = asks.join(sizes, "leaf").withColumn("lot", F.pmod(F.xxhash64("query_id", F.lit(1)), F.col("lots")).cast("int")).withColumn("block", spread("blocks")).select("leaf", "block", "lot", "query_id", "point")

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        if not len(a) or not len(b):
            return pa.Table.from_batches([_nearest(np.empty(0, np.int64), np.empty((0, dim)), [], np.empty((0, dim)), k)])
        found = _nearest(a["vec_id"].to_numpy(), _matrix(a["embedding"], dim), b["query_id"].to_pylist(), _matrix(b["point"], dim), k)
        return pa.Table.from_batches([found])

    by = ("leaf", "block", "lot")
    return _top(left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(compare, FOUND), k)
