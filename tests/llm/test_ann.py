"""Repeated ids in op9_ann."""

import numpy as np
from pyspark.sql import functions as F

from spanloom.llm import ann


def test_a_repeated_id_hides_no_neighbour(spark):
    rows = [(0, [1.0, 1.0])] + [(7, [1.0, 1.01])] * 200 + [(8, [1.0, 1.02 + i / 10_000]) for i in range(200)] + [(100 + i, [1.0, 2.0 + i]) for i in range(30)]
    found = ann.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, 10).orderBy("rank").collect()
    assert [r["vec_id"] for r in found] == [7, 8, *range(100, 108)]
    assert abs(found[1]["score"] - 0.02) < 1e-9


def test_nearest_of_a_block_is_exact():
    rng = np.random.default_rng(2)
    ids, vectors = rng.integers(0, 40, 900), rng.integers(0, 4, (900, 3)).astype(float)
    got = ann._nearest(ids, vectors, [3], vectors[:1], 10).to_pylist()
    far = {}
    for i, d in zip(ids.tolist(), np.sqrt(((vectors - vectors[0]) ** 2).sum(1)).tolist(), strict=True):
        far[i] = min(d, far.get(i, d))
    del far[3]
    assert [(r["score"], r["vec_id"]) for r in got] == sorted((d, i) for i, d in far.items())[:10]
    assert ann._nearest(np.empty(0, np.int64), np.empty((0, 3)), [3], vectors[:1], 10).num_rows == 0
