"""Source divergence, benchmark decontamination and hard negatives against plain versions."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanloom.llm import decontam, divergence, negatives, queries
from spanloom.llm.fmindex import FMIndex, suffix_array
from tests.compare import rows_of, sql_rows

from . import brute

NEW = ("op11_divergence", "op12_decontam", "op13_negatives")


@pytest.mark.parametrize("name", NEW)
def test_queries_equal_sql(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    assert rows_of(df.columns, df.collect()) == sql_rows(sf_dir, queries.ORACLE_SQL[name])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=30), min_size=1, max_size=8), st.integers(1, 5))
def test_index_counts_and_locates_every_pattern(runs, every):
    text = np.array([x for run in runs for x in [*run, 0]], np.int64)
    ends = np.cumsum(text == 0) - 1
    plain = sorted(range(len(text)), key=lambda i: [(0, ends[j]) if text[j] == 0 else (1, text[j]) for j in range(i, len(text))])
    assert suffix_array(text).tolist() == plain
    index = FMIndex(text, 4, every)  # symbol 4 does not occur
    for size in (1, 2, 3, 5):
        patterns = np.array([[(k // 4**j) % 4 + 1 for j in range(size)] for k in range(min(4**size, 200))], np.int64)
        low, high = index.search(patterns)
        for p, a, b in zip(patterns.tolist(), low, high, strict=True):
            want = [i for i in range(len(text) - size + 1) if text[i : i + size].tolist() == p]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


ITEM = "Alpha beta Gamma delta, epsilon zeta eta theta iota kappa lambda mu"
TEXTS = [
    None,
    "",
    "é ü alpha BETA gamma-delta epsilon zeta eta theta iota kappa and more",
    "no such words",
    f"x {ITEM} y {ITEM} z",
    "short item",
    "a SHORT   item is here: short item",
    "word " * 300_000 + ITEM,
    " ".join(f"w{i}" for i in range(300)) + " 日本語 " + ITEM.upper(),
    ITEM,
    ITEM,
]
ITEMS = [(1, ITEM), (2, "short item"), (3, None), (4, "..."), (5, ITEM + " nu"), (2, "a second text of item two"), (None, "and more"), (10, "Short Item"), (11, "日本語 alpha")]


@pytest.mark.parametrize("pass_bytes", [1 << 20, 40])
def test_decontamination_equals_plain(spark, pass_bytes):
    docs = spark.createDataFrame([(i if i != 3 else None, t, i, "a") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_words int, items string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = decontam.benchmark_hits(docs, items, decontam.DecontamConfig(pass_bytes=pass_bytes, shard_bytes=2000)).collect()
    assert rows[0].asDict().keys() == {"doc_id", "text", "n_words", "n_hit", "items", "word_spans", "spans"} and len(rows) == len(TEXTS)
    for r, (n, hit, found) in zip(rows, brute.leaks([r["text"] for r in rows], ITEMS), strict=True):
        assert (r["n_words"], r["n_hit"], r["items"]) == (n, len(hit), found)
        assert {k for s in r["word_spans"] for k in range(s["start"], s["stop"])} == hit
        for s, w in zip(r["spans"], r["word_spans"], strict=True):
            cut = r["text"][s["start"] : s["stop"]]
            assert brute.leaks([cut], ITEMS)[0][:2] == (w["stop"] - w["start"], set(range(w["stop"] - w["start"])))
    assert decontam.benchmark_hits(docs, items.where("false")).agg(F.sum("n_hit")).first()[0] == 0
    assert decontam.benchmark_hits(docs.where("false"), items).count() == 0


def divergence_rows():
    rng = np.random.default_rng(3)
    words = [*(f"t{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)), "ÄRGER", "ärger", "日本", "Zebra", "zebra", "😀"]
    rows = [(" ".join(rng.choice(words, 12)) + (", e1e2" if i % 3 else ""), "en", f"s{rng.integers(9)}") for i in range(150)]
    rows += [(" ".join(rng.choice(words[:20], 30)), "en", "hot") for _ in range(100)]
    rows += [(None, "en", "empty"), ("only once", "xx", "a"), ("only once", "xx", None), ("...", None, None), ("", None, "b"), ("tie tie", "de", "a"), ("tie", "de", "b"), ("tie", "de", "b"), ("word " * 50_000, "de", "long")]
    return rows


@pytest.mark.parametrize("config", [divergence.DivergenceConfig(), divergence.DivergenceConfig(chunk=20, block=3, ranks=7)])
def test_divergence_equals_plain(spark, config):
    rows = divergence_rows()
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "text string, lang string, source string, term string, n int, part int").repartition(4)
    got = divergence.source_divergence(docs, config)
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute.divergence(rows, ranks=config.ranks))
    assert divergence.source_divergence(docs.where("false"), config).collect() == []


def test_shares_are_exact_beyond_64_bits():
    counts = [0, 1, 5 * 10**11, 9 * 10**12]
    total = sum(counts)
    assert divergence.shares(np.array(counts), total, 4).tolist() == [1 + 10**9 * (c + 1) // (total + 4) for c in counts]


def negative_rows(dims):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(4, dims))
    label = lambda i: 9 if i % 3 == 0 else i % 4  # a third of the rows share one label
    return [(i, label(i), (centre[label(i) % 4] * 0.3 + rng.normal(size=dims) * 0.2).tolist()) for i in range(-40, 400)]


@pytest.mark.parametrize(("dims", "config"), [(7, negatives.NegativesConfig()), (13, negatives.NegativesConfig(anchor_block=2, row_block=37, chunk=5, negatives=4))])
def test_negatives_equal_plain(spark, dims, config):
    rows = negative_rows(dims)
    nan, inf = float("nan"), float("inf")
    odd = [(None, 1, [0.5] * dims), (1000, None, [0.5] * dims), (1010, 1, None), (1020, 1, [nan] * dims), (1030, 1, [inf] * dims), (1040, 1, [None] * dims), (1050, 1, [1e9] * dims)]
    short = [(1060, 1, [0.7, -0.2]), (1070, 77, [0.5] * dims), (1080, 2, [])]  # filled up; alone in its label; nothing
    ties = [(1100 + i, i % 2, [0.25] * dims) for i in range(30)]
    again = [(20, 10**6, [9.0] * dims), rows[0]]  # an id that is taken: the least label stays
    table = spark.createDataFrame([(*r, 0, "x") for r in rows + odd + short + ties + again], "vec_id long, label int, embedding array<double>, block int, low string").repartition(5)
    whole = [(i, g, [int(np.floor(x * 256)) for x in v] + [0] * (dims - len(v))) for i, g, v in rows + short + ties]
    got = negatives.hard_negatives(table, F.col("vec_id") % 10 == 0, config).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute.hard_negatives(whole, lambda i: i % 10 == 0, negatives=config.negatives))
    assert negatives.hard_negatives(table.where("false"), F.col("vec_id") % 10 == 0, config).collect() == []


def test_tiles_of_large_numbers_are_exact():
    rng = np.random.default_rng(5)
    a, b = rng.integers(-(2**25), 2**25, (3, 64)), rng.integers(-(2**25), 2**25, (4, 64))
    tile = negatives._product(a.astype(np.int32), b.astype(np.int32))
    assert tile.tolist() == [[sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for s in b] for r in a]
    for top in (1, 100, 10_000, 10**8, 10**12):
        kind, data = negatives._narrow(np.array([[-top, top]]))
        assert np.frombuffer(data, kind).tolist() == [-top, top]


def test_negatives_equal_plain_over_many_cells(spark):
    rng = np.random.default_rng(6)
    rows = negative_rows(9) + [(1000 + i, i % 3, [0.25] * 9) for i in range(150)]  # many of equal scores
    rows += [(2000 + i, 5 + i % 2, [i / 100.0] * 9) for i in range(150)]  # scores that rise with the id
    rows += [(3000 + i, 20 + i, rng.normal(size=9).tolist()) for i in range(30)]  # labels of one row each
    for size in (1.0, 1e3, 1e5):  # tiles of floats of 32 and 64 bits and of integers
        own = [(i, g, [x * size for x in v]) for i, g, v in rows]
        own = [(i, g, v) for i, g, v in own if max(map(abs, v)) <= 1 << 17]
        whole = [(i, g, [int(np.floor(x * 256)) for x in v]) for i, g, v in own]
        table = spark.createDataFrame(own, "vec_id long, label int, embedding array<double>").repartition(3)
        config = negatives.NegativesConfig(anchor_block=4, row_block=16, chunk=4, anchor_band=3, row_band=4)
        got = negatives.hard_negatives(table, F.col("vec_id") % 10 == 0, config).collect()
        assert sorted(tuple(r) for r in got) == sorted(brute.hard_negatives(whole, lambda i: i % 10 == 0))


@pytest.mark.parametrize("kind", [np.float32, np.float64, np.int64])
def test_best_of_tiles(kind):
    rng = np.random.default_rng(7)
    tiles = [rng.integers(-9, 9, (5, w)) for w in (40, 3, 200, 1, 200)] + [np.full((5, 50), 4)] + [np.arange(k, k + 90) // 6 * np.ones((5, 1), int) for k in range(0, 900, 90)]
    over, high = np.array([-20, -3, 3, 60, 4]), np.array([2000, 5, 3, 120, 4000])
    best, at, seen = negatives._Best(3, over.astype(kind), high.astype(kind)), 0, []
    for tile in tiles:
        best.add(tile.astype(kind), np.arange(at, at + tile.shape[1]) * 2)
        seen += [(r, -int(x), 2 * (at + c)) for r, row in enumerate(tile) for c, x in enumerate(row) if over[r] < x <= high[r]]
        at += tile.shape[1]
    want = [x for r in range(5) for x in sorted(y for y in seen if y[0] == r)[:3]]
    assert [(r, -s, i) for r, i, s in zip(*(x.tolist() for x in best.found()), strict=True)] == want


def test_negatives_move_no_tiles(spark):
    rng = np.random.default_rng(8)
    table = spark.createDataFrame([(i, i % 4, rng.normal(size=8).tolist()) for i in range(8000)], "vec_id long, label int, embedding array<double>").repartition(4)
    moved = lambda: spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    before = moved()
    assert negatives.hard_negatives(table, F.col("vec_id") % 4 == 0).select("anchor_id").distinct().count() == 2000
    assert moved() - before < 8000 * 2000  # a byte for each pair
