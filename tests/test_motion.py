"""Matching by parts, dependent values, trails, lagged starts and repair against plain versions."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spanloom.operators import alignment, motion, reactive, repair


def common_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
    return row[-1]


def test_parts_are_a_longest_match(spark):
    rng = random.Random(1)
    draw = lambda: [rng.choice(["a", "b", "c", "+", None]) for _ in range(rng.randrange(8))]
    pairs = [(k, draw(), draw()) for k in range(40)] + [(100, None, ["a"]), (101, ["a"], []), (102, [], []), (103, "A^2 + B^2 = C^2".split(), "A^2 = C^2 - B^2".split())]
    got = {}
    for r in alignment.matched_parts(spark.createDataFrame(pairs, "k int, a array<string>, b array<string>"), "k", "a", "b", {"+": "-"}).collect():
        got.setdefault(r["k"], []).append((r["kind"], r["item"], r["from"], r["to"]))
    for k, a, b in pairs:
        a, b = ["-" if x == "+" else x for x in a or [] if x is not None], [x for x in b or [] if x is not None]
        rows = got.get(k, [])
        matched = sorted((i, j) for kind, _, i, j in rows if kind == "matched")
        assert len(matched) == common_length(a, b) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(matched, matched[1:], strict=False))
        shared = sum((Counter(a) & Counter(b)).values())
        assert Counter(kind for kind, *_ in rows) == Counter({"matched": len(matched), "moved": shared - len(matched), "dropped": len(a) - shared, "added": len(b) - shared}) + Counter()
        assert all((i is None or a[i] == item) and (j is None or b[j] == item) for _, item, i, j in rows)
        assert sorted(i for *_, i, _ in rows if i is not None) == list(range(len(a))) and sorted(j for *_, j in rows if j is not None) == list(range(len(b)))


def test_values_follow_their_needs(spark):
    own = spark.createDataFrame([("x", 5), ("double", 0), ("sum", 1), ("p", 1), ("q", 1), ("behind", 1), ("alone", 9), ("lost", 1)], "name string, own long")
    needs = spark.createDataFrame([("double", "x", 2), ("sum", "double", 1), ("sum", "x", 3), ("p", "q", 1), ("q", "p", 1), ("behind", "p", 1), ("lost", "nowhere", 1), ("alone", None, 1)], "name string, needs string, weight long")
    got = {r["name"]: (r["value"], r["level"], r["cyclic"], r["missing"]) for r in reactive.reactive_values(own, needs).collect()}
    assert {k: got[k][:2] for k in ("x", "double", "sum", "alone")} == {"x": (5, 0), "double": (10, 1), "sum": (26, 2), "alone": (9, 0)}
    assert {k for k, v in got.items() if v[2]} == {"p", "q", "behind"} and got["lost"][0] is None and got["lost"][3]


def test_values_of_many_ways_need_no_rows_for_each(spark):
    """Ladders of 40 steps have 2^40 ways down, beyond any limit of rows; every flag beside them."""
    own = [(f"s{i}", 1) for i in range(41)] + [("a", 1), ("b", 1), ("c", 1), ("d", 1), (None, 3)]
    needs = [(f"s{i}", f"s{i - 1}", 1) for i in range(1, 41) for _ in range(2)] + [("a", "x", 1), ("x", "y", 1), ("y", "x", 1), ("b", "a", 1), ("c", "c", 1), ("c", "d", 1), ("d", "gone", 1)]
    frames = spark.createDataFrame(own, "name string, own long"), spark.createDataFrame(needs, "name string, needs string, weight long")
    got = {r["name"]: (r["value"], r["level"], r["cyclic"], r["missing"]) for r in reactive.reactive_values(*frames).collect()}
    assert all(got[f"s{i}"] == (2 ** (i + 1) - 1, i, False, False) for i in range(41))
    assert got["a"] == got["b"] == got["c"] == (None, None, True, True) and got["d"] == (None, 1, False, True) and got[None] == (None, 0, False, True)


@pytest.mark.parametrize("width", [4, 1000])
def test_trails_and_lagged_starts(spark, width):
    rng = random.Random(width)
    rows = [("hot" if i % 3 else "b", i, rng.randrange(200), rng.randrange(9)) for i in range(150)]
    for r in motion.trails(spark.createDataFrame(rows, "k string, i int, at int, x int").repartition(4), "k", "at", "x", 10, width).collect():
        near = [(at, x) for k, _, at, x in rows if k == r["k"] and r["at"] - 10 <= at <= r["at"]]
        assert (r["n"], r["oldest"], r["total"]) == (len(near), min(a for a, _ in near), sum(x for _, x in near))
    items = [("a", i, rng.randrange(1, 50)) for i in range(30)]
    got = sorted((r["i"], r["begin"], r["end"]) for r in motion.lagged_starts(spark.createDataFrame(items, "k string, i int, n int"), "k", "i", "n", 30, width).collect())
    begin, want = 0, []
    for _, i, n in items:
        want.append((i, begin, begin + n))
        begin += n * 30 // 100
    assert got == want


def test_planted_faults_are_mended_and_the_rest_reported(spark):
    words = spark.createDataFrame([("s", i * 100, i * 100 + 80) for i in range(20)], "source string, start long, stop long")
    lengths = spark.createDataFrame([("s", 2000)], "source string, length long")
    ranges = [("e", 0, "s", -50, 190), ("e", 1, "s", 210, 2500), ("e", 2, "s", 300, 380), ("e", 3, "s", 2200, 2400)]
    overlays = [("e", 0, 0, 100), ("e", 1, 50, 100), ("e", 2, 60, 100), ("e", 3, 5000, 100)]
    done = repair.repair(spark.createDataFrame(ranges, "edl_id string, ord int, source string, start long, stop long"), spark.createDataFrame(overlays, "edl_id string, z int, start long, duration long"), words, lengths, 500)
    first = {(r["part"], r["no"], r["kind"]): r["amount"] for r in done.log.where(F.col("pass") == 1).collect()}
    assert first == {("range", 0, "outside"): 50, ("range", 1, "outside"): 500, ("range", 3, "outside"): 400, ("range", 1, "inside_word"): 1, ("overlay", 1, "covered"): 50, ("overlay", 2, "covered"): 90, ("overlay", 3, "late"): first["overlay", 3, "late"]}
    assert sorted((r["ord"], r["start"], r["stop"]) for r in done.ranges.collect()) == [(0, 0, 190), (1, 200, 2000), (2, 300, 380), (3, 2000, 2000)]
    assert sorted((r["z"], r["start"]) for r in done.overlays.collect()) == [(0, 0), (1, 100), (2, 200), (3, 5000)]
    assert {(r["part"], r["no"], r["kind"]) for r in done.left.collect()} == {("range", 3, "empty"), ("overlay", 3, "late")}
    done.release()


def test_edges_meet_words_by_stretches(spark):
    """An edge far behind the last word's stretch, one at a word's start, one before all, one without a time."""
    words = repair.dealt_words(spark.createDataFrame([("s", 100, 900), ("s", 10, 20)], "source string, start long, stop long"), 50)
    edges = spark.createDataFrame([("s", 500, 1), ("s", 100, 2), ("s", 5, 3), ("s", None, 4), ("s", 901, 5), ("t", 15, 6), ("s", 15, 7)], "source string, at long, n int")
    got = {r["n"]: (r["word_start"], r["word_stop"]) for r in repair.word_at(edges, words).collect()}
    assert got == {1: (100, 900), 7: (10, 20)} | {n: (None, None) for n in (2, 3, 4, 5, 6)}
