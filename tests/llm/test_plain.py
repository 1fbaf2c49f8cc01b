"""Learned and drawn results against plain versions of the same rule."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.llm import ann, langid, minhash, mixing, quality, queries, rules, secrets, sharding
from spanloom.llm.sampling import remainder
from spanloom.llm.shared import scratch
from spanloom.llm.vectors import long_subwords, subwords

from . import brute
from .test_secrets import planted

ODD = ["", "\u3000 \x1c", "a a a b", "Ünï\u00a0çødé 漢字 🤷🏽‍♀️ x", "word " * 50 + "end"]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def test_quality_scores_are_the_plain_average(spark, sf_dir, docs):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(remainder("doc_id", 3) != 1).select("doc_id", F.col("quality").alias("label"))
    config = quality.QualityConfig()
    model = quality.QualityModel.fit(quality.labelled_sample(docs, labels, config.rows_per_class), config)
    texts = ODD + [r["text"] for r in docs.where(F.length("text") < 3000).orderBy("doc_id").limit(25).collect()]
    assert np.allclose(model.scores(texts), [brute.quality_score(t, model) for t in texts], atol=1e-6)
    assert model.scores([None])[0] == pytest.approx(1 / (1 + np.exp(-model.bias)))


def test_quality_sample_is_bounded_by_rows_and_subwords(spark):
    docs = spark.createDataFrame([(i % 3, f"text number {i} of {i % 7}") for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 0), (1, 1), (2, 1)], "doc_id long, label int")
    sample = quality.labelled_sample(docs, labels, 1)
    assert sample.count() == 2
    none = quality.QualityModel.fit(sample, quality.QualityConfig(subwords=5))
    assert not none.weights.any() and none.bias == 0.0


def test_languages_are_those_of_the_least_plain_loss(docs):
    model = langid.LanguageModel.fit(langid.language_sample(docs.where(remainder("doc_id", 5) != 0)))
    texts = ODD + [r["text"] for r in docs.where(F.length("text") < 2000).orderBy("doc_id").limit(25).collect()]
    names, score, _ = model.predict(texts)
    want = [brute.language(t, model) for t in texts]
    assert [n for n, _ in want] == names
    assert np.allclose(score, [s for _, s in want], atol=1e-3)


def test_rare_languages_stay_in_the_sample(spark):
    rows = [(i, f"text {i}", f"l{i % 40:02d}") for i in range(4000)] + [(9000 + i, f"rare {i}", "zz") for i in range(3)]
    config = langid.LanguageConfig(rows=2000)
    got = langid.language_sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), config).groupBy("lang").count().collect()
    assert len(got) == 41 and sum(r["count"] for r in got) <= 2000


def test_all_of_many_languages_are_learned(spark):
    """600 languages, one of them a third of all rows and others of three rows: each in the sample, the rare ones whole."""
    rows = [(i, f"text {i}", "hot" if i % 3 == 0 else f"l{i % 500:03d}") for i in range(9000)] + [(20_000 + i, f"rare {i}", f"r{i % 99:02d}") for i in range(297)]
    sample = langid.language_sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), langid.LanguageConfig(rows=3000)).groupBy("lang").count().collect()
    got = {r["lang"]: r["count"] for r in sample}
    assert set(got) == {r[2] for r in rows} and sum(got.values()) == 3000
    assert all(got[f"r{i:02d}"] == 3 for i in range(99)) and max(got.values()) - min(n for k, n in got.items() if k[0] == "l") <= 1


@pytest.mark.parametrize("step", [5, 6, 7, 64, 1000])
def test_long_texts_are_counted_as_wholes(step):
    words = [w for t in ODD for w in t.split(" ")]
    texts = [*ODD, "x", "same same same", "a\tbcd  efg\u2003h" * 9, "abcdefghij" * 30 + " z " + "q" * 64, " " * 70, "\u0130\u03a3 " * 20, " ".join(words * 3)]
    for text in texts:
        want = np.bincount(subwords([text], 12)[0], minlength=1 << 12)
        got = sum(np.bincount(x, minlength=1 << 12) for x in long_subwords(text, 12, step=step))
        assert (got == want).all(), (step, text)
        assert (langid.long_counts(text, 10, (1, 2, 3), step) == langid.ngram_counts([text], 10, (1, 2, 3))[0]).all(), (step, text)


def test_a_text_of_a_million_and_a_half_scores_as_a_whole():
    rng = np.random.default_rng(3)
    text = " ".join(f"w{i}" for i in rng.integers(0, 5000, 150_000)) + "solid" * 200_000 + " end"
    model = quality.QualityModel(rng.normal(size=1 << 14).astype(np.float32), 0.1, 14)
    buckets = subwords([text], 14)[0]
    logit = 0.1 + model.weights[buckets].sum(dtype=np.float64) / len(buckets)
    assert len(text) > 3 << 19 and model.scores(["a b", text, None])[1] == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-9)


def test_rules_verdict_equals_counting(spark, sf_dir, docs):
    good = {r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").collect()}
    want = brute.rule_verdicts([(r["doc_id"], r["text"]) for r in docs.collect()], good, rules.RulesConfig())
    for r in queries.op3_rules(spark, sf_dir).collect():
        score, kept = want[r["doc_id"]]
        assert r["kept"] == kept and (r["score"] is None) == (score is None)
        assert score is None or r["score"] == pytest.approx(score, abs=1e-9)


def test_rules_keep_columns_of_any_name(spark):
    names = ["doc_id", "text", "words", "lines", "keys", "maybe", "exact", "at", "row", "tokens", "buckets", "_words", "mark", "word", "bit", "known"]
    docs = spark.createDataFrame([(1, "a b c d", *names[2:])], ["doc_id", "text", *names[2:]])
    out = rules.judge(docs, docs.select("doc_id")).first()
    assert [out[n] for n in names[2:]] == names[2:] and out["n_words"] == 4


def test_groups_of_equal_texts_stay_whole_unless_heavy(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 500, rng.integers(5, 60))) for _ in range(2000)]
    rows = [(i, t) for i, t in enumerate(texts + [t for t in texts[:60] for _ in range(2)] + [texts[70]] * 900)]
    size = lambda t: len(t.encode()) + 8
    ideal = sum(size(t) for _, t in rows) / 24
    placed = {r["doc_id"]: r for r in sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    shards, weight, load = {}, {}, np.zeros(24)
    for i, t in rows:
        shards.setdefault(t, set()).add(placed[i]["shard"])
        weight[t] = weight.get(t, 0) + size(t)
        load[placed[i]["shard"]] += size(t)
    assert all(len(s) == 1 for t, s in shards.items() if weight[t] <= 0.02 * ideal)
    assert len(shards[texts[70]]) > 1 and abs(load / ideal - 1).max() < 0.06


def test_mixture_follows_its_slots(spark, docs):
    config = mixing.MixConfig(shards=7)
    with scratch():
        mixed = mixing.mix_sources(docs.select("doc_id", "source", "text"), config)
        rows, slots = mixed.documents.collect(), mixed.slots.collect()
    size, taken, target, times = {}, {}, {}, {}
    for r in rows:
        size[r["source"]] = size.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
    order = sorted(size, key=lambda s: (s is None, s or ""))
    for r in slots:
        times.setdefault(r["source_no"], {}).setdefault(r["block"], []).append(r["slot"])
    for no, source in enumerate(order):
        unit = max(1, min(config.block, int(target[source] // config.least)))
        own, blocks = times.get(no, {}), -(-size[source] // unit)
        n = [len(own.get(b, ())) for b in range(blocks)]
        assert sum(n) == min(3 * blocks, round(target[source] * blocks / size[source])) and max(n) - min(n) <= 1
        assert sorted(x for s in own.values() for x in s) == list(range(sum(n)))
        last = size[source] - (blocks - 1) * unit
        assert taken[source] == sum(k * (unit if b < blocks - 1 else last) for b, k in enumerate(n))
    shards = np.bincount([r["shard"] for r in slots], minlength=7)
    assert shards.max() - shards.min() <= 1


def test_many_sources(spark):
    rows = spark.range(120_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("site"), F.pmod(F.xxhash64("id"), F.lit(100_000))).alias("source"), F.expr("repeat('w ', cast(200 + id % 100 as int))").alias("text"))
    with scratch():
        got = mixing.mix_sources(rows).documents.groupBy("source").agg(F.first("source_size").alias("size"), F.first("target").alias("target"), F.sum("taken").alias("taken")).toPandas()
    want = brute.mixing_targets(dict(zip(got["source"], got["size"].tolist(), strict=True)))
    assert np.allclose(got["target"], [want[s] for s in got["source"]])
    assert abs(got["taken"].sum() / got["target"].sum() - 1) < 0.001 and (got["taken"] <= 3 * got["size"]).all()
    assert ((got["taken"] - got["target"]).abs() <= np.maximum(8, 0.02 * got["target"])).all()


def test_secret_spans_are_a_plain_forward_pass(spark, docs):
    some = spark.createDataFrame([(10**9 + i, t) for i, t in planted(np.random.default_rng(6))[0]], "doc_id long, text string")
    docs = docs.select("doc_id", "text").unionByName(some)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    model = secrets.fit(docs)
    print("held back: found", model.found, "flagged", model.flagged)
    assert model.found >= model.config.recall
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in secrets.scan(docs, model, keep=("doc_id",)).collect()}
    for d, text in rows:
        base = secrets.base_spans(text or "")
        spans = secrets.candidates(text or "", base)
        x = np.array([secrets.encoded(text, s, e, model.config) for s, e in spans], np.uint8).reshape(-1, model.config.inside + 2 * model.config.around)
        scores = model._forward(x)[3] if len(x) else []
        sure = {(s, e, "model") for (s, e), p in zip(spans, scores, strict=True) if p >= model.threshold + 1e-3}
        maybe = {(s, e, "model") for (s, e), p in zip(spans, scores, strict=True) if p >= model.threshold - 1e-3}
        assert set(base) | sure <= set(got[d]) <= set(base) | maybe


def test_tree_search_prunes_and_finds(spark, sf_dir):
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 1, (40, 24))
    vectors = centres[rng.integers(0, 40, 4000)] + rng.normal(0, 0.35, (4000, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(5, vectors[i].tolist()) for i in range(100, 150)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    config, ask = ann.TreeConfig(leaf=16, branching=8), F.col("vec_id") % 20 == 0
    with scratch():
        table, dim = ann.usable(df)
        tree, visits = ann.fit(table, dim, ask, 10, config)
        found = ann.search(table, dim, ask, 10, tree, visits, config).collect()
    print("leaves", tree.leaves, "visited", visits)
    assert tree.leaves > 100 and visits < tree.leaves / 2
    hits, n = 0, 0
    for q in range(0, 4000, 20):
        far = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        far[5] = min(far[5], far[100:150].min())
        want = [i for i in np.lexsort((np.arange(4000), far)) if i != q][:10]
        mine = [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q]
        assert len(mine) == len(set(mine)) == 10
        hits, n = hits + len(set(want) & set(mine)), n + 10
    print("recall", hits / n)
    assert hits / n >= 0.9


def test_small_sources_meet_their_targets(spark):
    """300 sources of 100 words: a block of 128 would be all of each."""
    rows = [(i * 4 + k, f"s{i:03}", "word " * 25) for i in range(300) for k in range(4)]
    mixed = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, source string, text string")).documents
    got = {r["source"]: (r["target"], r["taken"]) for r in mixed.groupBy("source").agg(F.first("target").alias("target"), F.sum("taken").alias("taken")).collect()}
    assert {round(t) for t, _ in got.values()} == {50, 100, 150} and all(abs(n - t) <= 1 for t, n in got.values())


def test_equal_rows_are_cut(spark):
    """A third of all rows equal in everything, with a null id."""
    rows = [(None, "the same text for all of these " * 4)] * 1000 + [(i, f"text {i} " * (3 + i % 29)) for i in range(2000)]
    placed = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    load, slots = np.zeros(24), [[] for _ in range(24)]
    for r in placed:
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert len(placed) == 3000 and all(sorted(s) == list(range(len(s))) for s in slots)
    assert abs(load / load.mean() - 1).max() < 0.06


def test_rows_of_one_id_are_one_document(spark):
    a = " ".join(f"w{i}" for i in range(60))
    b = " ".join(f"v{i}" for i in range(60))
    rows = [(3, a), (5, a), (5, b), (9, b + " end"), (7, " ".join(f"u{i}" for i in range(60)))]
    got = [(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == [(3, 3, True), (5, 3, False), (5, 3, False), (7, 7, True), (9, 3, False)]
