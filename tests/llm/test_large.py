"""Texts beyond every segment, hot buckets, and the folders and tables of intermediate data."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spanloom.llm import minhash, queries, shared, vectors
from tests.llm import brute

#: More than 2^20 words, a third of them in repeated windows, in lines; no white space for 2^20 characters; 2^20 words of one kind.
_NUMBERS = np.random.default_rng(1).permutation(900_000)
WORDY = "\n".join(" ".join(f"{x:x}" for x in part) for part in np.array_split(np.concatenate((_NUMBERS, _NUMBERS[:300_000])), 9000))
SOLID = "é" + "abcdefghij" * 150_000 + " end"
SAME = "w " * (2**20 + 10)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, share double, copies int, copy int, row string, maybe boolean"


def rows_of(texts):
    return [(i, t, "en" if i % 2 else "de", f"s{i % 2}", len(t or ""), 1, 0.5, 5, 6, "r", True) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def long_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("long"))
    texts = [WORDY, SOLID, SAME, *(f"plain text number {i} of its kind " * (i % 5 + 1) for i in range(30))]
    spark.createDataFrame(rows_of(texts), SCHEMA).repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(33)], "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    return path


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_long_texts_are_whole_in_every_query(spark, long_dir):
    import public_tokenizers
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{long_dir}/documents.parquet").collect()}
    for name in ("op1_quality", "op4_language", "op5_sharding"):
        assert set(by_id(queries.QUERIES[name](spark, long_dir))) == set(texts)
    judged = by_id(queries.op3_rules(spark, long_dir))
    for i in range(3):
        want = brute.base_rules(texts[i])
        assert {k: judged[i][k] for k in want} == want
    near = by_id(queries.op6_minhash(spark, long_dir))
    assert [near[i]["n_shingles"] for i in range(3)] == [len(brute.shingles(texts[i])) for i in range(3)]
    cut = by_id(queries.op10_substring(spark, long_dir))
    want = brute.substring_kept(list(texts.items()))
    assert {i: (r["n_words"], r["n_removed"], r["kept_sha256"]) for i, r in cut.items()} == want
    found = by_id(queries.op7_secrets(spark, long_dir))
    assert all(found[i]["base_sha256"] == brute.digest_of_spans(brute.secret_spans(texts[i])) for i in texts)
    mixed = by_id(queries.op8_mixing(spark, long_dir))
    assert mixed[2]["size"] == 2**20 + 10
    encoding = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(public_tokenizers.path(queries.RANKS)), special_tokens={})
    coded = by_id(queries.op2_bpe(spark, long_dir))
    for i in (0, 2):
        assert (coded[i]["n_tokens"], coded[i]["ids_sha256"], coded[i]["decoded_sha256"]) == brute.bpe_digests(texts[i], encoding)


def test_pipeline_on_long_texts_and_clashing_columns(spark, long_dir):
    docs = spark.read.parquet(f"{long_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, long_dir)
        assert out.columns == docs.columns, name
        assert {tuple(r) for r in out.select("id", "share", "copies", "copy", "row", "maybe").distinct().collect()} <= {(1, 0.5, 5, 6, "r", True)}
        docs = shared.stored(out, "test")
    coded = corpus_pipeline.tokens(spark, docs, long_dir)
    assert coded.where("not intact").count() == 0 and coded.count() == docs.count()


def test_pipeline_on_empty_tables(spark, long_dir, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{long_dir}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_pipeline_keeps_different_texts_of_one_id(spark):
    words = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    texts = [(7, words(1)), (7, words(2)), (7, words(2)), (None, words(3)), (None, words(3) + " more"), (8, words(4)), (9, words(4) + " more"), (10, words(5))]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    got = [sorted(map(str, (tuple(r)[:2] for r in corpus_pipeline.near_copies(spark, docs.repartition(k), "").collect()))) for k in (1, 5)]
    assert got[0] == got[1] and len(got[0]) == 5
    assert {t for t in got[0]} >= {str((7, words(1))), str((7, words(2))), str((8, words(4))), str((10, words(5)))}


def test_hot_bucket_of_unlike_sets(spark):
    """Sets that share one low shingle meet in many buckets but are not alike, apart from some pairs."""
    rng = np.random.default_rng(0)
    texts = [" ".join(map(str, rng.permutation(12))) for _ in range(200)]
    texts += [t + " x" for t in texts[:20]]
    config = minhash.NearConfig(shingle=1, percent=92, bands=24, rows=1, block=64, block_bytes=1 << 20)
    rows = [(i, f"{t} own{i % 200}a own{i % 200}b") for i, t in enumerate(texts)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), config).collect()}
    assert got == brute.near_components(rows, 1, 92)


def test_signatures_pass_over_no_link():
    rng = np.random.default_rng(4)
    config = minhash.NearConfig()
    factors = tuple(x[: config.signature] for x in minhash._hashes(config))
    for _ in range(300):
        n = int(rng.integers(20, 400))
        one = rng.integers(0, 2**63, n).astype(np.uint64)
        other = np.concatenate((one[int(np.floor(n * 0.075)) :], rng.integers(0, 2**63, int(n * 0.07)).astype(np.uint64)))
        a, b = (minhash.sketch(minhash.minima(np.unique(s), factors)) for s in (one, other))
        if minhash._linked(np.unique(one), np.unique(other), config.percent):
            assert (a == b).sum() >= minhash.least_agreement(config)


def test_no_folder_of_one_machine_on_a_cluster():
    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda name, default=None: {"spark.master": "local-cluster[3,2,3000]"}.get(name, default))

    with pytest.raises(RuntimeError):
        shared.shared_dir(Session)


def test_tables_go_with_their_block(spark):
    import os

    with shared.scratch():
        one = shared.stored(spark.range(5).toDF("a"), "mine")
        kept = shared.stored(spark.range(5).toDF("a"), "kept", keep=True)
        paths = [df.inputFiles()[0].removeprefix("file://") for df in (one, kept)]
        assert all(map(os.path.exists, paths))
    assert [os.path.exists(p) for p in paths] == [False, True]
    shared.discard(kept)
    assert not os.path.exists(paths[1])
    assert spark.range(3).agg(F.sum("id")).first()[0] == 3


def test_near_copies_move_only_rows_that_are_not_alone(spark):
    rng = np.random.default_rng(12)
    texts = [" ".join(map(str, rng.integers(0, 10**6, 3000).tolist())) for _ in range(600)]
    rows = [*enumerate(texts), (600, texts[3]), (601, texts[4] + " and more"), (5, texts[5]), (6, texts[7] + " x y"), (None, texts[8]), (None, "a b c d e f g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    moved = lambda: spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()
    before, setting = moved(), spark.conf.get(key)
    got = corpus_pipeline.near_copies(spark, docs, "").collect()
    assert moved() - before < sum(map(len, texts)) / 5 and spark.conf.get(key) == setting
    # of each group of copies one stays: 3, 4, 5, 7 and 8 have others
    words = sorted(r["text"].split()[0] for r in got)
    assert words == sorted([*[t.split()[0] for k, t in enumerate(texts)], "a"])


def test_slices_give_back_what_earlier_batches_took(monkeypatch):
    calls = []
    pool = type("Pool", (), {"release_unused": lambda self: calls.append(1)})()
    monkeypatch.setattr(vectors.pa, "default_memory_pool", lambda: pool)
    batch = vectors.pa.RecordBatch.from_arrays([vectors.pa.array(["a b", None, "c"])], ["text"])
    assert [p["text"].to_pylist() for p in vectors.slices(batch, "text", rows=2)] == [["a b", None], ["c"]] and calls == [1]
