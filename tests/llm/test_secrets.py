"""The network of op7_secrets beside the base patterns."""

import string

import numpy as np

from spanloom.llm import secrets

PARTS = "an ber con der el for gen hal in jo ket lin mor nen ot pre qua ren sta ter un ver wi xo yon zel".split()
WORDS = ["".join(np.random.default_rng(i).choice(PARTS, 1 + i % 5)) for i in range(600)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS, n))


def value(rng, size):
    return "".join(rng.choice(list(string.ascii_letters + string.digits), size - 2)) + "Q7"


def planted(rng, size=24):
    """Rows (doc_id, text) of labelled findings, and of values without a keyword, with doc_id -> span."""
    rows, want = [], {}
    for i in range(160):
        text = prose(rng, 30) + " "
        if i % 2:
            rows.append((i, f'{text}token = "{value(rng, size)}" {prose(rng, 20)}'))
        else:
            rows.append((i, f"{text}{value(rng, size)} {prose(rng, 20)}, secret"))
            want[i] = (len(text), len(text) + size)
    return rows, want


def test_threshold_keeps_the_recall_of_positives_like_the_rest():
    rng = np.random.default_rng(5)
    config = secrets.SecretConfig()
    x = rng.integers(1, 90, (800, config.inside + 2 * config.around)).astype(np.uint8)
    y = (np.arange(800) % 2).astype(np.float32)
    model = secrets.CharCNN(config).fit(x, y)
    assert model.found >= config.recall
    assert (model.logits(x[y == 1]) >= model.threshold).mean() > 0.85 and model.threshold < model.logits(x[y == 1]).max()


def test_planted_secrets_without_a_keyword_are_found(spark):
    rows, want = planted(np.random.default_rng(11))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: {(s["start"], s["stop"]) for s in r["spans"] if s["kind"] == "model"} for r in secrets.scan(docs, secrets.fit(docs)).collect()}
    hits, added = sum(want[i] in got[i] for i in want), sum(map(len, got.values()))
    print("found", hits, "of", len(want), "added", added)
    assert hits >= 0.9 * len(want) and hits >= 0.9 * added


def test_tokens_at_the_boundaries_are_candidates():
    import pyarrow as pa

    model = secrets.CharCNN(secrets.SecretConfig())
    model.threshold = -1e9  # every candidate scored is added
    for token in ("abcdeF5ghijk", "abcde5ghijkl", "abcdef5ghijkl", "abcdefg1", "abcdefgh", "12345678", "a/b+c=d-", "x" * 41):
        text = f"é {token} end"
        assert secrets._find(pa.array([text]), model) == [[(2, 2 + len(token), "model")]]
        assert secrets._find(pa.array([f"{text} token"]), model) == [[(2, 2 + len(token), "model")]]
    assert secrets._find(pa.array(["abcdefg", None, ""]), model) == [[], [], []]


def test_rows_are_encoded_as_one_by_one():
    config = secrets.SecretConfig()
    text = "\u2003é𝔘 abcdefgh " + "k" * 39 + "\t" + "m1" * 20 + " " + "n2" * 30 + "/12345678"
    spans = secrets.candidates(text, [])
    at = np.array([(0, len(text), s, e) for s, e in spans])
    want = np.array([secrets.encoded(text, s, e, config) for s, e in spans])
    assert len(spans) == 4 and (secrets.encoded_rows(secrets._codes(text), at, config) == want).all()
    model = secrets.CharCNN(config)
    assert np.allclose(model.logits(want), model._forward(want)[3], atol=1e-4)


def test_numbers_are_not_added(spark):
    """Findings in hexadecimal, values without a keyword, and plain numbers as the shared tables hold them."""
    rng = np.random.default_rng(12)
    rows, want = planted(rng)
    hexes = "".join
    for i in range(160):
        number = hexes(rng.choice(list(string.digits), 16))
        finding = f"key {hexes(rng.choice(list('0123456789abcdef'), 40))} " if i % 2 else ""
        rows.append((1000 + i, f"{prose(rng, 20)} card {number} {finding}{prose(rng, 20)} {prose(rng, 2).upper().replace(' ', '-')}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = secrets.fit(docs)
    got = {r["doc_id"]: {(s["start"], s["stop"]) for s in r["spans"] if s["kind"] == "model"} for r in secrets.scan(docs, model).collect()}
    text = dict(rows)
    added = [text[d][a:b] for d, spans in got.items() for a, b in spans]
    hits = sum(want[i] in got[i] for i in want)
    print("found", hits, "of", len(want), "added", len(added), "digits", sum(x.isdigit() for x in added), model.found)
    assert sum(x.isdigit() for x in added) <= 2 and hits >= 0.7 * len(want) and hits >= 0.9 * len(added) and model.found >= 0.95


def test_too_few_findings_add_nothing():
    rng = np.random.default_rng(6)
    config = secrets.SecretConfig()
    x = rng.integers(1, 90, (200, config.inside + 2 * config.around)).astype(np.uint8)
    y = (np.arange(200) < 40).astype(np.float32)
    assert secrets.CharCNN(config).fit(x, y).threshold == np.inf


def test_every_token_is_learned_from(spark):
    words = [f"word{i:05d}" for i in range(3000)]
    docs = spark.createDataFrame([(i % 7, " ".join(words[i::2]) + f" token = abcdefgh{i}") for i in (0, 1)] + [(None, "without_an_id"), (3, None)], "doc_id long, text string")
    config = secrets.SecretConfig(part=500, positives=2)
    findings = secrets.labelled_findings(docs, config)
    assert {(r["y"], r["inside"]) for r in findings.collect()} == {(0, w) for w in [*words, "without_an_id"]} | {(1, f"abcdefgh{i}") for i in (0, 1)}
    rows = secrets.parts(secrets.coded(findings, config), config).collect()
    kept = [(y, x) for r in rows for y, x, first in zip(np.frombuffer(r["y"], np.int8), np.frombuffer(r["x"], np.uint8).reshape(r["n"], -1), np.frombuffer(r["first"], bool), strict=True) if first]
    assert len(rows) == 6 and len(kept) == 3003 and len({x.tobytes() for _, x in kept}) == 3003 and sum(y for y, _ in kept) == 2
    assert all(np.frombuffer(r["y"], np.int8).any() for r in rows)  # findings are dealt to every part


def test_tokens_of_many_texts_are_those_of_each():
    """Found in one row of codes, and encoded from it, as text by text."""
    import re

    import pyarrow as pa

    config = secrets.SecretConfig(inside=41)
    texts = ["", "\u2003\u00e9\U0001d518 abcdefgh " + "k" * 41 + "\t" + "m1" * 30, "token = abcdefgh1 password: ab\u017f tail_of_it/x", "pa\u017f\u017fword=abcdefgh", "0" * 31 + " " + "0" * 33, "AKIA" + "Z" * 12 + "-and-more", "n" * 8]
    base = [secrets.base_spans(t) for t in texts]
    assert secrets.base_of(pa.array(texts)) == base and secrets.base_of(pa.array([None, ""])) == [[], []]
    whole = secrets.Joined(texts, base, config)
    start, end = whole.tokens()
    at = whole.texts_of(start)
    got = [(i, s, e) for i, s, e in zip(at.tolist(), (start - whole.first[at]).tolist(), (end - whole.first[at]).tolist(), strict=True)]
    want = [(i, s, e) for i, t in enumerate(texts) for s, e in secrets.candidates(t, base[i])]
    assert got == want and (whole.rows(start, end) == np.array([secrets.encoded(texts[i], s, e, config) for i, s, e in want])).all()
    start, end = secrets.Joined(texts, [[]] * len(texts), config).tokens(secrets._IN_RUN, secrets._RUN_LEAST)
    assert (end - start).tolist() == [len(m.group()) for t in texts for m in re.finditer(r"\S{12,}", t)]


def test_context_is_looked_at_only_where_it_can_decide():
    rng = np.random.default_rng(8)
    config = secrets.SecretConfig()
    model = secrets.CharCNN(config)
    x = rng.integers(0, 97, (300, config.inside + 2 * config.around)).astype(np.uint8)
    size = rng.integers(8, config.inside + 1, 300)
    x[:, config.around : config.around + config.inside][np.arange(config.inside) >= size[:, None]] = 98
    z, seen = model.logits(x), []
    assert np.allclose(z, model._forward(x)[3], atol=1e-4)
    for bound in (*np.quantile(z, [0.1, 0.5, 0.99]), 1e9):
        got = model.reach(x[:, config.around : config.around + config.inside], lambda rows: x[rows][seen.append(len(rows)) or slice(None)], float(bound))
        assert (got == (z >= bound)).all()
    assert seen[-1] == 0


def test_a_step_is_that_of_a_plain_network():
    """Logits by pairs of characters, and a step of training, against sums over every window."""
    rng = np.random.default_rng(4)
    config = secrets.SecretConfig(steps=1)
    x = rng.integers(0, 98, (config.sure + config.others, config.inside + 2 * config.around)).astype(np.uint8)
    y = np.repeat([1.0, 0.0], [config.sure, config.others])
    model = secrets.CharCNN(config)
    table, kernel, shift, out = (w.astype(np.float64) for w in (model.table, model.kernel, model.shift, model.out))
    (a, b), w = model._bounds, config.width
    windows = np.array([[table[row[i : i + w]].ravel() for i in range(len(row) - w + 1)] for row in x])
    hidden = windows @ kernel
    sides = [np.arange(a, b), np.concatenate((np.arange(a), np.arange(b, hidden.shape[1])))]
    at = np.concatenate([side[hidden[:, side].argmax(1)] for side in sides], 1)
    two, of = np.concatenate((shift, shift)), np.tile(np.arange(config.filters), 2)
    top = np.maximum(np.take_along_axis(np.concatenate((hidden, hidden), 2), at[:, None], 1)[:, 0] + two, 0)
    logit = top @ out
    assert np.allclose(model.logits(x), logit, atol=1e-5) and np.allclose(model._forward(x)[3], logit, atol=1e-5)
    pairs = secrets._pairs(model._each())
    assert [len(p) for p in pairs] == [secrets._CLASSES**2] * 2 + [secrets._CLASSES]

    error = (1 / (1 + np.exp(-logit)) - y) * np.where(y == 1, 0.5 / config.sure, 0.5 / config.others)
    to_kernel, to_table = np.zeros_like(kernel), np.zeros_like(table)
    back = error[:, None] * out * (top > 0)
    for i, j in zip(*np.nonzero(back), strict=True):
        to_kernel[:, of[j]] += back[i, j] * windows[i, at[i, j]]
        np.add.at(to_table, x[i, at[i, j] : at[i, j] + w], back[i, j] * kernel[:, of[j]].reshape(w, -1))
    rate = 4 * config.rate
    model._descend(x[y == 1], x[y == 0], 0.0, 1.0, rng)
    assert np.allclose(model.kernel, kernel - rate * to_kernel, atol=1e-5) and np.allclose(model.table, table - rate * to_table, atol=1e-5)
    assert np.allclose(model.out, out - rate * error @ top, atol=1e-5) and np.allclose(model.bias, -rate * error.sum(), atol=1e-5)
