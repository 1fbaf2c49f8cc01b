"""Language identification by error-correcting output codes.

Each language gets a codeword of +1/-1 bits.  For every bit a binary logistic
classifier over hashed character n-grams is trained in numpy.  Decoding takes
the codeword with the smallest weighted loss, where a bit's weight is its
accuracy on rows held back from training; two codewords of nearly equal loss
flag the text as ambiguous.

Defined cases: a null text, or one without a letter, is ``und`` with score 0
and not ambiguous; with no training rows every text is ``und``; with one
language every text with a letter is that language with score 1; repeated rows
get equal results, and of several texts of a doc_id and language the one that
hashes lowest is learned from.  A long text is counted in parts that overlap by
what an n-gram reaches, so its counts are those of the whole.  An empty table
gives no rows.  Columns named lang_pred, score or ambiguous are replaced; all
others stay.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sampling import one_text
from .vectors import SEGMENT, U, code_points, groups, mix, slices

UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageConfig:
    bits: int = 12
    sizes: tuple[int, ...] = (1, 2, 3)
    #: The most rows in all, and of one language, to learn from.
    rows: int = 6000
    rows_per_language: int = 600
    #: Parts that the ids of a language are dealt to, so that one spoken in most documents is many tasks.
    deals: int = 256
    steps: int = 250
    rate: float = 40.0
    decay: float = 1e-5
    #: The gap of mean loss between the two best codewords below which a text is ambiguous.
    margin: float = 0.02
    seed: int = 11


def codewords(n: int, seed: int = 0) -> np.ndarray:
    """One row of +1/-1 for each of ``n`` classes.

    Up to seven classes get the exhaustive code (every split of the classes);
    more get the best of many random codes by the least distance of two rows.
    """
    if n < 2:
        return np.ones((n, 1))
    if n <= 7:
        splits = [s for s in itertools.product((1.0, -1.0), repeat=n - 1) if -1.0 in s]
        return np.array([[1.0, *s] for s in splits]).T
    width = int(np.ceil(10 * np.log2(n)))
    rng = np.random.default_rng(seed)
    best, most = None, -1.0
    for _ in range(60):
        code = rng.choice([-1.0, 1.0], (n, width))
        apart = (width - code @ code.T) / 2
        np.fill_diagonal(apart, width)
        if apart.min() > most and (np.abs(code.sum(0)) < n).all():
            best, most = code, apart.min()
    return best


def _grams(points: np.ndarray, bits: int, sizes: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray]]:
    """Each size of n-grams, and the bucket of the one that starts at each place."""
    acc = np.zeros(len(points), U)
    for n in range(1, max(sizes) + 1):
        acc = acc[: max(0, len(points) - n + 1)] * U(0x9E3779B97F4A7C15) + points[n - 1 :]
        if n in sizes and len(acc):
            yield n, (mix(acc + U(n)) >> U(64 - bits)).astype(np.int64)


def ngram_counts(texts: list[str], bits: int, sizes: tuple[int, ...]) -> np.ndarray:
    """Counts of hashed character n-grams of each text and three line ends after it, a row for each text."""
    lowered = [t.lower() for t in texts]
    points = code_points("\n\n\n".join([*lowered, ""])).astype(U)
    ends = np.cumsum([len(t) + 3 for t in lowered])
    owner = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))[: len(points)]
    out = np.zeros(len(texts) << bits, np.int64)
    for n, bucket in _grams(points, bits, sizes):
        out += np.bincount((owner[: len(bucket)] << bits) + bucket, minlength=len(out))
        over = (ends[:-1, None] - np.arange(1, n)).ravel()  # grams that reach into the next text
        np.subtract.at(out, (owner[over] << bits) + bucket[over], 1)
    return out.reshape(len(texts), 1 << bits)


def long_counts(text: str, bits: int, sizes: tuple[int, ...], step: int = SEGMENT) -> np.ndarray:
    """The counts of :func:`ngram_counts` for one text, by the n-grams that start in each part of ``step`` characters."""
    whole = text.lower() + "\n\n\n"
    out = np.zeros(1 << bits, np.int64)
    for low in range(0, len(whole), step):
        for _, bucket in _grams(code_points(whole[low : low + step + max(sizes) - 1]).astype(U), bits, sizes):
            out += np.bincount(bucket[:step], minlength=len(out))
    return out


def _features(texts: list, bits: int, sizes: tuple[int, ...]) -> np.ndarray:
    """Square roots of relative frequencies: rows of length one."""
    out = np.zeros((len(texts), 1 << bits), np.float32)
    for i, text in enumerate(texts):
        if text and len(text) > SEGMENT:
            out[i] = long_counts(text, bits, sizes)
    short = [i for i, text in enumerate(texts) if not (text and len(text) > SEGMENT)]
    if short:
        out[short] = ngram_counts([texts[i] or "" for i in short], bits, sizes)
    return np.sqrt(out / np.maximum(out.sum(1, keepdims=True), 1))


def _has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


class LanguageModel:
    def __init__(self, names: list[str], code: np.ndarray, weights: np.ndarray, trust: np.ndarray, config: LanguageConfig):
        self.names, self.code, self.weights, self.trust, self.config = names, code, weights, trust, config

    @classmethod
    def fit(cls, sample: DataFrame, config: LanguageConfig = LanguageConfig()) -> LanguageModel:
        """``sample``: columns text, lang, already bounded (see language_sample)."""
        bits, sizes = config.bits, config.sizes

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(0, batch.num_rows, 64):
                    part = batch.slice(i, 64)
                    rows = _features(part["text"].to_pylist(), bits, sizes).astype("<f2")
                    yield pa.RecordBatch.from_arrays([part["lang"], pa.array([r.tobytes() for r in rows], pa.binary())], ["lang", "x"])

        rows = [r for r in sample.select("lang", "text").mapInArrow(run, "lang string, x binary").collect() if np.frombuffer(r["x"], "<f2").any()]
        rows.sort(key=lambda r: (r["lang"], r["x"]))
        names = sorted({r["lang"] for r in rows})
        code = codewords(len(names), config.seed)
        if len(names) < 2:
            return cls(names, code, np.zeros(((1 << bits) + 1, 1), np.float32), np.ones(1), config)
        x = np.array([np.frombuffer(r["x"], "<f2") for r in rows]).astype(np.float32)
        y = np.array([names.index(r["lang"]) for r in rows])
        del rows
        balance = (1 / np.bincount(y, minlength=len(names)))[y]
        held = np.random.default_rng(config.seed).random(len(y)) < 0.15
        if held.all() or not held.any():
            held[:] = False
        train, target, mass = x[~held], code[y[~held]].astype(np.float32), balance[~held]
        mass = (mass / mass.sum()).astype(np.float32)[:, None]
        weights = np.zeros((x.shape[1] + 1, code.shape[1]), np.float32)
        for step in range(config.steps):
            margin = target * (train @ weights[:-1] + weights[-1])
            pull = mass * target / (1 + np.exp(np.clip(margin, -30, 30)))
            rate = config.rate * (1 - step / config.steps)
            weights[:-1] += rate * (train.T @ pull - config.decay * weights[:-1])
            weights[-1] += rate * 0.1 * pull.sum(0)
        judge = held if held.any() else ~held
        right = (np.sign(x[judge] @ weights[:-1] + weights[-1]) == code[y[judge]]).mean(0)
        return cls(names, code, weights, np.maximum(right - 0.5, 0.01), config)

    def predict(self, texts: list) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score (0 to 1) and whether it is ambiguous, of each text."""
        names, score, unsure = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        if not self.names:
            return names, score, unsure
        trust = self.trust / self.trust.sum()
        for a, b in groups(texts, 1 << 19):
            for at in range(a, b, 128):
                part = texts[at : min(b, at + 128)]
                margin = _features(part, self.config.bits, self.config.sizes) @ self.weights[:-1] + self.weights[-1]
                loss = np.stack([(trust * np.logaddexp(0, -margin * word)).sum(1) for word in self.code], 1)
                order = np.sort(loss, 1)
                chance = np.exp(-8 * (loss - order[:, :1]))
                for i, text in enumerate(part):
                    if _has_letter(text):
                        names[at + i] = self.names[int(loss[i].argmin())]
                        score[at + i] = 1 / chance[i].sum()
                        unsure[at + i] = len(self.names) > 1 and order[i, 1] - order[i, 0] < self.config.margin
        return names, score, unsure


def language_sample(docs: DataFrame, config: LanguageConfig = LanguageConfig()) -> DataFrame:
    """Texts and languages of a bounded sample of ``docs`` (doc_id, text, lang).

    The ids of a language are ranked by their hash, those of the first rank come
    first, then those of the second, until there are ``rows`` of them, and at
    most ``rows_per_language`` of one language.  So all languages are learned
    (unless there are more than ``rows``), in parts as equal as they can be, and
    a rare one keeps its ids.  Each id comes with one text.

    Spark keeps the first ranks of a window before it shuffles; the ids of a
    language are ranked in ``deals`` parts first, so no task meets all of them.
    """
    each = config.rows_per_language
    mark = F.xxhash64("doc_id", F.lit(config.seed))
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "lang").distinct().withColumn("mark", mark)
    first = lambda rows, *by: rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", *by).orderBy("mark", "doc_id"))).where(F.col("rank") <= each)
    dealt = first(known.withColumn("deal", F.pmod("mark", F.lit(config.deals))), "deal")
    ids = first(dealt).orderBy("rank", "mark", "doc_id", "lang").limit(config.rows).select("doc_id", "lang")
    return one_text(docs.select("doc_id", "lang", "text").join(F.broadcast(ids), ["doc_id", "lang"]), "doc_id", "lang").select("text", "lang")


def identify_language(docs: DataFrame, model: LanguageModel, keep: tuple[str, ...] | None = None) -> DataFrame:
    """The columns ``keep`` (all, if not given) with lang_pred, score and ambiguous of ``text``."""
    shipped = docs.sparkSession.sparkContext.broadcast((model.names, model.code, model.weights, model.trust, model.config))
    added = ["lang_pred", "score", "ambiguous"]
    names = [c for c in (docs.columns if keep is None else keep) if c not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = LanguageModel(*shipped.value)
        for batch in batches:
            for part in slices(batch, "text"):
                lang, score, unsure = own.predict(part["text"].to_pylist())
                yield pa.RecordBatch.from_arrays([*[part[c] for c in names], pa.array(lang, pa.string()), pa.array(score), pa.array(unsure)], [*names, *added])

    schema = docs.select(*names).withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0), "ambiguous": F.lit(False)}).schema
    return docs.select(*dict.fromkeys([*names, "text"])).mapInArrow(run, schema)
