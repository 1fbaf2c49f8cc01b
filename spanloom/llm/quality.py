"""Quality classifier: supervised subword embeddings.

A text is the average of learned vectors of its hashed words and character
n-grams (of one and two words, of three to five characters); a softmax over
the averaged vector gives the class.  The vectors are trained by stochastic
gradient descent in numpy on a bounded sample of labelled rows; every row is
then scored in Arrow batches, whole text by whole text.

Because averaging is linear, scoring needs only each bucket's contribution to
the two logits, so the broadcast model is one number for each bucket.

Defined cases: a null or empty text has no subwords and gets the score of the
bias alone; rows are scored one by one, so repeated rows get equal scores;
labels that are null are not learned from, of several labels of an id the least
holds, and of several texts of an id the one that hashes lowest; with no
labelled rows, or only one class, the model is the bias (0.5, or the one
class).  A long text is counted in parts that carry over what reaches across
their ends, so its score is that of the whole.  An empty table gives no rows.
A column named as the score is replaced; all others stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import first_by_hash, one_text
from .shared import discard, stored
from .vectors import SEGMENT, groups, long_subwords, slices, subwords


@dataclass(frozen=True)
class QualityConfig:
    bits: int = 17
    dim: int = 12
    epochs: int = 4
    rate: float = 0.6
    #: The most labelled rows of each class that are learned from, and the most distinct subwords of all of them.
    rows_per_class: int = 1200
    subwords: int = 20_000_000
    seed: int = 7


def _count_subwords(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts, marks = [], [], []
            for text in batch["text"].to_pylist():
                total = np.zeros(1 << bits, np.int64)
                for got in long_subwords(text, bits) if text and len(text) > SEGMENT else [subwords([text or ""], bits)[0]]:
                    total += np.bincount(got, minlength=1 << bits)
                at = np.flatnonzero(total)
                ids.append(at.astype("<i4").tobytes())
                counts.append(total[at].astype("<f4").tobytes())
                marks.append(int.from_bytes(hashlib.blake2b(ids[-1] + counts[-1], digest_size=8).digest(), "little", signed=True))
            size = [len(x) // 4 for x in ids]
            yield pa.RecordBatch.from_arrays([batch["label"], pa.array(marks, pa.int64()), pa.array(size, pa.int32()), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())], ["label", "mark", "n", "ids", "counts"])

    return run


class QualityModel:
    """``weights[b]``: what bucket b adds to the logit of class 1; ``bias``."""

    def __init__(self, weights: np.ndarray, bias: float, bits: int):
        self.weights, self.bias, self.bits = weights, bias, bits

    @classmethod
    def fit(cls, labelled: DataFrame, config: QualityConfig = QualityConfig()) -> QualityModel:
        """``labelled``: columns text, label (0 or 1), already bounded in rows (see labelled_sample).

        Rows are taken in the order of a hash until they hold ``config.subwords``
        distinct subwords, so very long texts do not fill the driver.
        """
        counted = labelled.select("label", "text").mapInArrow(_count_subwords(config.bits), "label int, mark long, n int, ids binary, counts binary")
        counted = stored(counted, "quality-sample")
        total, last = 0, None
        for r in sorted(counted.select("mark", "n").collect()):
            total += r["n"]
            if total > config.subwords:
                break
            last = r["mark"]
        rows = counted.where(F.col("mark") <= last).select("label", "ids", "counts").collect() if last is not None else []
        discard(counted)
        size = 1 << config.bits
        data = []
        for r in rows:
            counts = np.frombuffer(r["counts"], "<f4")
            if len(counts):
                data.append((r["label"], np.frombuffer(r["ids"], "<i4"), counts / counts.sum()))
        data.sort(key=lambda x: (x[0], len(x[1]), x[1].tobytes()))
        labels = [y for y, _, _ in data]
        if len(set(labels)) < 2:
            return cls(np.zeros(size, np.float32), {0: -9.0, 1: 9.0}[labels[0]] if labels else 0.0, config.bits)
        rng = np.random.default_rng(config.seed)
        vectors = rng.uniform(-1 / config.dim, 1 / config.dim, (size, config.dim)).astype(np.float32)
        out = np.zeros((config.dim, 2), np.float32)
        bias = np.zeros(2, np.float32)
        steps, total = 0, config.epochs * len(data)
        for _ in range(config.epochs):
            for k in rng.permutation(len(data)):
                y, ids, weight = data[k]
                rate = config.rate * (1 - steps / total)
                hidden = weight @ vectors[ids]
                logits = hidden @ out + bias
                p = np.exp(logits - logits.max())
                p /= p.sum()
                p[y] -= 1
                back = out @ p
                out -= rate * np.outer(hidden, p)
                bias -= rate * 0.1 * p
                # each vector's step is scaled up by the text's number of subwords, as if one subword were drawn
                vectors[ids] -= (rate * np.minimum(weight * len(ids), 4.0))[:, None] * back
                steps += 1
        edge = out[:, 1] - out[:, 0]
        return cls((vectors @ edge).astype(np.float32), float(bias[1] - bias[0]), config.bits)

    def scores(self, texts: list) -> np.ndarray:
        total, number = np.zeros(len(texts)), np.zeros(len(texts))
        for a, b in groups(texts):
            part = [t or "" for t in texts[a:b]]
            if len(part) == 1 and len(part[0]) > SEGMENT:
                for got in long_subwords(part[0], self.bits):
                    total[a] += self.weights[got].sum(dtype=np.float64)
                    number[a] += len(got)
                continue
            buckets, owner = subwords(part, self.bits)
            total[a:b] = np.bincount(owner, self.weights[buckets], minlength=len(part))
            number[a:b] = np.bincount(owner, minlength=len(part))
        logit = self.bias + total / np.maximum(number, 1)
        return 1 / (1 + np.exp(-logit))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows_per_class: int) -> DataFrame:
    """Texts and labels (0, 1) of a bounded sample: in each class the ids that hash lowest, each with one text.

    The chosen ids are at most ``2 * rows_per_class`` rows, so they are
    broadcast; only their documents are shuffled.
    """
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
    one = [first_by_hash(known.where(F.col("label") == y), "doc_id", rows_per_class) for y in (0, 1)]
    found = docs.select("doc_id", "text").join(F.broadcast(one[0].unionByName(one[1])), "doc_id")
    return one_text(found, "doc_id", "label").select("text", "label")


def score_quality(docs: DataFrame, model: QualityModel, score: str = "score") -> DataFrame:
    """``docs`` with a column ``score`` between 0 and 1 for ``text``."""
    shipped = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.bits))
    names = [c for c in docs.columns if c not in ("text", score)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = QualityModel(*shipped.value)
        for batch in batches:
            for part in slices(batch, "text", 1024):
                got = pa.array(own.scores(part["text"].to_pylist()), pa.float64())
                yield pa.RecordBatch.from_arrays([*[part[c] for c in names], got], [*names, score])

    kept = docs.select(*names, "text")
    schema = kept.drop("text").withColumn(score, F.lit(0.0)).schema
    return kept.mapInArrow(run, schema)
