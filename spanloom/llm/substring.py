"""Substring dedup with difference-cover anchors.

A window is a run of ``window`` words of one document.  A word is removed when
a window over it also starts earlier: in a smaller doc_id, or before it in the
same document.  Windows are judged on the input.

Hashing every window of a corpus and shuffling the hashes would move several
times the text.  Instead only windows of ``anchor`` words at cover positions
are hashed: positions whose remainder modulo a period lies in a perfect
difference set.  Whatever the two starts of a match, some shift below the
period puts both ends on cover positions, so any match of
``anchor + period - 1 = window`` words shares an anchor.  Only windows around a
repeated anchor are then extended to whole windows and compared.

Documents are dealt to chunks by doc_id, and each step hashes a chunk in one
go.  A chunk sends each hash once, packed by hash range, and gets back a bit
for each; so a passage in a third of all documents costs a chunk one hash, and
the text itself is shuffled once (the exchange is reused by all three steps).

Defined cases: a null or empty text has no words and keeps none; texts shorter
than a window lose nothing; rows with equal doc_id count as one document, in
the order of their texts; a null doc_id comes after all others.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import U, groups, windows, words_of

#: Perfect difference sets by their period: every remainder is a difference of two members.
COVERS = {
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
}
_LAST = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Anchors:
    """The anchors for matches of ``window`` words."""

    window: int
    period: int
    cover: tuple[int, ...]

    @classmethod
    def of(cls, window: int) -> Anchors:
        period = max((p for p in COVERS if 3 * p <= 2 * window), default=0)
        return cls(window, period, COVERS[period]) if period else cls(window, 1, (0,))

    @property
    def length(self) -> int:
        return self.window - self.period + 1


class _Chunk:
    """The words of the documents of one chunk, in the order of doc_id."""

    def __init__(self, table: pa.Table, anchors: Anchors):
        ids = table["doc_id"].to_pylist()
        texts = [t or b"" for t in table["text"].cast(pa.large_binary()).to_pylist()]
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
        self.ids, self.texts = [ids[i] for i in order], [texts[i] for i in order]
        self.rank = np.array([_LAST if i is None else i for i in self.ids], np.int64)
        hashes, counts = [], []
        for a, b in groups(self.texts):
            part = self.texts[a:b]
            got, starts, _ = words_of(b" ".join(part))
            stops = np.cumsum([len(t) + 1 for t in part])
            upto = np.searchsorted(starts, stops)
            hashes.append(got)
            counts.append(np.diff(upto, prepend=0))
        self.words = np.concatenate(hashes) if hashes else np.empty(0, U)
        self.counts = np.concatenate(counts) if counts else np.empty(0, np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        self.doc = np.repeat(np.arange(len(self.ids)), self.counts)
        self.end = self.first[1:][self.doc]
        self.anchors = anchors

    def anchor_hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Position and 48-bit hash of every anchor."""
        a = self.anchors
        at = np.arange(len(self.words) - a.length + 1) if len(self.words) >= a.length else np.empty(0, np.int64)
        covered = np.zeros(a.period, bool)
        covered[list(a.cover)] = True
        at = at[covered[(at - self.first[self.doc[at]]) % a.period] & (at + a.length <= self.end[at])]
        return at, windows(self.words, a.length)[at] >> U(16) if len(at) else np.empty(0, U)

    def candidates(self, at: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold one of the anchors ``at``."""
        a, n = self.anchors, len(self.words)
        step = np.zeros(n + 1, np.int32)
        np.add.at(step, np.maximum(at - a.period + 1, 0), 1)
        np.add.at(step, at + 1, -1)
        return np.flatnonzero((np.cumsum(step[:-1]) > 0) & (np.arange(n) + a.window <= self.end))


def _split(parts: np.ndarray) -> list[tuple[int, int, int]]:
    """(part, start, stop) of each run of a sorted array of parts."""
    starts = np.flatnonzero(np.diff(parts, prepend=-1))
    return list(zip(parts[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(parts)], strict=True)) if len(parts) else []


def _unique_anchors(chunk: _Chunk, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor positions, their place among the distinct hashes, these (by part), how often each occurs."""
    at, hashes = chunk.anchor_hashes()
    distinct, place, count = np.unique(hashes, return_inverse=True, return_counts=True)
    order = np.argsort(distinct % U(parts), kind="stable")
    moved = np.empty(len(order), np.int64)
    moved[order] = np.arange(len(order))
    return at, moved[place], distinct[order], count[order]


def _unique_windows(chunk: _Chunk, bits: dict, parts: int):
    """Candidate windows; the place of each among the distinct ones; these, by part, and the first of each."""
    at, place, distinct, count = _unique_anchors(chunk, parts)
    again = count > 1
    for part, a, b in _split((distinct % U(parts)).astype(np.int64)):
        if (0, part) in bits:
            again[a:b] |= np.unpackbits(np.frombuffer(bits[0, part], np.uint8), count=b - a).astype(bool)
    starts = chunk.candidates(at[again[place]])
    high = windows(chunk.words, chunk.anchors.window)[starts] if len(starts) else np.empty(0, U)
    low = windows(chunk.words, chunk.anchors.window, 1)[starts] >> U(32) if len(starts) else np.empty(0, U)
    part = (high % U(parts)).astype(np.int64)
    order = np.lexsort((low, high, part))  # stable: equal windows stay in the order of document and start
    new = np.ones(len(order), bool)
    new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    return starts, place, order[new], high, low, part


def _bits_of(table: pa.Table) -> dict:
    return {(s, p): b for s, p, b in zip(*(table[c].to_pylist() for c in ("step", "part", "bits")), strict=True)}


def _rows(chunk: int, step: int, got: list[tuple[int, bytes]], name: str) -> pa.Table:
    return pa.table({"chunk": pa.array([chunk] * len(got), pa.int64()), "step": pa.array([step] * len(got), pa.int32()), "part": pa.array([p for p, _ in got], pa.int32()), name: pa.array([b for _, b in got], pa.binary())})


def repeated_words(docs: DataFrame, window: int = 20, chunk_bytes: int | None = None) -> DataFrame:
    """Documents without the words of repeated windows.

    Returns doc_id, n_words, n_removed, removed (array of [start, stop) ranges
    of word numbers) and kept_text (the kept words joined by one space).
    """
    if window < 2:
        raise ValueError("a window has two words at least")
    spark, anchors = docs.sparkSession, Anchors.of(window)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    size = chunk_bytes or min(8 << 20, max(1 << 20, total // 512))
    chunks = max(1, total // size)
    parts = max(4, total // (8 * size))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), chunks // 4)
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.pmod(key, F.lit(chunks)).alias("chunk")).repartition(tasks, "chunk")
    bits_schema = "chunk long, step int, part int, bits binary"

    def send_anchors(table: pa.Table) -> pa.Table:
        _, _, distinct, _ = _unique_anchors(_Chunk(table, anchors), parts)
        raw = distinct.view(np.uint8).reshape(-1, 8)[:, :6]
        return _rows(table["chunk"][0].as_py(), 0, [(p, raw[a:b].tobytes()) for p, a, b in _split((distinct % U(parts)).astype(np.int64))], "sent")

    def find_anchors(table: pa.Table) -> pa.Table:
        sent, chunk = table["sent"].to_pylist(), table["chunk"].to_pylist()
        part = table["part"][0].as_py()
        raw = np.zeros((sum(map(len, sent)) // 6, 8), np.uint8)
        raw[:, :6] = np.frombuffer(b"".join(sent), np.uint8).reshape(-1, 6)
        _, place, count = np.unique(raw.view(U).ravel(), return_inverse=True, return_counts=True)
        again, at, out = count[place] > 1, 0, []
        for c, s in zip(chunk, sent, strict=True):
            mine = again[at : at + len(s) // 6]
            at += len(s) // 6
            if mine.any():
                out.append((c, 0, part, np.packbits(mine).tobytes()))
        return _answers(out)

    def send_windows(table: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = _Chunk(table, anchors)
        starts, _, firsts, high, low, part = _unique_windows(chunk, _bits_of(answers), parts)
        ranks = chunk.rank[chunk.doc[starts[firsts]]] if len(firsts) else np.empty(0, np.int64)
        h, lo = high[firsts], low[firsts].astype(np.uint32)
        got = [(p, h[a:b].tobytes() + lo[a:b].tobytes() + ranks[a:b].tobytes()) for p, a, b in _split(part[firsts])]
        return _rows(table["chunk"][0].as_py() if len(table) else 0, 1, got, "sent")

    def find_windows(table: pa.Table) -> pa.Table:
        sent, chunk = table["sent"].to_pylist(), np.array(table["chunk"].to_pylist())
        part = table["part"][0].as_py()
        n = np.array([len(s) // 20 for s in sent])
        high = np.concatenate([np.frombuffer(s, U, k) for s, k in zip(sent, n, strict=True)])
        low = np.concatenate([np.frombuffer(s, np.uint32, k, 8 * k) for s, k in zip(sent, n, strict=True)])
        rank = np.concatenate([np.frombuffer(s, np.int64, k, 12 * k) for s, k in zip(sent, n, strict=True)])
        order = np.lexsort((np.repeat(chunk, n), rank, low, high))
        first = np.zeros(len(order), bool)
        new = np.ones(len(order), bool)
        new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
        first[order] = new
        ends = np.cumsum(n)
        return _answers([(int(c), 1, part, np.packbits(first[e - k : e]).tobytes()) for c, k, e in zip(chunk, n, ends, strict=True)])

    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        chunk, bits = _Chunk(table, anchors), _bits_of(answers)
        starts, place, firsts, _, _, part = _unique_windows(chunk, bits, parts)
        earliest = np.zeros(len(firsts), bool)
        for p, a, b in _split(part[firsts]):
            earliest[a:b] = np.unpackbits(np.frombuffer(bits[1, p], np.uint8), count=b - a).astype(bool)
        again = np.ones(len(starts), bool)
        again[firsts] = ~earliest
        step = np.zeros(len(chunk.words) + 1, np.int32)
        np.add.at(step, starts[again], 1)
        np.add.at(step, starts[again] + window, -1)
        gone = np.cumsum(step[:-1]) > 0
        removed, ranges, kept = [], [], []
        for k, text in enumerate(chunk.texts):
            mine = gone[chunk.first[k] : chunk.first[k + 1]]
            removed.append(int(mine.sum()))
            words = text.split()
            edges = np.flatnonzero(np.diff(mine.astype(np.int8), prepend=0, append=0)).tolist() if removed[-1] else []
            ranges.append(edges)
            if edges:
                words = [w for a, b in zip([0, *edges[1::2]], [*edges[::2], len(words)], strict=True) for w in words[a:b]]
            kept.append(b" ".join(words))
        pairs = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(r) // 2 for r in ranges]))), pa.int32()), pa.StructArray.from_arrays([pa.array([x for r in ranges for x in r[::2]], pa.int32()), pa.array([x for r in ranges for x in r[1::2]], pa.int32())], ["start", "stop"]))
        return pa.table({"doc_id": pa.array(chunk.ids, pa.int64()), "n_words": pa.array(chunk.counts, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "removed": pairs, "kept_text": pa.array(kept, pa.binary()).cast(pa.string())})

    grouped = base.groupBy("chunk")
    sent = grouped.applyInArrow(send_anchors, "chunk long, step int, part int, sent binary")
    first = sent.groupBy("part").applyInArrow(find_anchors, bits_schema)
    sent = grouped.cogroup(first.groupBy("chunk")).applyInArrow(send_windows, "chunk long, step int, part int, sent binary")
    second = sent.groupBy("part").applyInArrow(find_windows, bits_schema)
    both = first.unionByName(second)
    return grouped.cogroup(both.groupBy("chunk")).applyInArrow(cut, "doc_id long, n_words long, n_removed long, removed array<struct<start:int,stop:int>>, kept_text string")


def _answers(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    kinds = {"chunk": pa.int64(), "step": pa.int32(), "part": pa.int32(), "bits": pa.binary()}
    return pa.table({name: pa.array([r[k] for r in rows], kind) for k, (name, kind) in enumerate(kinds.items())})
