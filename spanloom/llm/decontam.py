"""Benchmark decontamination by an FM-index of each training shard.

A window is ``window`` consecutive words of a benchmark item; an item of fewer
words, but not none, is one window.  Every document word inside an occurrence
of a window is hit.

A shard is a slice of some megabytes of an input partition.  Its words get
integer codes from the sorted words of the benchmark; words that no item has
part the text into runs, and runs shorter than the shortest window can hold
none.  The rest is indexed: a suffix array, its Burrows-Wheeler transform in a
wavelet tree, and one suffix position in four.  All windows are searched
backwards at once, their rows are located by stepping to the next kept
position, and the covered words are merged to spans.

Nothing is shuffled: a document's result is made where it is read, so a passage
that a third of all documents share costs each of them its own rows only.  What
is sent to the tasks are the windows of at most ``pass_bytes`` of benchmark
text; a larger benchmark is dealt to several passes, chained over the same
partitions, each adding its spans.

Defined cases: a null or empty text has no words, in documents and items; an
item with a null id hits words but is not listed; several items with one id are
one item; items with the same window are all listed; texts of any length are
searched whole; an empty benchmark hits nothing; an empty table of documents
gives no rows; rows are judged one by one, whatever their ids.  Columns named
as the results are replaced; all others stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .fmindex import FMIndex
from .terms import ALPHANUMERIC, Words
from .vectors import slices

#: What a pass finds for each row.
RESULTS = "n_words long, n_hit long, items array<string>, word_spans array<struct<start:int,stop:int>>, spans array<struct<start:int,stop:int>>"


@dataclass(frozen=True)
class DecontamConfig:
    window: int = 10
    #: The most benchmark text that one pass sends to the tasks.
    pass_bytes: int = 16 << 20
    #: About the bytes and rows of text in a shard.
    shard_bytes: int = 8 << 20
    shard_rows: int = 8192


@dataclass(frozen=True)
class Phrases:
    """``terms``: the sorted words; ``patterns``: the distinct windows by length, as codes from 1; ``items``: the item numbers of each window; ``names``: the items' ids as text."""

    terms: pa.Array
    patterns: list[np.ndarray]
    items: list[list[np.ndarray]]
    names: list[str]

    @classmethod
    def of(cls, rows: list[tuple[str | None, str | None]], window: int) -> Phrases:
        """The windows of items (id as text, text)."""
        words = Words.of(pa.array([t for _, t in rows], pa.string()), ALPHANUMERIC)
        order = pc.array_sort_indices(words.terms).to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(1, len(order) + 1)
        names = sorted({i for i, _ in rows if i is not None})
        number = {name: k for k, name in enumerate(names)}
        found: dict[int, dict[tuple, set]] = {}
        ends = np.cumsum(words.counts)
        for (name, _), n, end in zip(rows, words.counts.tolist(), ends.tolist(), strict=True):
            codes = place[words.codes[end - n : end]].tolist()
            size = min(window, n)
            for k in range(n - size + 1 if n else 0):
                holders = found.setdefault(size, {}).setdefault(tuple(codes[k : k + size]), set())
                if name is not None:
                    holders.add(number[name])
        patterns = [np.array(list(found[size]), np.int64) for size in sorted(found)]
        items = [[np.array(sorted(h), np.int64) for h in found[size].values()] for size in sorted(found)]
        return cls(words.terms.take(pa.array(order)), patterns, items, names)


def _runs(codes: np.ndarray, doc: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The text to index (a 0 after each run) and the word that each of its symbols is (the 0's: -1)."""
    known = codes > 0
    before = np.zeros(len(codes), bool)
    before[1:] = known[:-1] & (doc[1:] == doc[:-1])
    starts = np.flatnonzero(known & ~before)
    after = np.zeros(len(codes), bool)
    after[:-1] = before[1:] & known[1:]
    stops = np.flatnonzero(known & ~after) + 1
    long_ = stops - starts >= least
    starts, stops = starts[long_], stops[long_]
    size = stops - starts + 1
    total = int(size.sum())
    at = np.cumsum(size) - size
    word = np.arange(total) - np.repeat(at, size) + np.repeat(starts, size)
    ends = at + size - 1
    text = codes[np.minimum(word, max(len(codes) - 1, 0))] if total else np.empty(0, np.int64)
    text[ends], word[ends] = 0, -1
    return text, word


def find_phrases(words: Words, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Steps whose running sum tells how many occurrences cover each word, and the distinct pairs (row, item)."""
    n = len(words.codes)
    step = np.zeros(n + 1, np.int64)
    none = np.empty((0, 2), np.int64)
    if not n or not phrases.patterns:
        return step, none
    own = pc.index_in(words.terms, value_set=phrases.terms)
    codes = (pc.fill_null(own, -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1)[words.codes]
    doc = np.repeat(np.arange(len(words.counts)), words.counts)
    text, word = _runs(codes, doc, min(p.shape[1] for p in phrases.patterns))
    if not len(text):
        return step, none
    index = FMIndex(text, len(phrases.terms))
    pairs = []
    for patterns, items in zip(phrases.patterns, phrases.items, strict=True):
        low, high = index.search(patterns)
        hit = np.flatnonzero(low < high)
        times = (high - low)[hit]
        rows = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low[hit], times)
        at = word[index.locate(rows)]
        np.add.at(step, at, 1)
        np.add.at(step, at + patterns.shape[1], -1)
        which = np.repeat(hit, times)
        both = np.unique(doc[at] * len(patterns) + which)
        number = np.array([len(items[w]) for w in (both % len(patterns)).tolist()], np.int64)
        held = [items[w] for w in (both % len(patterns)).tolist()]
        if len(both):
            pairs.append(np.stack([np.repeat(both // len(patterns), number), np.concatenate(held)], 1))
    return step, np.unique(np.concatenate(pairs), axis=0) if pairs else none


def _points(text: bytes, at: np.ndarray) -> np.ndarray:
    """Byte offsets as numbers of code points."""
    raw = np.frombuffer(text, np.uint8)
    begins = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    return begins[at]


def _lists(values: list[list], kind: pa.DataType) -> pa.Array:
    return pa.array(values, pa.list_(kind))


def _pass(names: list[str], shipped, config: DecontamConfig, first: bool):
    span = pa.struct([("start", pa.int32()), ("stop", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = shipped.value
        for batch in batches:
            for part in slices(batch, "text", config.shard_rows, config.shard_bytes):
                words = Words.of(part["text"], ALPHANUMERIC)
                step, pairs = find_phrases(words, phrases)
                ends = np.cumsum(words.counts)
                begins = ends - words.counts
                items: list[list[str]] = [[] for _ in range(part.num_rows)] if first else part["items"].to_pylist()
                for row, item in pairs.tolist():
                    items[row].append(phrases.names[item])
                if not first:  # the word spans of the passes before
                    for row, found in enumerate(part["word_spans"].to_pylist()):
                        for s in found:
                            step[begins[row] + s["start"]] += 1
                            step[begins[row] + s["stop"]] -= 1
                covered = np.cumsum(step[:-1]) > 0
                doc = np.repeat(np.arange(part.num_rows), words.counts)
                number = np.bincount(doc[covered], minlength=part.num_rows)
                word_spans: list[list[dict]] = [[] for _ in range(part.num_rows)]
                spans: list[list[dict]] = [[] for _ in range(part.num_rows)]
                for row in np.flatnonzero(number).tolist():
                    mine = covered[begins[row] : ends[row]]
                    edges = np.flatnonzero(np.diff(mine.astype(np.int8), prepend=0, append=0))
                    word_spans[row] = [{"start": a, "stop": b} for a, b in edges.reshape(-1, 2).tolist()]
                    low, high = words.starts[begins[row] + edges[::2]], words.stops[begins[row] + edges[1::2] - 1]
                    text = part["text"][row].as_py().encode()
                    spans[row] = [{"start": a, "stop": b} for a, b in zip(_points(text, low).tolist(), _points(text, high).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*[part[c] for c in names], pa.array(words.counts, pa.int64()), pa.array(number, pa.int64()), _lists([sorted(set(x)) for x in items], pa.string()), _lists(word_spans, span), _lists(spans, span)],
                    [*names, "n_words", "n_hit", "items", "word_spans", "spans"],
                )

    return run


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, config: DecontamConfig = DecontamConfig(), keep: tuple[str, ...] | None = None) -> DataFrame:
    """``docs`` with n_words, n_hit, items (sorted ids, as text, of the items with an occurring window), word_spans and spans.

    ``spans`` are the stretches of code points from the first to the last of
    words hit in a row, ``word_spans`` the same in numbers of words.
    ``benchmark``: item_id, text.  ``keep``: the columns of ``docs`` to return
    (all by default).
    """
    spark = docs.sparkSession
    results = StructType.fromDDL(RESULTS).names
    kept = [c for c in (docs.columns if keep is None else keep) if c not in results]
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-total // config.pass_bytes))
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text", F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)).alias("pass")).where("text is not null").dropDuplicates(["item_id", "text"])
    # the columns that are kept travel in a struct, so no name of theirs meets one of these
    found = docs.select(F.struct(F.lit(1).alias("_"), *kept).alias("row"), "text")
    for k in range(passes):
        part = sorted(((r["item_id"], r["text"]) for r in rows.where(F.col("pass") == k).collect()), key=lambda x: (x[0] is None, x))
        shipped = spark.sparkContext.broadcast(Phrases.of(part, config.window))
        names = ["row", "text"] if k < passes - 1 else ["row"]
        schema = StructType(found.select(*names).schema.fields + StructType.fromDDL(RESULTS).fields)
        found = found.mapInArrow(_pass(names, shipped, config, k == 0), schema)
    return found.select(*[F.col("row").getField(c).alias(c) for c in kept], *results)
