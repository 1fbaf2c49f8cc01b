"""Source divergence audit: how the word use of the sources of a language differs.

A term is kept in a language if at least ``least`` of its documents hold it.
With N the count of kept terms in a group and V their number, a term's share is
``p = 1 + floor(10^9 (count + 1) / (N + V))``; of two shares
``f = floor((p - q)^2 / q)`` in whole numbers.  Every (lang, source) group is
compared with each other source of its language, by the sum of f over all kept
terms, and with its language as a whole, term by term.

Words become integers by dictionary encoding, twice.  Inside a slice of texts
Arrow's dictionary gives the codes, from which the counts and documents of each
group are tallied.  Over the corpus the kept terms of a language are cut into
chunks of some thousand, in UTF-8 order; within a chunk a term's id is its place
in the sorted array (searchsorted), and a group's counts are one dense vector
(a sum by id).  Ids keep the order of the terms, so ties are broken by them.

Sources are dealt to blocks of about ``block``, so a task holds the vectors of
one block, or compares two, however many sources or terms a language has; sums
over chunks are whole numbers and combined before the shuffle.

Defined cases: a null text, lang or source is an empty string; texts of any
length are read whole; equal rows count each; a language without a kept term
has pairs of value 0 and no terms; an empty table gives no rows; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored
from .terms import LETTERS, Words
from .vectors import slices


@dataclass(frozen=True)
class DivergenceConfig:
    #: Documents of a language that a kept term is in, at least.
    least: int = 3
    #: Ranks of part ``term``.
    ranks: int = 200
    #: About the terms of a chunk and the sources of a block.
    chunk: int = 8192
    block: int = 64


SCALE_STEPS = (1000, 1000, 1000)


def shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """``1 + floor(10^9 (count + 1) / (total + terms))`` by long division, so no product leaves 64 bits."""
    by = total + terms
    rest, out = counts + 1, np.zeros(counts.shape, np.int64)
    for step in SCALE_STEPS:
        rest = rest * step
        out = out * step + rest // by
        rest = rest % by
    return out + 1


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n and docs, and for each group a row with a null term, summed over all of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 16, 16 << 20):
                lang, source = (part[c].dictionary_encode() for c in ("lang", "source"))
                own = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
                pairs, group = np.unique(own, return_inverse=True)
                words = Words.of(part["text"], LETTERS)
                width = max(1, len(words.terms))
                doc = np.repeat(np.arange(part.num_rows), words.counts)
                held, times = np.unique(doc * width + words.codes, return_counts=True)
                cells, at = np.unique(group[held // width] * width + held % width, return_inverse=True)
                n = np.concatenate((np.bincount(at, times, len(cells)).astype(np.int64), np.zeros(len(pairs), np.int64)))
                n_docs = np.concatenate((np.bincount(at, minlength=len(cells)), np.zeros(len(pairs), np.int64)))
                where = pairs[np.concatenate((cells // width, np.arange(len(pairs))))]
                terms = pa.concat_arrays([words.terms.take(pa.array(cells % width)).cast(pa.large_string()), pa.nulls(len(pairs), pa.large_string())]).cast(pa.string())
                names = [d.dictionary.take(pa.array(k)) for d, k in ((lang, where // len(source.dictionary)), (source, where % len(source.dictionary)))]
                yield pa.RecordBatch.from_arrays([*names, terms, pa.array(n), pa.array(n_docs)], ["lang", "source", "term", "n", "docs"])

    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    found = plain.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _ids(ordered: np.ndarray, values: pa.ChunkedArray) -> np.ndarray:
    """The place of each value in a sorted array of byte strings that holds it."""
    coded = values.combine_chunks().cast(pa.binary()).dictionary_encode()
    return np.searchsorted(ordered, np.array(coded.dictionary.to_pylist(), object))[coded.indices.to_numpy()]


def _group_vectors(config: DivergenceConfig):
    """Of a block of sources and a chunk of terms: the shares as one matrix, and each group's first terms."""

    def run(table: pa.Table) -> pa.Table:
        lang, chunk, block = (table[c][0].as_py() for c in ("lang", "chunk", "block"))
        heads = table.filter(pc.equal(table["kind"], 0)).select(["term", "n"])
        terms = np.array(heads["term"].cast(pa.binary()).to_pylist(), object)
        order = np.argsort(terms)
        terms, whole = terms[order], heads["n"].to_numpy()[order]
        marks = table.filter(pc.equal(table["kind"], 1))
        sources, n_group = zip(*sorted(zip(marks["source"].to_pylist(), marks["n"].to_pylist(), strict=True), key=lambda x: x[0].encode()), strict=True)
        n_terms, n_lang = (marks[c][0].as_py() for c in ("n_terms", "n_lang"))
        counted = table.filter(pc.equal(table["kind"], 2))
        row = _ids(np.array([s.encode() for s in sources], object), counted["source"])
        ids = _ids(terms, counted["term"])
        width = len(terms)
        counts = np.zeros(len(sources) * width, np.int64)
        counts[row * width + ids] = counted["n"].to_numpy()  # one row for each cell
        counts = counts.reshape(len(sources), width)
        p = np.stack([shares(c, n, n_terms) for c, n in zip(counts, n_group, strict=True)]) if n_terms else counts
        q = shares(whole, n_lang, n_terms) if n_terms else whole
        first: list[tuple[str, bytes, int]] = []
        for k, source in enumerate(sources):
            at = np.flatnonzero((counts[k] > 0) & (p[k] > q))
            value = (p[k, at] - q[at]) ** 2 // q[at]
            best = np.lexsort((at, -value))[: config.ranks]  # ids are in the order of the terms
            first += [(source, terms[i], v) for i, v in zip(at[best].tolist(), value[best].tolist(), strict=True)]
        panel = p.astype(np.int32).tobytes()
        m = len(first)
        return pa.table(
            {
                "lang": pa.array([lang] * (m + 1), pa.string()),
                "chunk": pa.array([chunk] * (m + 1), pa.int64()),
                "block": pa.array([block] * (m + 1), pa.int32()),
                "source": pa.array([s for s, _, _ in first] + [None], pa.string()),
                "item": pa.array([t for _, t, _ in first] + [None], pa.binary()).cast(pa.string()),
                "value": pa.array([v for _, _, v in first] + [None], pa.int64()),
                "sources": pa.array([None] * m + [list(sources)], pa.list_(pa.string())),
                "shares": pa.array([None] * m + [panel], pa.binary()),
            }
        )

    return run


VECTORS = "lang string, chunk long, block int, source string, item string, value long, sources array<string>, shares binary"


def _compare(table: pa.Table) -> pa.Table:
    """Of two blocks (or one): the sums of f over a chunk, for each source and each other one."""
    lang = table["lang"][0].as_py()
    names = table["sources"].to_pylist()
    sides = [np.frombuffer(x, np.int32).reshape(len(s), -1).astype(np.int64) for s, x in zip(names, table["shares"].to_pylist(), strict=True)]
    rows: list[tuple[str, str, int]] = []
    for a, b in ((0, 0),) if len(sides) == 1 else ((0, 1), (1, 0)):
        for name, p in zip(names[a], sides[a], strict=True):
            value = ((p - sides[b]) ** 2 // np.maximum(sides[b], 1)).sum(1)
            rows += [(name, other, v) for other, v in zip(names[b], value.tolist(), strict=True) if other != name]
    return pa.table({"lang": pa.array([lang] * len(rows), pa.string()), "source": pa.array([r[0] for r in rows], pa.string()), "item": pa.array([r[1] for r in rows], pa.string()), "value": pa.array([r[2] for r in rows], pa.int64())})


def source_divergence(docs: DataFrame, config: DivergenceConfig = DivergenceConfig()) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value and rank of ``docs`` (text, lang, source)."""
    counted = stored(term_counts(docs), "term-counts")
    groups = counted.where("term is null").select("lang", "source")
    kept = counted.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).where(F.col("docs") >= config.least).select("lang", "term", "n")
    kept = stored(kept, "kept-terms")
    chunks = max(1, -(-kept.count() // config.chunk))
    # neighbours in UTF-8 order share a chunk; the bounds are a sample's, the chunks those that were written
    dealt = stored(kept.repartitionByRange(chunks, "lang", "term").withColumn("chunk", F.spark_partition_id().cast("long")), "term-chunks")
    used = counted.where("term is not null").join(dealt.select("lang", "term", "chunk"), ["lang", "term"])
    langs = groups.groupBy("lang").agg(F.ceil(F.count("*") / config.block).cast("int").alias("blocks")).join(kept.groupBy("lang").agg(F.count("*").alias("n_terms"), F.sum("n").alias("n_lang")), "lang", "left").fillna(0, ["n_terms", "n_lang"])
    block = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int").alias("block")
    # a language without kept terms has one chunk, which is empty
    chunked = langs.join(dealt.select("lang", "chunk").distinct(), "lang", "left").select("lang", F.coalesce("chunk", F.lit(-1).cast("long")).alias("chunk"), "n_terms", "n_lang")
    sums = used.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    placed = groups.join(langs.select("lang", "blocks"), "lang").join(sums, ["lang", "source"], "left").select("lang", "source", block, F.coalesce("n", F.lit(0)).alias("n"))

    lack = lambda name, kind: F.lit(None).cast(kind).alias(name)
    filled = placed.select("lang", "block").distinct()  # a hash may leave a block empty
    # kinds of rows: a kept term and its count in the language, a source and its count, a term's count in a source
    head_rows = dealt.join(filled, "lang").select("lang", "chunk", "block", F.lit(0).alias("kind"), lack("source", "string"), "term", "n", lack("n_terms", "long"), lack("n_lang", "long"))
    mark_rows = placed.join(chunked, "lang").select("lang", "chunk", "block", F.lit(1).alias("kind"), "source", lack("term", "string"), "n", "n_terms", "n_lang")
    count_rows = used.join(langs.select("lang", "blocks"), "lang").select("lang", "chunk", block, F.lit(2).alias("kind"), "source", "term", "n", lack("n_terms", "long"), lack("n_lang", "long"))
    vectors = stored(head_rows.unionByName(mark_rows).unionByName(count_rows).groupBy("lang", "chunk", "block").applyInArrow(_group_vectors(config), VECTORS), "term-vectors")

    panels = vectors.where("sources is not null").join(filled.select("lang", F.col("block").alias("with")), "lang")
    panels = panels.select("lang", "chunk", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "sources", "shares")
    pairs = panels.groupBy("lang", "chunk", "i", "j").applyInArrow(_compare, "lang string, source string, item string, value long")
    pairs = pairs.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("part", F.lit("pair"))
    terms = vectors.where("item is not null").select("lang", "source", "item", "value", F.lit("term").alias("part"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    terms = terms.withColumn("rank", rank).where(F.col("rank") <= config.ranks)
    return pairs.withColumn("rank", rank).unionByName(terms).select("lang", "source", "part", "item", "value", "rank")
