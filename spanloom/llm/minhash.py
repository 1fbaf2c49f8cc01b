"""Near-duplicate documents: MinHash, banding, verification, components.

Each document's set of word shingles gets ``bands * rows`` minima of universal
hashes; documents that agree on all rows of a band share a bucket.  Equal sets
are one class from the start, so copies cost nothing later.  In every bucket
the first class is the leader: the others are compared with it, and the links
found are contracted to components.  Pairs that this leaves open are those of a
bucket whose members lie in different components.  They are compared in blocks
inside tasks, a bucket that is large being cut into blocks of bounded size
whose pairs are tasks of their own; each task returns only links that join what
it has not joined yet.  So no link that is missing could connect two
components, and no step makes the pairs of a group as rows.

A comparison looks at the signatures first: one byte of each of the first
minima.  Where they agree too seldom for the wanted similarity the sets are not
compared; all others are confirmed on full sets.  With the defaults two sets of similarity
0.85 share none of the 32 bands with probability (1 - 0.85^6)^32 = 3e-7, and
their signatures are passed over with probability below 1e-8.

Defined cases: a null or blank text has an empty set, which links with nothing;
with fewer words than a shingle the whole sequence is the one shingle; texts of
any length are hashed whole, in segments; rows that repeat a doc_id with other
texts are one document, linked through any of them; a null doc_id takes no part
in links, has a null component and is kept; an empty table gives no rows; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .sampling import maybe_in
from .shared import discard, stored
from .vectors import U, groups, mix, slices, windows, words_of


@dataclass(frozen=True)
class NearConfig:
    shingle: int = 3
    #: A link: ``100 * intersection >= percent * union``.
    percent: int = 85
    bands: int = 32
    rows: int = 6
    #: Minima in the signature that is compared before the sets.
    signature: int = 64
    #: About the most bytes of sets, and of members, in a block of a large bucket.
    block_bytes: int = 8 << 20
    block: int = 8192
    seed: int = 5


def shingle_sets(texts: list, size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles (A-Z in lower case)."""
    out = []
    for a, b in groups(texts):
        part = [(t or b"").lower() for t in texts[a:b]]  # bytes: only A-Z change
        words, starts, _ = words_of(b" ".join(part))
        upto = np.concatenate(([0], np.searchsorted(starts, np.cumsum([len(t) + 1 for t in part]))))
        grams = windows(words, size)
        for low, high in zip(upto[:-1], upto[1:], strict=True):
            if high - low >= size:
                out.append(np.unique(grams[low : high - size + 1]))
            elif high > low:
                out.append(windows(words[low:high], int(high - low), 1 + int(high - low)))
            else:
                out.append(np.empty(0, U))
    return out


def _hashes(config: NearConfig) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(config.seed)
    n = config.bands * config.rows
    return rng.integers(0, 2**63, n).astype(U) * U(2) + U(1), rng.integers(0, 2**63, n).astype(U)


def minima(shingles: np.ndarray, factors: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least value of each multiply-shift hash (32 bits) over a set."""
    a, b = factors
    least = np.full(len(a), 2**32 - 1, np.uint32)
    for k in range(0, len(shingles), 2048):
        part = shingles[k : k + 2048]
        for j in range(0, len(a), 48):  # small tables stay in the cache
            got = ((part * a[j : j + 48, None] + b[j : j + 48, None]) >> U(32)).astype(np.uint32).min(1)
            np.minimum(least[j : j + 48], got, out=least[j : j + 48])
    return least


def band_keys(least: np.ndarray, config: NearConfig) -> np.ndarray:
    """One 64-bit key for each band: the minima of its rows."""
    key = np.arange(config.bands, dtype=U)
    for column in least.reshape(config.bands, config.rows).T:
        key = mix(key * U(0x9E3779B97F4A7C15) + column)
    return key


def sketch(least: np.ndarray) -> np.ndarray:
    """One byte of each minimum."""
    return (mix(least.astype(U)) >> U(56)).astype(np.uint8)


def least_agreement(config: NearConfig) -> int:
    """Bytes of two sketches that agree at least if the sets are linked: six deviations below the mean at that similarity."""
    n, p = min(config.signature, config.bands * config.rows), config.percent / 100
    p += (1 - p) / 256
    return max(0, int(np.floor(n * p - 6 * np.sqrt(n * p * (1 - p)))))


def signatures(docs: DataFrame, config: NearConfig) -> DataFrame:
    """doc_id, n_shingles, digest of the set, and its band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _hashes(config)
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part["text"].cast(pa.large_binary()).to_pylist(), config.shingle)
                keys = [band_keys(minima(s, factors), config).view(np.int64) if len(s) else [] for s in sets]
                digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "digest", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_shingles long, digest binary, bands array<long>")


def shingle_table(docs: DataFrame, ids: DataFrame, config: NearConfig) -> DataFrame:
    """rep, and the sketch and full set (8 bytes for each shingle) of the documents in ``ids`` (rep)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = tuple(x[: config.signature] for x in _hashes(config))
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part["text"].cast(pa.large_binary()).to_pylist(), config.shingle)
                short = [sketch(minima(s, factors)).tobytes() for s in sets]
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(short, pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["rep", "sketch", "shingles"])

    ids = ids.withColumnRenamed("rep", "doc_id")
    wanted = maybe_in(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ids, "doc_id").where("maybe").drop("maybe")
    wanted = wanted.join(ids, "doc_id", "left_semi")
    return wanted.mapInArrow(run, "rep long, sketch binary, shingles binary").where(F.octet_length("shingles") > 0)


def _linked(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * both >= percent * (len(one) + len(other) - both)


def join_open(members: list[tuple[int, int, bytes, np.ndarray]], first: int, config: NearConfig) -> list[tuple[int, int]]:
    """Links between (component, rep, sketch, set) rows, each joining two components that were apart.

    With ``first`` 0 all pairs are tried, else those of a row before ``first``
    and one at or after it.
    """
    most = least_agreement(config)
    short = np.frombuffer(b"".join(m[2] for m in members), np.uint8).reshape(len(members), -1)
    component = np.array([m[0] for m in members])
    sets, links = [m[3] for m in members], []
    for i in range(first or len(members)):
        rest = slice(first or i + 1, None)
        open_ = np.flatnonzero(component[rest] != component[i]) + rest.start
        open_ = open_[(short[open_] == short[i]).sum(1) >= most]
        for j in open_.tolist():
            if component[i] != component[j] and _linked(sets[i], sets[j], config.percent):
                links.append((members[i][1], members[j][1]))
                low, high = sorted((component[i], component[j]))
                component[component == high] = low
    return links


def near_duplicates(docs: DataFrame, config: NearConfig = NearConfig()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs`` (doc_id, text)."""
    percent = config.percent
    signed = stored(signatures(docs, config), "signatures")
    alive = signed.where("n_shingles > 0 and doc_id is not null")
    reps = alive.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    own = alive.select("doc_id", "digest", "bands").join(reps.withColumnRenamed("rep", "doc_id"), ["doc_id", "digest"], "left_semi")
    bands = own.select(F.col("doc_id").alias("rep"), F.explode("bands").alias("bucket"))
    # an aggregate, combined before the shuffle, and a join that splits a hot bucket; a window would not
    leads = bands.groupBy("bucket").agg(F.min("rep").alias("lead"), F.max("rep").alias("most")).where("lead < most").select("bucket", "lead")
    shared = stored(bands.join(leads.hint("merge"), "bucket"), "buckets")
    sets = stored(shingle_table(docs, shared.select("rep").distinct(), config), "sets")

    # a) every member of a bucket against its leader, once for each pair
    pairs = shared.where("rep <> lead").select("lead", "rep").distinct()
    least = least_agreement(config)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "other"):
                a, b = (np.frombuffer(b"".join(part[c].to_pylist()), np.uint8).reshape(part.num_rows, -1) for c in ("short", "other_short"))
                near = (a == b).sum(1) >= least
                some = part.filter(pa.array(near))
                one, other = ([np.frombuffer(x, U) for x in some[c].to_pylist()] for c in ("one", "other"))
                good = pa.array([_linked(x, y, percent) for x, y in zip(one, other, strict=True)], pa.bool_())
                yield pa.RecordBatch.from_arrays([some["lead"], some["rep"]], ["u", "v"]).filter(good)

    one = sets.select(F.col("rep").alias("lead"), F.col("sketch").alias("short"), F.col("shingles").alias("one"))
    other = sets.select("rep", F.col("sketch").alias("other_short"), F.col("shingles").alias("other"))
    linked = pairs.join(one, "lead").join(other, "rep")
    # rows of one doc_id with different texts are one document: the classes of its texts are linked
    several = alive.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).where("low <> high").select("doc_id")
    own_reps = alive.select("doc_id", "digest").join(several, "doc_id", "left_semi").join(reps, "digest").select("doc_id", "rep").distinct()
    same = own_reps.join(own_reps.groupBy("doc_id").agg(F.min("rep").alias("u")), "doc_id").where("u <> rep").select("u", F.col("rep").alias("v"))
    first = stored(linked.select("lead", "rep", "short", "other_short", "one", "other").mapInArrow(verify, "u long, v long").unionByName(same), "links")
    joined = components(first)
    discard(first)

    # b) what is left: members of one bucket, not its leader, in different components
    named = shared.where("rep <> lead").select("bucket", "rep").join(joined.withColumnRenamed("node", "rep"), "rep", "left").select("bucket", "rep", F.coalesce("component", "rep").alias("component")).distinct()
    sized = sets.select("rep", (F.octet_length("shingles") + F.octet_length("sketch")).alias("bytes"))
    mark = F.xxhash64("rep")
    kinds = named.join(sized, "rep").groupBy("bucket").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"), F.min("component").alias("low"), F.max("component").alias("high"), F.sum(mark.cast("decimal(38,0)")).alias("members"), F.bit_xor(mark).alias("mark"))
    # equal buckets of several bands are one
    kinds = kinds.where("low < high").groupBy("n", "members", "mark").agg(F.min("bucket").alias("bucket"), F.first("bytes").alias("bytes"))
    blocks = F.greatest(F.ceil(F.col("bytes") / config.block_bytes), F.ceil(F.col("n") / config.block)).cast("int")
    mine = F.pmod(F.xxhash64("rep", F.lit(1)), F.col("blocks")).cast("int")
    tasks = named.join(kinds, "bucket").withColumn("blocks", blocks).withColumn("mine", mine)
    tasks = tasks.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = tasks.select("bucket", F.least("mine", "with").alias("i"), F.greatest("mine", "with").alias("j"), "mine", "component", "rep").join(sets, "rep")

    def compare(table: pa.Table) -> pa.Table:
        i, j = table["i"][0].as_py(), table["j"][0].as_py()
        columns = [table[c].to_pylist() for c in ("mine", "component", "rep", "sketch", "shingles")]
        rows = sorted(zip(*columns, strict=True), key=lambda r: r[:3])
        first = 0 if i == j else sum(r[0] == i for r in rows)
        links = join_open([(c, rep, short, np.frombuffer(x, U)) for _, c, rep, short, x in rows], first, config) if first < len(rows) else []
        return pa.table({"u": pa.array([u for u, _ in links], pa.int64()), "v": pa.array([v for _, v in links], pa.int64())})

    more = stored(tasks.groupBy("bucket", "i", "j").applyInArrow(compare, "u long, v long"), "links")
    discard(shared)
    discard(sets)
    found = joined
    if not more.isEmpty():
        found = components(joined.select(F.col("node").alias("u"), F.col("component").alias("v")).where("u <> v").unionByName(more))
    discard(more)
    # every document through its class; those without a set, however many, are not joined
    classes = reps.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("component_id"))
    full = signed.where("digest is not null").select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
    out = full.select("doc_id", "n_shingles", "component_id").unionByName(signed.where("digest is null").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id")))
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
