"""A corpus pipeline: language, near copies, secrets, mixture, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``.  All but the last
return the columns of ``documents``, and any others that ``docs`` has.

Defined cases: a text that is null or has no letter goes in the first stage, as
its language is unknown; empty tables give empty tables; of rows that are equal
in doc_id and text one stays after the second stage, and rows that share a
doc_id but differ in text, or have none, are documents of their own there;
texts of any length are taken whole; extra columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm import bpe, langid, minhash, mixing, secrets
from spanloom.llm.queries import RANKS, table
from spanloom.llm.sampling import maybe_in, remainder
from spanloom.llm.shared import discard, scratch, small_batches, stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those between two languages."""
    model = langid.LanguageModel.fit(langid.language_sample(docs.where(remainder("doc_id", 5) != 0)))
    others = F.struct(*[c for c in docs.columns if c != "text"]).alias("row")
    found = langid.identify_language(docs.select(others, "text"), model)
    same = [F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns]
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & ~F.col("ambiguous")).select(*same)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: five-word shingles, similarity of 0.8 or more.

    Documents are known by their doc_id; where it is null, or rows with
    different texts share it, by a hash of doc_id and text.
    """
    texts = docs.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("low"), F.max(F.xxhash64("text")).alias("high"))
    rows = maybe_in(docs.select(F.struct("*").alias("row"), "doc_id"), texts.where("low <> high"), "doc_id")
    own = F.when(F.col("maybe") | F.col("doc_id").isNull(), F.xxhash64("doc_id", "row.text")).otherwise(F.col("doc_id").cast("long"))
    known = rows.select(own.alias("doc_id"), "row")
    with small_batches(spark):  # sets are large rows
        found = minhash.near_duplicates(known.select("doc_id", "row.text"), minhash.NearConfig(shingle=5, percent=80, bands=32, rows=5))
    fate = stored(found.groupBy("doc_id").agg(F.max("kept").alias("stays"), F.count("*").alias("n")), "fate")
    # most rows stay and are alone with their id: they are passed on as they are read, only the others are moved
    looked = maybe_in(known, fate.where("not stays or n > 1"), "doc_id")
    moved = looked.where("maybe").select("doc_id", "row").join(fate.where("stays").select("doc_id"), "doc_id", "left_semi")
    # rows that are equal in both differ in other columns at most
    one = moved.groupBy("doc_id").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return looked.where("not maybe").select("row").unionByName(one.select("row")).select("row.*")


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks the secrets found in the texts."""
    with small_batches(spark):
        model = secrets.fit(docs.select("doc_id", "text"))
    masked = secrets.redact(docs, model)
    return masked.withColumn("n_chars", F.length("text").cast(masked.schema["n_chars"].dataType))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents as often as the mix takes their words.

    A document's words taken, over its words, is rounded up or down by a hash
    of its id, so that a source comes out near its target.
    """
    mixed = mixing.mix_sources(docs.select("doc_id", "source", "text")).documents
    share = mixed.groupBy("doc_id").agg((F.sum("taken") / F.greatest(F.sum("size"), F.lit(1))).alias("share"))
    chance = F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1 << 20)) / float(1 << 20)
    copies = share.select("doc_id", F.floor(F.col("share") + chance).cast("int").alias("copies")).where("copies > 0")
    rows = docs.select("doc_id", F.struct("*").alias("row")).alias("d").join(copies.alias("c"), F.expr("d.doc_id <=> c.doc_id"))
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, and whether they decode to it byte by byte."""
    import public_tokenizers

    coded = bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", "ids", "intact")


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("secret_spans", secret_spans),
    ("mixture", mixture),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before = docs
        with scratch():  # what a stage wrote for itself goes with it
            made = stage(spark, docs, sf_dir)
            docs = stored(made, f"pipeline-{name}", keep=True)
        discard(before)
    return docs


#: Learned models, MinHash and BPE are not SQL; the tests hold the result against a plain version.
ORACLE_SQL = None
