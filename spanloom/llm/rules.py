"""Quality rules: base counts, and a hashed n-gram likelihood ratio.

The verdict compares two multinomials over hashed n-grams (one and two tokens):
one counted over a trusted target, one over the whole raw corpus.  A document's
score is its mean log-likelihood ratio, and documents at or above the threshold
are kept.  Tokens are runs between white space, with runs of ASCII punctuation
on their own.

Everything is DataFrame expressions.  The table of ratios has a fixed number of
buckets, so it is one array of doubles, which the scoring pass reads from a
session variable.  Both multinomials count every document.  For the target only
documents whose id may be a trusted one, by a bitmap of fixed size, are shuffled
to meet the trusted ids; the scoring pass shuffles none.

Defined cases: a null or blank text has no words, fails the base rules and has
a null score; without trusted rows the verdict is that of the base rules;
repeated rows count as often as they occur; a null doc_id is no trusted one;
texts of any length are counted whole, word positions taking 20 bits of a sort
key, or 31 beyond 2^20 words; an empty table gives no rows.  Columns named as
the counts, score or kept are replaced; all others stay.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sampling import maybe_in
from .shared import at_end

SEPARATORS = "[ \t-\r]+"
SYMBOLS = "[#*$%&|<>]"
PUNCTUATION = r"([!-/:-@\[-`{-~]+)"
#: Bits of a position beside a hash, in texts of fewer than 2^20 windows and in others.
PLACES = (20, 31)
#: The columns of :func:`base_counts`.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


@dataclass(frozen=True)
class RulesConfig:
    buckets: int = 1 << 16
    #: Mean log ratio from which a document is kept.
    threshold: float = -0.4
    smoothing: float = 1.0
    #: Base rules: least words, and most words (percent) in repeated windows.
    least_words: int = 50
    most_repeated: int = 50
    repeat_window: int = 3


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` as an array."""
    padded = F.split(F.concat(F.lit(" "), F.coalesce(text, F.lit("")), F.lit(" ")), SEPARATORS)
    return F.slice(padded, 2, F.greatest(F.size(padded) - 2, F.lit(0)))


def _window(words: Column, at: Column, n: int) -> list[Column]:
    return [F.get(words, at + k) for k in range(n)]


def _window_keys(words: Column, n: int, place: int) -> Column:
    """Sorted longs, each a window's hash (high bits) and its position (the ``place`` low bits)."""
    high = lambda i: F.shiftleft(F.shiftright(F.xxhash64(*_window(words, i, n)), place), place)
    return F.sort_array(F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: high(i).bitwiseOR(i.cast("long"))))


def _alike(keys: Column, place: int) -> Column:
    """Positions of the windows whose hash a neighbour in ``keys`` shares."""
    found = _doubled(keys, lambda k: F.shiftright(k, place))
    return F.transform(found, lambda k: k.bitwiseAND(F.lit((1 << place) - 1)).cast("int"))


def _doubled(items: Column, key) -> Column:
    """The items of a sorted array (a column: it is read at every item) whose key a neighbour shares."""
    return F.filter(items, lambda x, j: F.coalesce(key(x) == key(F.get(items, j - 1)), F.lit(False)) | F.coalesce(key(x) == key(F.get(items, j + 1)), F.lit(False)))


def _sum(items: Column, kind: str) -> Column:
    return F.aggregate(items, F.lit(0).cast(kind), lambda a, x: a + x)


def base_counts(docs: DataFrame, config: RulesConfig = RulesConfig()) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    n = config.repeat_window
    names = [c for c in docs.columns if c not in COUNTS]
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \t-\r]"))
    # the input's other columns travel in a struct, so no name of theirs meets one of these
    out = docs.select(F.struct(*[c for c in names if c != "text"]).alias("row"), "text", words_of(F.col("text")).alias("words"), lines.alias("lines"))
    # The windows that may occur twice: their hash is a neighbour's when sorted.  The sort is one of plain longs.
    last, long_ = F.size("words") - n, F.size("words") - n >= 1 << PLACES[0]
    keys = F.when(last < 0, F.array().cast("array<bigint>")).when(long_, _window_keys(F.col("words"), n, PLACES[1])).otherwise(_window_keys(F.col("words"), n, PLACES[0]))
    out = out.withColumn("keys", keys)
    out = out.withColumn("maybe", F.when(long_, _alike(F.col("keys"), PLACES[1])).otherwise(_alike(F.col("keys"), PLACES[0])))
    # of those, the windows that are equal word by word
    exact = F.sort_array(F.transform("maybe", lambda p: F.struct(F.concat_ws(" ", *_window(F.col("words"), p, n)).alias("g"), p.alias("p"))))
    out = out.withColumn("exact", F.when(F.size("maybe") > 0, exact))
    at = F.sort_array(F.transform(_doubled(F.col("exact"), lambda x: x["g"]), lambda x: x["p"]))
    out = out.withColumn("at", F.when(F.size("maybe") > 0, at))
    covered = _sum(F.transform("at", lambda p, j: F.least(F.lit(n), F.coalesce(F.get("at", j + 1) - p, F.lit(n)))), "int")
    out = out.select(
        "row",
        "text",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < config.least_words) | (100 * F.col("n_repeat_words") > config.most_repeated * F.col("n_words"))
    return out.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in names], *COUNTS[:-1], failed.alias("base_failed"))


def features(text: Column, buckets: int) -> tuple[Column, Column]:
    """The tokens of a text, and (of a column that holds them) the buckets of its single tokens and pairs of tokens."""
    tokens, keep = F.col("tokens"), F.lit(buckets - 1)
    pairs = F.transform(tokens, lambda t, i: F.hash(t, F.get(tokens, i + 1)).bitwiseAND(keep))
    return words_of(F.regexp_replace(text, PUNCTUATION, " $1 ")).alias("tokens"), F.concat(F.transform(tokens, lambda t: F.hash(t).bitwiseAND(keep)), pairs)


def log_ratios(docs: DataFrame, trusted: DataFrame, config: RulesConfig = RulesConfig()) -> DataFrame:
    """One row: ``ratios``, an array of log(target / raw) by bucket, and ``known``, whether there is a target.

    ``trusted``: distinct doc_id, of any number.
    """
    tokens, buckets = features(F.col("text"), config.buckets)
    own = maybe_in(docs.select("doc_id", "text"), trusted, "doc_id")
    target = own.where("maybe").join(trusted.select("doc_id", F.lit(1).alias("mark")).hint("merge"), "doc_id", "left").select("text", "mark")
    marked = own.where("not maybe").select("text", F.lit(None).cast("int").alias("mark")).unionByName(target)
    # explode() would infer a filter on the array, which is then made twice
    each = marked.select(tokens, "mark").select(F.explode_outer(buckets).alias("bucket"), "mark").where("bucket is not null")
    counts = each.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("mark").alias("target"))
    dense = docs.sparkSession.range(config.buckets).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left").fillna(0)
    row = dense.agg(F.array_sort(F.collect_list(F.struct("bucket", "raw", "target"))).alias("c"), F.sum("raw").alias("n_raw"), F.sum("target").alias("n_target"))
    a, b = F.lit(config.smoothing), config.smoothing * config.buckets
    ratio = lambda c: F.log((c["target"] + a) / (F.col("n_target") + b)) - F.log((c["raw"] + a) / (F.col("n_raw") + b))
    return row.select(F.transform("c", ratio).alias("ratios"), (F.col("n_target") > 0).alias("known"))


def _as_variables(row: DataFrame) -> list[str]:
    """Session variables that hold the columns of a table of one row, until the scratch block or the process ends."""
    spark, mark = row.sparkSession, uuid.uuid4().hex
    row.createOrReplaceTempView(f"spanloom_{mark}")
    names = [f"spanloom_{c}_{mark}" for c in row.columns]
    for name, kind in zip(names, row.dtypes, strict=True):
        spark.sql(f"DECLARE VARIABLE {name} {kind[1]}")
    spark.sql(f"SET VAR ({', '.join(names)}) = (SELECT * FROM spanloom_{mark})")
    spark.catalog.dropTempView(f"spanloom_{mark}")
    at_end(lambda: [spark.sql(f"DROP TEMPORARY VARIABLE IF EXISTS {name}") for name in names])
    return names


def judge(docs: DataFrame, trusted: DataFrame, config: RulesConfig = RulesConfig()) -> DataFrame:
    """``docs`` with the base counts, score (mean log ratio) and kept."""
    if config.buckets & (config.buckets - 1):
        raise ValueError("buckets must be a power of two")
    table, known = (F.expr(name) for name in _as_variables(log_ratios(docs, trusted, config)))
    counted = base_counts(docs, config)
    names = [c for c in counted.columns if c not in ("score", "kept")]
    tokens, buckets = features(F.col("text"), config.buckets)
    scored = counted.select(F.struct(*names).alias("row"), tokens).select("row", buckets.alias("buckets"))
    total = F.aggregate("buckets", F.lit(0.0), lambda s, f: s + F.get(table, f))
    scored = scored.select("row.*", F.when(F.size("buckets") > 0, total / F.size("buckets")).alias("score"))
    verdict = ~known | (F.col("score") >= config.threshold)
    return scored.withColumn("kept", ~F.col("base_failed") & F.coalesce(verdict, F.lit(False)))
