"""The contract queries over the shared tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, decontam, divergence, langid, minhash, mixing, negatives, quality, rules, secrets, sharding, substring
from .sampling import remainder

#: Rank file and pattern of the default vocabulary come from this package.
RANKS = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(modulus: int, rest: int) -> Column:
    """Whether a row is kept out of learning; one without an id is not, as it has no remainder."""
    return F.coalesce(remainder("doc_id", modulus) == rest, F.lit(False)).alias("held_out")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 3) != 1).select("doc_id", F.col("quality").alias("label"))
    config = quality.QualityConfig()
    model = quality.QualityModel.fit(quality.labelled_sample(docs, labels, config.rows_per_class), config)
    scored = quality.score_quality(docs, model)
    return scored.select("doc_id", held_out(3, 1), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip_digests(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op3_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = rules.RulesConfig()
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id").distinct()
    judged = rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), good, config)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.LanguageModel.fit(langid.language_sample(docs.where(remainder("doc_id", 5) != 0)))
    # the text goes into the tasks but does not come back
    found = langid.identify_language(docs.select("doc_id", "text"), model, keep=("doc_id",))
    return found.select("doc_id", held_out(5, 0), "lang_pred", "score", "ambiguous")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def spans_text(spans: str, kinds: tuple[str, ...]) -> Column:
    """Spans as kind:start:end, joined by commas."""
    own = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.fit(docs), keep=("doc_id",))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.sha2(spans_text("spans", secrets.KINDS[:3]).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", number("assign"), number("access"), number("hex"), base, spans_text("spans", secrets.KINDS).alias("spans"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.documents.select("doc_id", "size", "source_size", "target", "taken")


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), minhash.NearConfig(shingle=3, percent=85))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.repeated_words(table(spark, sf_dir, "documents").select("doc_id", "text"), window=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents").select("text", "lang", "source"))


def op12_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.benchmark_hits(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), keep=("doc_id",))
    listed = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), listed.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_bpe": op2_bpe,
    "op3_rules": op3_rules,
    "op4_language": op4_language,
    "op6_minhash": op6_minhash,
    "op5_sharding": op5_sharding,
    "op7_secrets": op7_secrets,
    "op8_mixing": op8_mixing,
    "op9_ann": op9_ann,
    "op10_substring": op10_substring,
    "op11_divergence": op11_divergence,
    "op12_decontam": op12_decontam,
    "op13_negatives": op13_negatives,
}

ORACLE_SQL: dict[str, str] = {
    "op6_minhash": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sets AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i : i + 2], ' ')) END) AS g FROM w),
sized AS (SELECT doc_id, g, count(*) OVER (PARTITION BY doc_id) AS n FROM sets),
pairs AS (SELECT a.doc_id AS u, b.doc_id AS v, a.n + b.n - count(*) AS either, count(*) AS shared FROM sized a JOIN sized b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n GROUP BY a.doc_id, b.doc_id, a.n, b.n),
links AS (SELECT u, v FROM pairs WHERE 100 * shared >= 85 * either),
steps AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (SELECT u AS doc_id, v AS other FROM steps UNION SELECT reach.doc_id, steps.v FROM reach JOIN steps ON steps.u = reach.other),
least_of AS (SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(low, w.doc_id)) AS component_id, w.doc_id = least(w.doc_id, coalesce(low, w.doc_id)) AS kept
FROM w LEFT JOIN counts USING (doc_id) LEFT JOIN least_of USING (doc_id)""",
    "op10_substring": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w WHERE len(ws) >= 20),
wins AS (SELECT doc_id, i, array_to_string(ws[i : i + 19], ' ') AS g FROM starts),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM wins) WHERE k > 1),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM later) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(CASE WHEN ps IS NULL THEN ws ELSE list_transform(list_filter(range(1, len(ws) + 1), lambda p: NOT list_contains(ps, p)), lambda p: ws[p]) END, ' ')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)""",
    "op11_divergence": r"""
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
each AS (SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM each GROUP BY ALL HAVING count(DISTINCT d) >= 3),
groups AS (SELECT DISTINCT lang, source FROM docs),
langs AS (SELECT g.lang, coalesce(v, 0) AS v, coalesce(n, 0) AS n FROM (SELECT DISTINCT lang FROM groups) g LEFT JOIN (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang) k USING (lang)),
tally AS (SELECT lang, source, term, count(*) AS n FROM each SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sums AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS n FROM groups g LEFT JOIN tally t USING (lang, source) GROUP BY ALL),
cells AS (SELECT s.lang, s.source, k.term, coalesce(t.n, 0) AS c, 1 + CAST(1000000000::HUGEINT * (coalesce(t.n, 0) + 1) // (s.n + l.v) AS BIGINT) AS p,
    1 + CAST(1000000000::HUGEINT * (k.n + 1) // (l.n + l.v) AS BIGINT) AS q
  FROM sums s JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN tally t ON t.lang = s.lang AND t.source = s.source AND t.term = k.term),
differ AS (SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN differ d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM cells WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= 200""",
    "op12_decontam": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
sized AS (SELECT item_id, ws, least(10, len(ws)) AS n FROM b WHERE len(ws) > 0),
wins AS (SELECT DISTINCT item_id, n, array_to_string(ws[i : i + n - 1], ' ') AS g FROM (SELECT item_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM sized)),
spots AS (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM sized) WHERE len(ws) >= n),
found AS (SELECT r, i, s.n, item_id FROM (SELECT r, i, n, array_to_string(ws[i : i + n - 1], ' ') AS g FROM spots) s JOIN wins w ON w.g = s.g AND w.n = s.n),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)""",
    "op13_negatives": """
WITH fine AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id AS id, CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * r.v[i])) AS BIGINT) AS score
  FROM fine a JOIN fine r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY rank <= 10""",
}
