"""The registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, decontaminate, embedding_dedup, hard_negatives, lm, mixing, periodic_runs, pii, quality, sampling, simhash,
               token_counts, token_store, toxicity)
from .scratch import Scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held_out(mod: int, rest: int):
    return F.coalesce(sampling.remainder(F.col("doc_id"), mod) == rest, F.lit(False))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link(_table(spark, sf_dir, "embeddings"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    held = _held_out(toxicity.HELD_OUT_MOD, toxicity.HELD_OUT)
    return toxicity.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.group(_table(spark, sf_dir, "documents"))


def stored_tokens(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Written with the public word vocabulary, and read back from the files."""
    path = Scratch(spark, "tokens").path("orc")
    token_store.write(docs, path, token_store.vocabulary())
    return token_store.checksums(token_store.read(spark, path))


def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_tokens(spark, _table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.pseudonymise(_table(spark, sf_dir, "documents"), pii.DEMO_KEY)
    return out.select("doc_id", "text", F.size("pii").cast("long").alias("n_replaced"),
                      F.transform("pii", lambda p: p["kind"]).alias("kinds"),
                      F.transform("pii", lambda p: p["pseudonym"]).alias("pseudonyms"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    held = _held_out(quality.HELD_OUT_MOD, quality.HELD_OUT)
    return quality.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "\\### Assistant: </turn> ok"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    written = Scratch(spark, "chat").store(chat.format_conversations(turns), "formatted")
    back = chat.read_back(written)
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_table(spark, sf_dir, "documents"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), token_store.vocabulary())


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    # every tenth text gets a periodic tail: words from a on repeat the p words there
    docs = (_table(spark, sf_dir, "documents").select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
            .select("doc_id", "text", "g", F.when(F.col("h") % 10 == 0, periodic_runs.words_of(F.col("text"))).alias("w"))
            .select("doc_id", "text", "g", "w", F.size("w").alias("n"))
            .select("doc_id", "text", "g", "w", "n", F.when(F.col("n") > 0, F.col("g") % F.col("n")).alias("a"))
            .select("doc_id", "text", "w", "a", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).alias("p")))
    made = F.array_join(F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(
        F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))), " ")
    texts = docs.select("doc_id", F.when(F.col("a").isNotNull(), made).otherwise(F.col("text")).alias("text"))
    best = periodic_runs.longest(F.col("runs"))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    return (periodic_runs.find_runs(texts).withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        (-F.col("best.k")).alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * -F.col("best.k") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"), label)


QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_embedding_dedup, op3_toxicity, op4_mixing, op5_simhash, op6_token_ids, op7_pii,
    op8_quality, op9_chat, op10_lm_scoring, op11_token_counts, op12_periodic_runs, op13_hard_negatives)}

ORACLE_SQL = {
    # items with fewer than ten words are one window; a window's occurrences are found word by word
    "op1_decontamination": r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS s
  FROM b, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS t(i) WHERE len(w) > 0),
size AS (SELECT DISTINCT n FROM win),
place AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM d, size, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n),
met AS (SELECT p.doc_id, p.i, p.n, win.item_id FROM place p JOIN win USING (n, s)),
hit AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM (SELECT DISTINCT doc_id, i, n FROM met), unnest(range(0, n)) AS t(j) GROUP BY doc_id),
item AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM met) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(hit.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(item.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(item.ids, '')) AS items_sha256,
       coalesce(hit.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN item USING (doc_id)
""",
    "op2_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_aggregate(list_transform(e, lambda x: abs(x)), 'max') > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
deg AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, CAST(coalesce(deg.n, 0) AS BIGINT) AS n_links, comp.component_id, v.vec_id = comp.component_id AS kept
FROM v JOIN comp USING (vec_id) LEFT JOIN deg USING (vec_id)
""",
    "op9_chat": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
         replace(replace(replace(text, '\', '\b'), '<', '\l'), '#', '\h') AS coded,
         replace(replace(replace(replace(role, '\', '\b'), '<', '\l'), '#', '\h'), ':', '\c') AS coded_role
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(coded) + 8 + CASE WHEN before IS NULL OR before <> role THEN length(coded_role) + 6 ELSE 0 END) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
""",
    "op13_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) <= 3
""",
}
