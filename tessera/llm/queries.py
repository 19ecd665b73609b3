"""The registered queries of this subpackage, one for each operator, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.llm import (chat, decontaminate, license_scan, lm_quality, packing, pivot_search, quality_rules, secret_scan,
                         simhash_dups, spelling, url_filter, warc_zip, whitening)
from tessera.sources.tables import table


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.conversation_digests(chat.format_chat(turns.unionByName(control)))


OP1_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
marked AS (
  SELECT *, length(text) + (length(text) - length(replace(text, '\', '')))
            + len(regexp_extract_all(text, '<\|(?:turn|says|more|end)\|>|</?s>|\[/?INST\]')) AS chars,
         length(role) + (length(role) - length(replace(role, '\', '')))
            + len(regexp_extract_all(role, '<\|(?:turn|says|more|end)\|>|</?s>|\[/?INST\]')) AS role_chars,
         coalesce(lag(role) OVER w = role, false) AS more
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars + CASE WHEN more THEN 8 ELSE 23 + role_chars END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""


#: The rules of the URL query.
URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
             ("block", "net/fr/"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


OP4_SQL = """
WITH item_words AS (
  SELECT DISTINCT item_id, list_filter(string_split_regex(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE text IS NOT NULL),
item_windows AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS n FROM item_windows),
doc_words AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
doc_windows AS (
  SELECT r, n, i, list_slice(w, i, i + n - 1) AS win
  FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, sizes WHERE len(w) >= n)),
met AS (
  SELECT d.r, d.i, d.n, t.item_id FROM doc_windows d JOIN item_windows t ON d.win = t.win),
covered AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM met) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM met WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ctx = secret_scan.context(docs)
    return secret_scan.scan(docs, ctx, secret_scan.train(docs, ctx))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    return quality_rules.quality_rules(docs, model).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "probability")


def op8_lm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0")
    return lm_quality.score_characters(table(spark, sf_dir, "documents"), trusted)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.digests(warc_zip.round_trip(table(spark, sf_dir, "pages")))


OP9_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN first IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM f
"""


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dups.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pivot_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
    return found.withColumnRenamed("id", "vec_id")


OP11_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON len(q.x) = len(c.x) AND q.r <> c.r WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS place FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
"""


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), every=199)


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_url_filter": op2_url_filter,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_decontaminate": op4_decontaminate,
    "op5_license_scan": op5_license_scan,
    "op6_secret_scan": op6_secret_scan,
    "op7_quality_rules": op7_quality_rules,
    "op8_lm_quality": op8_lm_quality,
    "op9_warc": op9_warc,
    "op10_simhash": op10_simhash,
    "op11_topk_search": op11_topk_search,
    "op12_whitening": op12_whitening,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE = {
    "op1_chat_format": OP1_SQL,
    "op4_decontaminate": OP4_SQL,
    "op9_warc": OP9_SQL,
    "op11_topk_search": OP11_SQL,
}
