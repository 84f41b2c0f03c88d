"""The registered queries opN_<name>: each applies an operator to its whole table and returns the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, table
from .decontamination import contaminated
from .exact_dedup import exact_dedup
from .hard_negatives import hard_negatives
from .html_text import extract
from .licenses import license_scan
from .near_dedup import near_duplicates
from .packing import pack
from .ppm import score as ppm_score
from .prefix_trie import conversation_trie
from .sentence_pieces import encode
from .substring_dedup import substring_dedup
from .suffix_dedup import repeated_passages
from .toxicity import HELD_OUT as TOXIC_HELD_OUT
from .toxicity import toxicity


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm_score(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["item"])))
    return found.select(F.col("id").alias("doc_id"), (F.size("spans") > 0).alias("contaminated"), items.alias("item_ids"), F.size("spans").alias("n_spans"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(F.col("id").alias("doc_id"), held_out("id", *TOXIC_HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))


def op8_suffix_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = repeated_passages(table(spark, sf_dir, "documents"))
    return spans.select(F.col("id").alias("doc_id"), F.col("first").alias("first_word"), F.col("stop").alias("stop_word"), F.col("partner").alias("partner_id"))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).withColumn("n_chars", F.length("text").cast("long"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return encode(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "n_tokens", digest("ids").alias("ids_sha256"), digest("decoded").alias("decoded_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_pack": op1_pack, "op2_ppm": op2_ppm, "op3_near_duplicates": op3_near_duplicates, "op4_exact_dedup": op4_exact_dedup, "op5_decontamination": op5_decontamination, "op6_substrings": op6_substrings, "op7_toxicity": op7_toxicity, "op8_suffix_passages": op8_suffix_passages, "op9_html": op9_html, "op10_licenses": op10_licenses, "op11_sentencepiece": op11_sentencepiece, "op12_hard_negatives": op12_hard_negatives, "op13_prefix_trie": op13_prefix_trie}


OP4_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS n FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.n AS group_size,
       d.doc_id = g.keep_id AND row_number() OVER (PARTITION BY d.doc_id, d.t ORDER BY d.doc_id) = 1 AS kept,
       sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)
"""


OP12_SQL = """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q, row_number() OVER () AS r
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.r AS a, a.id AS anchor_id, b.id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.id % 50 = 0
),
p AS (SELECT a, anchor_id, id, score, row_number() OVER (PARTITION BY a ORDER BY score DESC, id) AS nth FROM s WHERE same QUALIFY nth <= 5)
SELECT p.anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.a, p.nth ORDER BY s.score DESC, s.id)::INTEGER AS rank,
       s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3
"""

# DuckDB has no crc32: it is a fold over the bytes of the decimal id (digits and a minus sign) with the table of the usual polynomial
OP13_SQL = """
WITH RECURSIVE byte_table AS (
  SELECT i, list_reduce([i::BIGINT] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(i)
),
crc_table AS (SELECT list(v ORDER BY i) AS tab FROM byte_table),
t AS (
  SELECT conv_id AS conv, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
heads AS (
  SELECT conv, n, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(conv::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
           lambda c, b: xor(c >> 8, tab[((xor(c, b)) & 255) + 1])), 4294967295) % 9 AS h
  FROM (SELECT conv, count(*) AS n FROM t GROUP BY conv), crc_table
),
convs AS (SELECT c.conv, c.h, c.conv - c.conv % 5 AS base, least(c.h, coalesce(b.n, 0)) AS shift FROM heads c LEFT JOIN heads b ON b.conv = c.conv - c.conv % 5),
path AS (
  SELECT c.conv, t.pos + 1 AS depth, t.role, t.text FROM convs c JOIN t ON t.conv = c.base AND t.pos < c.h
  UNION ALL
  SELECT c.conv, c.shift + t.pos - c.h + 1, t.role, t.text FROM convs c JOIN t ON t.conv = c.conv AND t.pos >= c.h
),
lengths AS (SELECT c.conv, count(p.depth) AS length FROM convs c LEFT JOIN path p ON p.conv = c.conv GROUP BY c.conv),
member AS (
  SELECT 0 AS depth, conv, min(conv) OVER () AS node, NULL::BIGINT AS parent, 0 AS size FROM convs
  UNION ALL
  SELECT p.depth::INTEGER, p.conv, min(p.conv) OVER (PARTITION BY p.depth, m.node, p.role, p.text), m.node, strlen(p.text)::INTEGER
  FROM member m JOIN path p ON p.conv = m.conv AND p.depth = m.depth + 1
),
node AS (
  SELECT m.depth, m.node, any_value(m.parent) AS parent, count(*) AS n, (count(*) - 1) * max(m.size) AS saved,
         sha256(coalesce(string_agg(CASE WHEN l.length = m.depth THEN m.conv::VARCHAR END, ',' ORDER BY m.conv), '')) AS ends
  FROM member m JOIN lengths l USING (conv) GROUP BY m.depth, m.node
),
kids AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS c FROM node WHERE depth > 0 GROUP BY depth, parent),
tagged AS (SELECT n.*, coalesce(k.c, 0) AS c FROM node n LEFT JOIN kids k ON k.depth = n.depth AND k.node = n.node),
up AS (
  SELECT depth, node, depth AS top_depth, node AS top_node, parent, saved, c FROM tagged
  UNION ALL
  SELECT u.depth, u.node, t.depth, t.node, t.parent, u.saved, u.c FROM up u JOIN tagged t ON t.depth = u.top_depth - 1 AND t.node = u.parent
),
sums AS (SELECT top_depth AS depth, top_node AS node, count(*) FILTER (WHERE c = 0) AS leaves, sum(saved)::BIGINT AS saved FROM up GROUP BY ALL)
SELECT t.node AS conv_id, t.depth::BIGINT AS depth, t.parent AS parent_conv_id, t.n AS n_convs, t.c AS n_children, s.leaves AS n_leaves, s.saved AS saved_tokens, t.ends AS ends_sha256
FROM tagged t JOIN sums s ON s.depth = t.depth AND s.node = t.node
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_exact_dedup": OP4_SQL, "op12_hard_negatives": OP12_SQL, "op13_prefix_trie": OP13_SQL}
