"""One query per operator over its whole table, with the parameters meant for production, and SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm import bpe, forest, html, lexical, line_dedup, maxent, minhash, mixing, negatives, perplexity, quality, token_file, toxicity
from riskflow.llm.words import table
from riskflow.session import work_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return forest.near_duplicates(vectors).select("vec_id", "n_links", "component_id", "kept")


def op3_maxent_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return maxent.score(docs).drop("text")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html.extract(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, path, public_tokenizers.PATTERN).drop("text")
    decoded = bpe.decode(coded, path)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = line_dedup.dedup(docs)
    return cut.select("doc_id", "n_lines", "n_deleted", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, table(spark, sf_dir, "labels")).drop("text")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score(docs, table(spark, sf_dir, "labels")).drop("text")


def op9_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_order", "log_perplexity", "log_words"]
    return perplexity.judge(docs, keep_text=False).select("doc_id", *made)


def op10_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).drop("row")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors, label=moved)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents").select("doc_id", "text"), work_path(spark, "token_files")
    token_file.write(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end=2)
    return token_file.read(spark, path, with_ids=False)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical.build_index(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return lexical.search(index, table(spark, sf_dir, "benchmark").select("item_id", "text"))


# Fixed value: the words of a text, as the contracts give them.
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

MINHASH_SQL = f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
grams AS (
  SELECT doc_id, unnest(list_distinct(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END)) AS g
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
  WHERE 100 * common >= 80 * (s.n + t.n - common)),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.other)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""

FOREST_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM vectors a JOIN vectors b
  ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION
  SELECT reach.vec_id, links.y FROM reach JOIN links ON links.x = reach.other)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e
LEFT JOIN (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x) USING (vec_id)
JOIN (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id) USING (vec_id)
"""

NEGATIVES_SQL = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT same
  AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 5
"""

# Fixed value: the terms of a text, as the contract gives them.
_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

LEXICAL_SQL = f"""
WITH held AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM held GROUP BY ALL),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tfs GROUP BY doc_id),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
norms AS (SELECT doc_id, 100 - 25 + (25 * n * docs) // terms AS m FROM sizes, total),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), total),
wanted AS (SELECT item_id, term, count(*) AS qtf FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
scores AS (
  SELECT item_id, doc_id, sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN tfs USING (term) JOIN norms USING (doc_id) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 20
"""


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_minhash_near_dedup, op2_embedding_near_dedup, op3_maxent_scoring, op4_html_extraction, op5_byte_bpe, op6_line_dedup,
        op7_toxicity, op8_quality, op9_perplexity_rules, op10_temperature_mixing, op11_hard_negatives, op12_token_files,
        op13_lexical_search,
    ]
    return {query.__name__: query for query in found}


def all_oracles() -> dict[str, str]:
    return {
        "op1_minhash_near_dedup": MINHASH_SQL,
        "op2_embedding_near_dedup": FOREST_SQL,
        "op11_hard_negatives": NEGATIVES_SQL,
        "op13_lexical_search": LEXICAL_SQL,
    }
