"""The corpus operators as queries over whole tables, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import conversation_repair, decontamination, embedding_dedup, license_scan, line_dedup, lm_scoring, minhash_dedup, mixing, secret_scan, token_alignment, token_counts, toxicity, warc
from tessera.llm.common import table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_cut", "cut", "text")


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85).withColumnRenamed("id", "doc_id")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path(token_counts.TOKENIZER))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).withColumnRenamed("id", "doc_id")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents")).drop("detections")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_minhash_dedup": op2_minhash_dedup,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_warc": op4_warc,
    "op5_mixing": op5_mixing,
    "op6_token_counts": op6_token_counts,
    "op7_toxicity": op7_toxicity,
    "op8_decontamination": op8_decontamination,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_secret_scan": op10_secret_scan,
    "op11_license_scan": op11_license_scan,
    "op12_token_alignment": op12_token_alignment,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE_SQL: dict[str, str] = {
    "op13_conversation_repair": conversation_repair.sql(),
    "op11_license_scan": license_scan.sql(),
    "op5_mixing": r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sizes GROUP BY source
), weighed AS (
  SELECT *, [5.0, 2.0, 1.0][place % 3 + 1]::DOUBLE AS weight, 3 * source_size AS most FROM per
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed
), fit AS (
  SELECT coalesce(arg_min(level, most / weight * 1000000.0 + place), 0) AS level FROM levels WHERE level * weight <= most
), rates AS (
  SELECT source, source_size, least(most::DOUBLE, f.level * weight) AS target,
    CASE WHEN source_size > 0 THEN least(most::DOUBLE, f.level * weight) / source_size ELSE 0 END AS rate
  FROM levels, fit f
)
SELECT s.doc_id, s.size, r.source_size, r.target,
  (s.size * (floor(r.rate) + CASE WHEN ('0x' || substr(md5('mix:' || coalesce(s.doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0 < r.rate - floor(r.rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sizes s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source
""",
    "op8_decontamination": r"""
WITH item_words AS (
  SELECT row_number() OVER () AS n, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)
), items AS (
  SELECT DISTINCT n, item_id, least(len(w), 5) AS k, unnest([array_to_string(w[i : i + least(len(w), 5) - 1], ' ') FOR i IN range(1, greatest(len(w) - 3, 2))]) AS gram
  FROM item_words WHERE len(w) > 0
), sized AS (
  SELECT n, count(*) AS n_item FROM items GROUP BY n
), doc_words AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE text IS NOT NULL
), grams AS (
  SELECT DISTINCT d, doc_id, k, unnest([array_to_string(w[i : i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS gram
  FROM doc_words, (SELECT DISTINCT k FROM items) WHERE len(w) >= k
)
SELECT g.doc_id, i.item_id, count(*)::BIGINT AS n_found, any_value(s.n_item)::BIGINT AS n_item
FROM grams g JOIN items i ON g.gram = i.gram AND g.k = i.k JOIN sized s ON i.n = s.n
GROUP BY g.d, g.doc_id, i.n, i.item_id HAVING 100 * count(*) >= 80 * any_value(s.n_item)
""",
}
