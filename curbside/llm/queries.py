"""One query per operator over its whole table, with SQL where that can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbside.llm.alignment import align_tokenizers
from curbside.llm.decontamination import contaminated
from curbside.llm.exact_dedup import exact_duplicates
from curbside.llm.hard_negatives import hard_negatives
from curbside.llm.html_text import extract_text
from curbside.llm.language_id import identify_languages
from curbside.llm.line_dedup import repeated_lines
from curbside.llm.mixing import mix_sources
from curbside.llm.sharding import assign_shards
from curbside.llm.simhash_dedup import near_duplicates
from curbside.llm.tables import read
from curbside.llm.token_files import count_tokens
from curbside.llm.toxicity import held_out, score_toxicity
from curbside.llm.warc import round_trip


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    )


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read(spark, sf_dir, "pages"), between="\n\n")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read(spark, sf_dir, "pages"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    )


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held = held_out("doc_id", 4, 2)
    found = identify_languages(docs, docs.where(~held))
    return found.select(
        "doc_id", held.alias("held_out"), "lang_pred", "score", "languages"
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_lines(read(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(read(spark, sf_dir, "documents"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_html_text": op2_html_text,
    "op3_token_counts": op3_token_counts,
    "op4_warc": op4_warc,
    "op5_toxicity": op5_toxicity,
    "op6_simhash_dedup": op6_simhash_dedup,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_mixing": op8_mixing,
    "op9_language_id": op9_language_id,
    "op10_line_dedup": op10_line_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_alignment": op12_alignment,
    "op13_sharding": op13_sharding,
}

_NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

EXACT_DEDUP_SQL = f"""
WITH n AS (SELECT doc_id, {_NORMAL} AS t FROM documents)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM n
"""

# The steps over ``mixed``, the table that is to be mixed.
MIXING_STEPS = r"""
sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM mixed),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]
            AS weight
  FROM totals),
levels AS (
  SELECT *, (2 * source_size)::DOUBLE / weight AS full_at,
         row_number() OVER o AS nth,
         (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
          - coalesce(sum((2 * source_size)::DOUBLE) OVER
              (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked
  WINDOW o AS (ORDER BY (2 * source_size)::DOUBLE / weight, source NULLS LAST)),
targets AS (
  SELECT source, source_size,
         least((2 * source_size)::DOUBLE,
               coalesce((SELECT arg_min(level, nth) FROM levels WHERE level < full_at)
                        * weight, (2 * source_size)::DOUBLE)) AS target
  FROM levels),
offers AS (
  SELECT s.*, epoch,
         md5(epoch::VARCHAR || ':' || coalesce(doc_id::VARCHAR, 'null')) AS key
  FROM (SELECT row_number() OVER () AS r, * FROM sized) s, (VALUES (0), (1)) e(epoch)),
timed AS (
  SELECT o.*, source_size, target,
         CASE WHEN target > 0 THEN
           (2 * sum(size) OVER (PARTITION BY o.source ORDER BY epoch, key,
              doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING) - size)::DOUBLE
           / (2 * target) ELSE 0 END AS virtual_time
  FROM offers o JOIN targets t ON o.source IS NOT DISTINCT FROM t.source),
served AS (
  SELECT *, 2 * sum(size) OVER (ORDER BY virtual_time, source NULLS LAST, epoch, key,
              doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING) - size
            <= 3 * (SELECT sum(size) FROM sized) AS fits
  FROM timed)
SELECT doc_id, size, source_size, target,
       sum(CASE WHEN fits THEN size ELSE 0 END)::BIGINT AS taken
FROM served GROUP BY r, doc_id, size, source_size, target
"""

MIXING_SQL = f"WITH mixed AS (SELECT * FROM documents), {MIXING_STEPS}"

HARD_NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v,
         CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS alike,
         list_inner_product(a.v, o.v)::BIGINT AS score
  FROM v a JOIN v o ON a.vec_id <> o.vec_id
  WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, other_id AS negative_id, positive_score,
       score AS negative_score,
       (row_number() OVER (PARTITION BY p.anchor_id, positive_id
                           ORDER BY score DESC, other_id))::INT AS rank
FROM positives p JOIN scored s
  ON p.anchor_id = s.anchor_id AND NOT alike
     AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

SQL = {
    "op7_exact_dedup": EXACT_DEDUP_SQL,
    "op8_mixing": MIXING_SQL,
    "op11_hard_negatives": HARD_NEGATIVES_SQL,
}
