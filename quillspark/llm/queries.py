"""The operators bound to the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from . import (alignment, ann, decontam, jaccard, lexical, mixing, quality, secrets, sharding, simhash, suffix, toxicity,
               urls)

TOKENIZERS = "/opt/tokenizers"  # folder of the public vocabulary files, on the driver

# The URL rules.
RULES: tuple[urls.Rule, ...] = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixing.in_order(mixed).select("doc_id", "size", "source_size", "target", "taken",
                                         "position")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")) \
        .select("doc_id", "held_out", "score", "predicted")


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), RULES)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                       "component_id")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = F.col("base")
    return found.select(
        "doc_id", *[secrets.count_of(base, k).alias(f"n_{k}") for k in secrets.KINDS[:3]],
        F.sha2(secrets.joined(base).cast("binary"), 256).alias("base_sha256"),
        secrets.joined(F.col("found")).alias("spans"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op9_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept"))
                       .cast("long").alias("n_removed"),
                       F.size("removed").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminated(table(spark, sf_dir, "documents"),
                                  table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "start_word", "words").distinct()


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = [Path(TOKENIZERS, name).read_bytes() for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    aligned = alignment.align(table(spark, sf_dir, "documents"), *models)
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                          F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256))
                          .alias("groups_sha256"))


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_toxicity": op2_toxicity,
    "op3_neighbours": op3_neighbours,
    "op4_url_filter": op4_url_filter,
    "op5_simhash": op5_simhash,
    "op6_secrets": op6_secrets,
    "op7_quality": op7_quality,
    "op8_sharding": op8_sharding,
    "op9_suffix": op9_suffix,
    "op10_decontamination": op10_decontamination,
    "op11_alignment": op11_alignment,
    "op12_lexical": op12_lexical,
    "op13_ngram_join": op13_ngram_join,
    "pipeline": pipeline,
}

# The mix in SQL: digest order, running words, and the shared level of the
# targets; the curriculum positions follow the same three schedules.
ORACLE: dict[str, str] = {
    "op1_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS digest,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
by_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rnk,
         CAST(sum(source_size) OVER () AS DOUBLE) AS total,
         CAST(3 * source_size AS DOUBLE) AS cap FROM by_source),
weighted AS (SELECT *, CAST(rnk % 3 + 1 AS DOUBLE) AS weight FROM ranked),
levels AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, rnk
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, rnk
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
shared AS (
  SELECT arg_min(level, (cap / weight, rnk)) AS shared FROM levels WHERE level * weight <= cap),
targets AS (
  SELECT source, source_size, rnk,
         least(coalesce(shared * weight, cap), cap) AS target FROM levels, shared),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.rnk,
         CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY digest, s.size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
shares AS (
  SELECT *, CASE WHEN target > 0 THEN CAST(start AS DOUBLE) / target ELSE 1.0 + start END AS share
  FROM placed)
SELECT doc_id, size, source_size, target,
       greatest(0, least(size, CAST(floor(target) AS BIGINT) - start))
       + greatest(0, least(size, CAST(floor(target) AS BIGINT) - source_size - start))
       + greatest(0, least(size, CAST(floor(target) AS BIGINT) - 2 * source_size - start)) AS taken,
       CASE WHEN share >= 1.0 THEN share
            WHEN rnk % 3 = 1 THEN share
            WHEN rnk % 3 = 0 THEN CASE
              WHEN share <= 0.625 THEN 0.0 + (sqrt(greatest(0.0, 2.25 + share * -2.0)) - 1.5) / -1.0
              ELSE 0.5 + (sqrt(greatest(0.0, 1.0 + (share - 0.625) * -2.0)) - 1.0) / -1.0 END
            ELSE CASE
              WHEN share <= 0.375 THEN 0.0 + (sqrt(greatest(0.0, 0.25 + share * 2.0)) - 0.5) / 1.0
              ELSE 0.5 + (sqrt(greatest(0.0, 1.0 + (share - 0.375) * 2.0)) - 1.0) / 1.0 END
       END AS position
FROM shares""",
    # The same scores from all postings of the terms of all items.
    "op12_lexical": r"""
WITH doc_terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
item_terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
lengths AS (SELECT doc_id, count(*) AS n FROM doc_terms GROUP BY doc_id),
corpus AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM lengths),
postings AS (
  SELECT doc_id, term, count(*) AS tf FROM doc_terms
  WHERE term IN (SELECT term FROM item_terms) GROUP BY doc_id, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM postings, corpus GROUP BY term, big_n),
impacts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * big_n) // big_l)))
         AS part
  FROM postings JOIN weights USING (term) JOIN lengths USING (doc_id), corpus),
scores AS (
  SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score
  FROM item_terms JOIN impacts USING (term) GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
         doc_id, score FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50""",
    # All pairs that share a shingle, and all that a chain of links reaches.
    "op13_ngram_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
         WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 2), lambda i : array_to_string(w[i:i + 3], ' ')) END) AS g
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.g = b.g
  WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
lowest AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles,
       CAST(least(d.doc_id, coalesce(low, d.doc_id)) AS BIGINT) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN lowest ON lowest.a = d.doc_id""",
}
