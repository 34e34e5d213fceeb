"""Corpus pipeline: toxicity, near-duplicates, decontamination, mixing, shards.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps of the
rows of ``docs`` with the columns of the documents table; the last one adds the
shards. ``run`` writes every stage as Parquet in the shared folder and reads it
again for the next, so a lost executor costs one stage at most.

Rows are known by ``row_key``: null ids, repeated ids and repeated rows are all
fine. Null texts are kept as they are and treated as empty. Columns beyond
those of the documents table are dropped. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import decontam, mixing, sharding, simhash, toxicity
from quillspark.llm.common import stored, text_or_empty
from quillspark.sources.tables import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
SHARDS = 8


def row_key() -> Column:
    """Digest of id and text: rows that share it are copies of one row."""
    return F.md5(F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                             text_or_empty()).cast("binary"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity model does not reject; it learns from the
    labelled rows of ``docs`` outside the held-out fold."""
    scored = toxicity.toxicity(docs, table(spark, sf_dir, "labels"), keep=COLUMNS)
    return scored.where("predicted = 0").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: the one with the smallest id, null ids last; of
    several with that id, the smallest key; of repeated rows, any."""
    keyed = docs.select(*COLUMNS).withColumn("key", row_key())
    rows = simhash.near_duplicates(keyed, keep=("key",))
    first = F.min_by("key", F.struct(F.col("doc_id").isNull(), "doc_id", "key"))
    chosen = rows.groupBy("root").agg(first.alias("key")).select("key")
    return keyed.join(chosen, "key", "left_semi").dropDuplicates(["key"]).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no benchmark item."""
    keyed = docs.select(*COLUMNS).withColumn("key", row_key())
    found = decontam.contaminated(keyed, table(spark, sf_dir, "benchmark"), keep=("key",))
    return keyed.join(found.select("key").distinct(), "key", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in training order: a row for each pass that takes words of a
    document, so some rows come up to three times and others not at all."""
    mixed = mixing.mix(docs.select(*COLUMNS), keep=COLUMNS)
    return mixing.in_order(mixing.passes(mixed)).select(*COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their ``shard`` and their ``slot`` in it."""
    placed = sharding.assign(docs.select(*COLUMNS), SHARDS, keep=COLUMNS)
    return placed.select(*COLUMNS, "shard", "slot")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# Hashed models, fingerprints and differencing have no SQL form; tests compare
# the run with a plain computation of the same stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
