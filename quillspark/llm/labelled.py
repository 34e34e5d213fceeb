"""Labelled rows for the two classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text, text_or_empty


def fold(col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the folds."""
    return (F.crc32(id_text(col).cast("binary")) % folds).cast("int")


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int,
                  most: int, salt: str) -> DataFrame:
    """``text, label, part`` of about ``most`` labelled documents at most, none
    of the held-out fold; ``part`` in [0, 1) is the hash of the id. The bound
    holds for rows: each id has one.

    Labels above the bound are thinned by that hash before they meet the
    documents, so the broadcast side has a bound of its own. An id with several
    labels takes the largest, one with several texts the text of the least
    digest; null ids and labels take no part.
    """
    part = F.pmod(F.xxhash64(F.lit(salt), F.col("doc_id")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()
                         & (fold("doc_id", folds) != held_out)) \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
        .agg(F.max(label).cast("int").alias("label")).withColumn("part", part)
    total = known.count()
    if total > most:
        known = known.where(F.col("part") < most / total) \
            .withColumn("part", F.col("part") * (total / most))
    # min_by is a partial aggregate: a task passes on one text of an id.
    digest = F.md5(text_or_empty().cast("binary"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")) \
        .join(F.broadcast(known), "doc_id").groupBy("doc_id", "label", "part") \
        .agg(F.min_by("text", digest).alias("text")).select("text", "label", "part")
