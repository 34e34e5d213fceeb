"""Helpers shared by the operators: tables, shared storage, row order."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes that separate words: space and the six control characters 09-0D.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir`` of the
    session, or, where that is unset (tests, local runs), a folder in the
    warehouse."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        conf = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return conf.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """Write an intermediate to the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not the upstream work,
    and later jobs read only the columns they need.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def id_text(col: str = "doc_id") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used
    there, lambdas included."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Identity of a row by what it holds: id and text. Rows that agree in both
    are interchangeable in every result."""
    return F.struct(F.col(doc_id).cast("long").alias("id"),
                    F.md5(text_or_empty(text).cast("binary")).alias("md5"))


def unit(md5_hex: Column) -> Column:
    """First 32 bits of a hex digest as a number in [0, 1)."""
    return F.conv(F.substring(md5_hex, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def root_buckets(count: Column) -> Column:
    """How many hash buckets split ``count`` rows so that both the buckets and
    the rows in one grow with the square root only."""
    return F.greatest(F.lit(1), F.ceil(F.sqrt(count.cast("double")))).cast("long")


# monotonically_increasing_id: the task above, the row in it below.
_TASK_BITS = 33


def with_task(df: DataFrame, row: str = "row", task: str = "task") -> DataFrame:
    """Number the rows, for tables that are written next: ``row`` is unique and
    ``task`` says which of the writing tasks had it. Rows that agree in all that
    orders them can then be counted by task and placed by those counts, so that
    a row repeated any number of times is never numbered in one task."""
    return df.withColumn(row, F.monotonically_increasing_id()) \
        .withColumn(task, F.shiftright(row, _TASK_BITS))
