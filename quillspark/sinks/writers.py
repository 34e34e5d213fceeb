"""Writers for the job outputs.

Row-level outputs are written in parallel by the executors. Only the
reports that are small by construction (a few metric lines, top-k, fold
summaries) are coalesced into one file, because their readers expect one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import latest_per_key
from ..operators.split import balanced_parts


def labelled_lines(df: DataFrame, columns: Sequence[str] | None = None, sep: str = ", ") -> DataFrame:
    """B1: one ``name: value, name: value`` text line per row."""
    cols = list(columns or df.columns)
    parts = [F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit("None"))) for c in cols]
    return df.select(F.concat_ws(sep, *parts).alias("value"))


def write_report(df: DataFrame, path: str, order: Sequence[str | Column] = (),
                 columns: Sequence[str] | None = None) -> None:
    """B1: small labelled text report in one file, rows in ``order``."""
    src = df.orderBy(*order) if order else df
    labelled_lines(src, columns).coalesce(1).write.mode("overwrite").text(path)


def write_sorted_tsv(df: DataFrame, path: str, order: Sequence[str | Column]) -> None:
    """B2: tab-separated rows, globally sorted (binary string order); range
    partitioned, so part files concatenate in order."""
    df.orderBy(*order).write.mode("overwrite").option("sep", "\t").csv(path)


def write_header_csv(df: DataFrame, path: str, rename: dict[str, str] | None = None) -> None:
    """CSV with a header line, optional column renames."""
    out = df
    for old, new in (rename or {}).items():
        out = out.withColumnRenamed(old, new)
    out.write.mode("overwrite").option("header", True).csv(path)


def write_top_tsv(df: DataFrame, path: str, order: Sequence[Column], n: int) -> None:
    """``INSERT OVERWRITE DIRECTORY ... LIMIT n``, sorted explicitly."""
    df.orderBy(*order).limit(n).coalesce(1).write.mode("overwrite").option("sep", "\t").csv(path)


def save_table(spark: SparkSession, df: DataFrame, database: str, table: str,
               location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` + CTAS-style managed table."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")
    df.write.mode("overwrite").saveAsTable(f"{database}.{table}")


def write_key_value_lines(df: DataFrame, path: str, key_cols: Sequence[str], value: str,
                          order: Sequence[str] | None = None, trailing_tab: bool = True) -> None:
    """Streaming-style ``k1,k2,value`` lines (with the empty-value tab
    the streaming reducer emitted), sorted by key text."""
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in key_cols], F.col(value).cast("string"))
    if trailing_tab:
        line = F.concat(line, F.lit("\t"))
    src = df.orderBy(*(order or key_cols))
    src.select(line.alias("value")).write.mode("overwrite").text(path)


def fold_report_lines(folds: DataFrame, metric: str = "mape", label: str = "MAPE") -> DataFrame:
    """B7 body: three summary lines, then per fold the window line, the
    unrounded metric and a rule; ordered by (block, fold, line)."""
    # The texts of the report lines.
    summary = folds.agg(F.round(F.avg(metric), 2).alias("mean"), F.round(F.max(metric), 2).alias("max"),
                        F.round(F.min(metric), 2).alias("min"))
    head = summary.select(F.explode(F.array(
        F.struct(F.lit(0).alias("i"), F.concat(F.lit(f"Mean {label} = "), F.col("mean").cast("string")).alias("v")),
        F.struct(F.lit(1).alias("i"), F.concat(F.lit(f"Max {label} = "), F.col("max").cast("string")).alias("v")),
        F.struct(F.lit(2).alias("i"), F.concat(F.lit(f"Min {label} = "), F.col("min").cast("string")).alias("v")),
    )).alias("l")).select(F.lit(0).alias("blk"), F.lit(0).alias("fold"), "l.i", "l.v")
    body = folds.select(F.lit(1).alias("blk"), "fold", F.explode(F.array(
        F.struct(F.lit(0).alias("i"), F.concat(F.lit("Training from "), "train_start", F.lit(" to "), "train_end",
                                               F.lit(", Testing month: "), "test_month").alias("v")),
        F.struct(F.lit(1).alias("i"), F.concat(F.lit(f"{label}: "), F.col(metric).cast("string")).alias("v")),
        F.struct(F.lit(2).alias("i"), F.lit("-" * 34).alias("v")),
    )).alias("l")).select("blk", "fold", "l.i", "l.v")
    return head.unionByName(body)


def write_fold_report(folds: DataFrame, path: str, metric: str = "mape") -> None:
    """Fold summary text (mean/max/min rounded to 2, per-fold raw)."""
    lines = fold_report_lines(folds, metric)
    lines.orderBy("blk", "fold", "i").select(F.col("v").alias("value")).coalesce(1) \
        .write.mode("overwrite").text(path)


def write_keyed_table(df: DataFrame, path: str, key: str, order: str) -> None:
    """Keyed rows, one per key (latest ``order`` wins), table replaced."""
    latest_per_key(df, key, order).write.mode("overwrite").parquet(path)


LINE_ORDER = ("file_no", "file_path", "split_start", "row_id")


def read_lines_in_order(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """B9 input: text lines of several files or folders with their order key:
    argument, file, start of the split in the file, row within the split."""
    parts = []
    for i, p in enumerate(paths):
        parts.append(spark.read.text(p).select(
            F.lit(i).alias("file_no"), F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("split_start"),
            F.monotonically_increasing_id().alias("row_id"), "value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def merge_files(spark: SparkSession, paths: Sequence[str], out: str) -> None:
    """Concatenate files in argument order (files of a folder by name).

    The output is range-sorted: its part files follow each other in order, are
    written in parallel, and read as one folder.
    """
    read_lines_in_order(spark, paths).orderBy(*LINE_ORDER).select("value").write.mode("overwrite").text(out)


def write_balanced_parts(df: DataFrame, out: str, order: Sequence[str], parts: int,
                         fmt: str = "csv") -> None:
    """Contiguous parts of near-equal size (the first ``total % parts``
    parts one row larger), one folder per part, its files and their rows in
    order."""
    tagged = balanced_parts(df, order, parts)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tagged.repartitionByRange(n, "part", *order).sortWithinPartitions("part", *order) \
        .write.mode("overwrite").partitionBy("part").format(fmt).save(out)


# The layouts of the block report and of the test report.
def write_model_report(metrics: DataFrame, path: str, model: str = "model",
                       order: Sequence[str] = ("model",)) -> None:
    """B1: per row a block ``Model: X``, one ``metric: value`` line per other
    column, and a blank line."""
    names = [c for c in metrics.columns if c != model]
    lines = [F.concat(F.lit("Model: "), F.col(model))] + [
        F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit("None"))) for c in names]
    metrics.repartition(1).sortWithinPartitions(*order) \
        .select(F.concat_ws("\n", *lines, F.lit("")).alias("value")).write.mode("overwrite").text(path)


def write_test_report(result: DataFrame, path: str, level: float = 0.05) -> None:
    """B1: t-statistic, p-value and the line that says which side of ``level``
    the p-value is on (``t_stat, p_value`` columns)."""
    verdict = F.when(F.col("p_value") < level, "The difference is statistically significant.") \
        .otherwise("The difference is not statistically significant.")
    result.select(F.concat_ws("\n", F.concat(F.lit("T-statistic: "), F.col("t_stat").cast("string")),
                              F.concat(F.lit("P-value: "), F.col("p_value").cast("string")), verdict)
                  .alias("value")).coalesce(1).write.mode("overwrite").text(path)
