"""Walk-forward folds over calendar months.

Folds are positions in the sorted list of months that exist in the data:
fold f trains on months [f*step, f*step + train) and tests on month
f*step + train. Folds start while ``f*step < n_months - train - 1`` (so a
final fold is skipped when the remaining months are exactly enough, as in
the reference loop). Each month row is expanded to the (fold, role) entries
it belongs to with array functions, so the fold table is an aggregate of
per-month counts -- no driver loop and no join of months against folds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def month_index(df: DataFrame, month: str) -> DataFrame:
    """Distinct months with row counts and their 0-based position.

    The position window runs over the distinct months only (a small table).
    """
    counts = df.groupBy(month).agg(F.count(F.lit(1)).alias("rows"))
    return counts.select(month, "rows",
                         (F.row_number().over(Window.orderBy(month)) - 1).alias("midx"))


def fold_membership(months: DataFrame, n_months, train: int = 6, step: int = 6) -> DataFrame:
    """(month, rows, fold, role) for every fold a month takes part in."""
    m = F.col("midx")
    first = F.greatest(F.lit(0), F.ceil((m - train + 1) / step)).cast("int")
    last = F.floor(m / step).cast("int")
    train_entries = F.transform(F.sequence(first, F.greatest(first, last)),
                                lambda f: F.struct(f.alias("fold"), F.lit("train").alias("role")))
    train_entries = F.filter(train_entries, lambda e: e["fold"] <= last)
    test_fold = ((m - train) / step).cast("int")
    is_test = (m >= train) & (F.pmod(m - train, F.lit(step)) == 0)
    test_entry = F.when(is_test, F.array(F.struct(test_fold.alias("fold"), F.lit("test").alias("role")))) \
        .otherwise(F.array().cast("array<struct<fold:int,role:string>>"))
    entries = F.concat(train_entries, test_entry)
    valid = F.col("e.fold") * step < F.lit(n_months) - (train + 1)
    return (months.select("*", F.explode(entries).alias("e")).where(valid)
            .select("*", "e.fold", "e.role").drop("e"))


def walk_forward_folds(df: DataFrame, month: str, train: int = 6, step: int = 6) -> DataFrame:
    """One row per fold: train_start, train_end, test_month, n_train, n_test."""
    months = month_index(df, month)
    n_months = months.select(F.count(F.lit(1))).scalar()
    member = fold_membership(months, n_months, train, step)
    is_train, is_test = F.col("role") == "train", F.col("role") == "test"
    return member.groupBy("fold").agg(
        F.min(F.when(is_train, F.col(month))).alias("train_start"),
        F.max(F.when(is_train, F.col(month))).alias("train_end"),
        F.max(F.when(is_test, F.col(month))).alias("test_month"),
        F.sum(F.when(is_train, F.col("rows"))).alias("n_train"),
        F.sum(F.when(is_test, F.col("rows"))).alias("n_test"))
