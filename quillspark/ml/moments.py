"""Walk-forward least squares from mergeable co-moments.

One aggregate by month gives the count, the means and the centred cross-products
of all inputs and the label. These merge exactly like counts do, so a fold is the
merge of its months and its fit one small solve: no row is read again for any
fold. A second aggregate scores the test months with the fitted coefficients.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import abs_pct_error


class Moments(NamedTuple):
    """Rows, means, and sums of products of deviations from the means."""

    n: int
    mean: np.ndarray
    cross: np.ndarray

    def merge(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not n:
            return self
        step = other.mean - self.mean
        return Moments(n, self.mean + step * (other.n / n),
                       self.cross + other.cross + np.outer(step, step) * (self.n * other.n / n))


def month_moments(df: DataFrame, month: str, columns: Sequence[str]) -> DataFrame:
    """Per month: ``rows`` (all), ``n`` (rows without a missing value), ``mean``
    and ``cross``, the upper triangle row by row, both of the rows counted in
    ``n``. Spark merges covariances around running means, so large means cost no
    digits, and partial sums of a month of any size are one row."""
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    x = [F.when(whole, F.col(c).cast("double")) for c in columns]
    n = F.count_if(whole)
    cross = [F.covar_pop(x[i], x[j]) * n for i in range(len(x)) for j in range(i, len(x))]
    return df.groupBy(month).agg(F.count(F.lit(1)).alias("rows"), n.alias("n"),
                                 F.array(*[F.avg(c) for c in x]).alias("mean"), F.array(*cross).alias("cross"))


def _moments(row, width: int) -> Moments:
    if not row["n"]:
        return Moments(0, np.zeros(width), np.zeros((width, width)))
    cross = np.zeros((width, width))
    upper = np.triu_indices(width)
    cross[upper] = row["cross"]
    cross.T[upper] = row["cross"]
    return Moments(row["n"], np.array(row["mean"]), cross)


def least_squares(m: Moments) -> tuple[np.ndarray, float]:
    """Coefficients and intercept; the label stands last. Columns are scaled by
    their deviation first; constant and collinear inputs take the solution of
    least norm."""
    inputs, label = m.cross[:-1, :-1], m.cross[:-1, -1]
    scale = np.sqrt(np.diag(inputs))
    # Constant columns keep nothing but rounding of their mean.
    live = scale > 1e-12 * np.sqrt(m.n) * np.maximum(1.0, np.abs(m.mean[:-1]))
    coef = np.zeros(len(label))
    s = scale[live]
    coef[live] = np.linalg.lstsq(inputs[np.ix_(live, live)] / np.outer(s, s), label[live] / s, rcond=1e-12)[0] / s
    return coef, float(m.mean[-1] - coef @ m.mean[:-1])


def walk_forward_moments(df: DataFrame, month: str, inputs: Sequence[str], label: str,
                         train: int = 6, step: int = 6) -> DataFrame:
    """``fold, train_start, train_end, test_month, mape``.

    Folds are those of ``operators.folds``: fold f trains on ``train`` months
    from position ``f * step`` on and tests on the next one. Rows with a missing
    input or label take no part. The driver sees a row of moments per month.
    """
    spark, width = df.sparkSession, len(inputs) + 1
    months = sorted(month_moments(df, month, [*inputs, label]).where(F.col(month).isNotNull()).collect(),
                    key=lambda r: r[month])
    schema = "fold int, train_start string, train_end string, test_month string"
    fits = []
    for fold, first in enumerate(range(0, max(0, len(months) - train - 1), step)):
        total = Moments(0, np.zeros(width), np.zeros((width, width)))
        for row in months[first:first + train]:
            total = total.merge(_moments(row, width))
        if total.n:
            coef, base = least_squares(total)
            fits.append((fold, months[first][month], months[first + train - 1][month],
                         months[first + train][month], coef.tolist(), base))
    if not fits:
        return spark.createDataFrame([], schema + ", mape double")
    # One fold per test month: the coefficients are literals, one scan scores all.
    names = [f[3] for f in fits]
    of = F.array_position(F.array(*[F.lit(m) for m in names]), F.col(month))
    coefs = F.element_at(F.array(*[F.array(*[F.lit(float(c)) for c in (*f[4], f[5])]) for f in fits]), of.cast("int"))
    rows = df.where(F.col(month).isin(names)).select(
        F.col(month).alias("test_month"), coefs.alias("c"), F.col(label).cast("double").alias("y"),
        F.array(*[F.col(c).cast("double") for c in inputs]).alias("x")).where(
            F.col("y").isNotNull() & ~F.exists("x", lambda v: v.isNull() | F.isnan(v)))
    dot = F.aggregate(F.zip_with("x", "c", lambda x, c: x * c), F.lit(0.0),
                      lambda a, v: a + F.coalesce(v, F.lit(0.0)))
    scored = rows.groupBy("test_month").agg(
        F.avg(abs_pct_error(F.col("y"), dot + F.element_at("c", -1))).alias("mape"))
    folds = spark.createDataFrame([f[:4] for f in fits], schema)
    return folds.join(scored, "test_month", "left").select(
        "fold", "train_start", "train_end", "test_month", "mape").orderBy("fold")
