"""Prediction error metrics.

All metrics are single aggregations over the prediction rows, so they run
on the executors and are SQL-checkable; nothing is pulled to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import abs_pct_error, equal_width_bin


def _r(c: Column, digits: int | None) -> Column:
    return F.round(c, digits) if digits is not None else c


def regression_metric_columns(label: str, prediction: str, digits: int | None = None) -> list[Column]:
    """N, RMSE, R^2 (1 - SSE / SST), MAE, MAPE (zero labels skipped)."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    n = F.count(F.lit(1))
    sse = F.sum((y - p) * (y - p))
    sst = F.var_pop(y) * n
    return [n.alias("n"),
            _r(F.sqrt(sse / n), digits).alias("rmse"),
            _r(1 - F.try_divide(sse, sst), digits).alias("r2"),
            _r(F.avg(F.abs(y - p)), digits).alias("mae"),
            _r(F.avg(abs_pct_error(y, p)), digits).alias("mape")]


def regression_metrics(pred: DataFrame, label: str, prediction: str,
                       subsets: dict[str, Column] | None = None,
                       digits: int | None = None) -> DataFrame:
    """Metrics over all rows and over named subsets, one row
    per subset (``subset`` column), from a single scan."""
    subsets = {"all": F.lit(True), **(subsets or {})}
    tagged = pred.select("*", F.explode(F.array(*[
        F.when(cond, F.lit(name)) for name, cond in subsets.items()])).alias("subset")
    ).where(F.col("subset").isNotNull())
    return tagged.groupBy("subset").agg(*regression_metric_columns(label, prediction, digits))


def group_error(pred: DataFrame, label: str, prediction: str, sensitive: str,
                bins: int = 5, digits: int | None = None) -> DataFrame:
    """Mean squared error overall and per equal-width bin of a
    sensitive column (left-closed bins, maximum in the last bin).

    The range comes from one scalar (min, max) aggregate; the bin rows and the overall
    row come from one ``GROUPING SETS ((bin), ())`` pass. ``bin`` is NULL on
    the overall row.
    """
    rng = pred.select(F.struct(F.min(sensitive).alias("lo"), F.max(sensitive).alias("hi"))).scalar()
    lo, hi = rng.getField("lo"), rng.getField("hi")
    binned = pred.select(equal_width_bin(F.col(sensitive), lo, hi, bins).alias("bin"),
                         ((F.col(label) - F.col(prediction)) ** 2).alias("_se"))
    return binned.groupingSets([["bin"], []], "bin").agg(
        _r(F.avg("_se"), digits).alias("mse"), F.count(F.lit(1)).alias("n"))


def feature_columns(columns: Sequence[str], exclude: Sequence[str]) -> list[str]:
    """Every column not in the exclusion set, in frame order."""
    skip = set(exclude)
    return [c for c in columns if c not in skip]
