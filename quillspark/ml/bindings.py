"""Model queries bound to the driver tables (rows-only checks).

Random forests, boosted trees and walk-forward GLM fits are not
SQL-expressible; the driver checks their row counts and schemas.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.metrics import feature_columns, group_error, regression_metrics
from ..plans import queries as q
from ..session import materialize
from . import models
from .moments import walk_forward_moments

LABEL = "total_orders"
# Weekly-table inputs: everything but keys, the label and same-week class
# totals (the reference trained on lags, distinct counts, market and
# entity attributes).
WEEKLY_INPUTS = (["entity_index", "year", "week_of_year", "avg_weekly_close", "weekly_close_change",
                  "population", "med_income", "max_acctbal", "min_acctbal",
                  "num_segments", "num_statuses", "num_customers", "num_priorities"]
                 + [f"{c}_lag_{k}" for k in (1, 2, 3, 4)
                    for c in ("total_orders", "total_fulfilled", "total_pending")])
# Inputs of the single splits, each with fewer values than a tree has bins.
SPLIT_INPUTS = ["year", "week_of_year", "num_segments", "num_priorities"]
# Columns never used as bar-model inputs.
BAR_EXCLUDED = ("time_stamp", "bar_num", "direction", "trade_id", "id", "month", "profit", "avg_profit")


def _weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(q.weekly_features_frame(spark, sf_dir).withColumn(LABEL, F.col(LABEL).cast("double")))


def _weekly_split(spark: SparkSession, sf_dir: str):
    return models.split(_weekly(spark, sf_dir))


def _key_split(weekly: DataFrame):
    key = F.col("entity").cast("int") * 7 + F.col("year") * 53 + F.col("week_of_year")
    return models.key_split(weekly, key)


def model_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three models over one checkpointed split by key: rows on
    either side, and whether the test error is below that of the train mean."""
    train, test = _key_split(_weekly(spark, sf_dir))
    n_train, mean = train.agg(F.count(F.lit(1)), F.avg(LABEL)).first()
    rows = []
    for name in ("rf", "gbt", "lr"):
        pred = models.fit_pipeline(train, WEEKLY_INPUTS, LABEL, name).transform(test)
        n, error, base = pred.agg(F.count(F.lit(1)), F.sum((F.col(LABEL) - F.col("prediction")) ** 2),
                                  F.sum((F.col(LABEL) - F.lit(mean)) ** 2)).first()
        rows.append((name, n_train, n, error < base))
    return spark.createDataFrame(rows, "model string, n_train long, n_test long, beats_mean boolean")


def linear_one_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least squares of one input, which SQL can check."""
    train, _ = _key_split(_weekly(spark, sf_dir))
    fitted = models.fit_pipeline(train, [f"{LABEL}_lag_1"], LABEL, "lr").stages[-1]
    return spark.createDataFrame(
        [(train.count(), round(float(fitted.coefficients[0]), 6), round(float(fitted.intercept), 6))],
        "n_train long, slope double, intercept double")


def tree_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split and both leaf means of a one-tree forest and of one round
    of boosting over the weekly table, which SQL finds by prefix sums."""
    train, _ = _key_split(_weekly(spark, sf_dir))
    rows = []
    for name in ("rf", "gbt"):
        column, threshold, left, right = models.single_split(train, SPLIT_INPUTS, LABEL, name)
        rows.append((name, column, threshold, round(left, 6), round(right, 6)))
    return spark.createDataFrame(rows, "model string, input string, threshold double, "
                                       "left_mean double, right_mean double")


def _model_metrics(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        train, test = _weekly_split(spark, sf_dir)
        model = models.fit_pipeline(train, WEEKLY_INPUTS, LABEL, name)
        pred = model.transform(test)
        out = regression_metrics(pred, LABEL, "prediction",
                                 subsets={"high_priority": F.col("total_high_priority") > 0})
        return out.select(F.lit(name).alias("model"), "*")
    run.__name__ = f"{name}_metrics"
    return run


def model_group_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L17 on the linear model's test predictions (the reference's choice)."""
    train, test = _weekly_split(spark, sf_dir)
    pred = models.fit_pipeline(train, WEEKLY_INPUTS, LABEL, "lr").transform(test)
    return group_error(pred, LABEL, "prediction", "med_income", bins=5)


def next_week_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random forest trained on the split's training part, applied to
    the synthesised next-week rows."""
    weekly = _weekly(spark, sf_dir)
    train, _ = models.split(weekly)
    model = models.fit_pipeline(train, WEEKLY_INPUTS, LABEL, "rf")
    nxt = q.next_period_of(weekly, q.Tables(spark, sf_dir).orders, "o_orderdate")
    return model.transform(nxt).select("entity", "year", "week_of_year",
                                       F.col("prediction").alias("predicted_total"))


def walk_forward_glm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least squares per walk-forward fold over the bar features,
    from co-moments by month."""
    bars = materialize(q.bar_features_frame(spark, sf_dir))
    inputs = feature_columns(bars.columns, BAR_EXCLUDED)
    return walk_forward_moments(bars, "month", inputs, "profit", 6, 6)


QUERIES = {
    "model_checks": model_checks,
    "linear_one_input": linear_one_input,
    "tree_splits": tree_splits,
    "rf_metrics": _model_metrics("rf"),
    "gbt_metrics": _model_metrics("gbt"),
    "lr_metrics": _model_metrics("lr"),
    "model_group_error": model_group_error,
    "next_week_predictions": next_week_predictions,
    "walk_forward_glm": walk_forward_glm,
}
