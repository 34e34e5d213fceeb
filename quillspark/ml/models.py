"""Model fitting on Spark ML.

Fits are Spark ML estimators: the training passes (tree statistics,
normal equations, IRLS) run on the executors and only model-sized results
reach the driver. The assembled training frame is materialised once
(checkpoint in the shared checkpoint folder) before a series of fits reads
it, so every fit does not re-run the feature joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (GBTRegressor, GeneralizedLinearRegression, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.folds import fold_membership, month_index
from ..operators.metrics import regression_metric_columns
from ..session import materialize

SEED = 1234


def regressor(name: str, features: str = "features", label: str = "label", seed: int = SEED):
    """The estimators of the reference with their default settings
    (a seed fixed for the tree ensembles)."""
    if name == "rf":
        return RandomForestRegressor(featuresCol=features, labelCol=label, seed=seed)
    if name == "gbt":
        return GBTRegressor(featuresCol=features, labelCol=label, seed=seed)
    if name == "lr":
        return LinearRegression(featuresCol=features, labelCol=label)
    if name == "glm":
        return GeneralizedLinearRegression(featuresCol=features, labelCol=label)
    raise ValueError(name)


def fit_pipeline(train: DataFrame, inputs: Sequence[str], label: str, name: str,
                 seed: int = SEED) -> PipelineModel:
    """``VectorAssembler`` + estimator as one pipeline; rows with a
    missing input take no part."""
    assembler = VectorAssembler(inputCols=list(inputs), outputCol="features",
                                handleInvalid="skip")
    return Pipeline(stages=[assembler, regressor(name, label=label, seed=seed)]).fit(train)


def single_split(train: DataFrame, inputs: Sequence[str], label: str, name: str,
                 max_bins: int = 64) -> tuple[str, float, float, float]:
    """L5/L6 in their smallest form, which SQL can check: a forest of one tree of
    depth one without resampling, or one round of boosting. Returns the input
    that is split, the threshold and the means on its left and right. Inputs with
    fewer than ``max_bins`` values have all midpoints between neighbours tried.
    """
    few = {"maxDepth": 1, "maxBins": max_bins, "featureSubsetStrategy": "all", "labelCol": label}
    tree = {"rf": lambda: RandomForestRegressor(numTrees=1, bootstrap=False, **few),
            "gbt": lambda: GBTRegressor(maxIter=1, **few)}[name]()
    assembler = VectorAssembler(inputCols=list(inputs), outputCol="features", handleInvalid="skip")
    root = Pipeline(stages=[assembler, tree]).fit(train).stages[-1].trees[0]._java_obj.rootNode()
    at = root.split()
    return (inputs[at.featureIndex()], float(at.threshold()), float(root.leftChild().prediction()),
            float(root.rightChild().prediction()))


def split(df: DataFrame, train_fraction: float = 0.8, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Seeded random split, as ``randomSplit([0.8, 0.2], seed)``."""
    train, test = df.randomSplit([train_fraction, 1 - train_fraction], seed=seed)
    return train, test


def evaluate(pred: DataFrame, label: str, prediction: str = "prediction",
             subsets: dict | None = None) -> DataFrame:
    """Metric rows per subset of the prediction rows."""
    from ..operators.metrics import regression_metrics

    return regression_metrics(pred, label, prediction, subsets)


def key_split(df: DataFrame, key: Column, folds: int = 5) -> tuple[DataFrame, DataFrame]:
    """Rows whose integer key is divisible by ``folds`` test, the others
    train; the same rows on every run and engine."""
    return df.where(key % folds != 0), df.where(key % folds == 0)


def walk_forward(df: DataFrame, month: str, inputs: Sequence[str], label: str,
                 train: int = 6, step: int = 6, name: str = "glm") -> list[tuple]:
    """Rolling-origin evaluation over calendar months.

    The input is checkpointed once; the fold table comes from
    ``folds.fold_membership`` (array functions per month) and is joined to the
    rows. Each fold is one Spark ML pipeline; rows with a missing input are
    left out of fitting and scoring. The driver sees one row per fold.
    Returns (fold, train_start, train_end, test_month, mape).
    """
    data = materialize(df)
    months = month_index(data, month)
    n_months = months.select(F.count(F.lit(1))).scalar()
    member = fold_membership(months, n_months, train, step).select(month, "fold", "role")
    tagged = data.join(member, month)
    folds = (member.groupBy("fold").agg(
        F.min(F.when(F.col("role") == "train", F.col(month))).alias("train_start"),
        F.max(F.when(F.col("role") == "train", F.col(month))).alias("train_end"),
        F.max(F.when(F.col("role") == "test", F.col(month))).alias("test_month"))
        .orderBy("fold").collect())
    out = []
    for f in folds:
        in_fold = tagged.where(F.col("fold") == f["fold"]).dropna(subset=[label])
        model = fit_pipeline(in_fold.where(F.col("role") == "train"), inputs, label, name)
        p = model.transform(in_fold.where(F.col("role") == "test"))
        mape = p.select(regression_metric_columns(label, "prediction")[-1]).first()[0]
        out.append((int(f["fold"]), f["train_start"], f["train_end"], f["test_month"], mape))
    return out
