import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quillspark.ml import bindings, models
from quillspark.plans import queries as q


def test_walk_forward_fits_the_glm_of_every_fold(spark):
    """Each fold against plain least squares; rows with a missing input stay
    out, and a large mean does not hurt."""
    rnd = np.random.default_rng(8)
    rows = []
    for m in range(14):
        for i in range(20):
            x = 1e6 + float(rnd.normal()) * 50
            rows.append((f"2001-{m:02d}", x, float(2 * (x - 1e6) + 500 + rnd.normal())))
        rows.append((f"2001-{m:02d}", None, 100.0))
    df = spark.createDataFrame(rows, "month string, x double, y double")
    got = models.walk_forward(df, "month", ["x"], "y", 6, 6)
    assert [g[:4] for g in got] == [(0, "2001-00", "2001-05", "2001-06"), (1, "2001-06", "2001-11", "2001-12")]
    for fold, lo, hi, test, mape in got:
        tr = np.array([r[1:] for r in rows if lo <= r[0] <= hi and r[1] is not None])
        te = np.array([r[1:] for r in rows if r[0] == test and r[1] is not None])
        slope, base = np.polyfit(tr[:, 0] - 1e6, tr[:, 1], 1)
        want = np.mean(np.abs((te[:, 1] - (slope * (te[:, 0] - 1e6) + base)) / te[:, 1]))
        assert abs(mape - want) < 1e-5


def test_splits_are_stable(spark):
    df = spark.range(200).withColumn("v", F.rand(1))
    a, b = models.split(df)
    again, _ = models.split(df)
    left, right = ({r["id"] for r in x.collect()} for x in (a, b))
    assert left == {r["id"] for r in again.collect()} and len(left) + len(right) == 200
    train, test = models.key_split(df, F.col("id"), 4)
    assert {r["id"] for r in test.collect()} == set(range(0, 200, 4)) and train.count() == 150


def test_linear_model_metrics_against_numpy(spark):
    from pyspark.sql import functions as F

    from quillspark.session import materialize

    wf = materialize(q.weekly_features_frame(spark, SF_SMALL).withColumn(
        "total_orders", F.col("total_orders").cast("double")))
    # Inputs without collinear ones, so that there is one solution to compare.
    inputs = ["entity_index", "week_of_year", "num_customers", "total_orders_lag_1", "total_fulfilled_lag_2"]
    train, test = models.split(wf)
    train, test = materialize(train), materialize(test)
    pred = models.fit_pipeline(train, inputs, "total_orders", "lr").transform(test)
    got = pred.select(F.sqrt(F.avg((F.col("total_orders") - F.col("prediction")) ** 2))).first()[0]
    tr = np.array([[r[c] for c in inputs] + [r["total_orders"]] for r in train.collect()], float)
    te = np.array([[r[c] for c in inputs] + [r["total_orders"]] for r in test.collect()], float)
    X = np.column_stack([np.ones(len(tr)), tr[:, :-1]])
    assert np.linalg.matrix_rank(X) == X.shape[1]
    beta = np.linalg.lstsq(X, tr[:, -1], rcond=None)[0]
    ref = np.sqrt(np.mean((te[:, -1] - np.column_stack([np.ones(len(te)), te[:, :-1]]) @ beta) ** 2))
    assert abs(got - ref) < 1e-6 * max(1.0, ref)
