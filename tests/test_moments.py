import numpy as np

from quillspark.ml import models
from quillspark.ml.moments import walk_forward_moments


def _rows(seed=8, months=14):
    rnd, rows = np.random.default_rng(seed), []
    for m in range(months):
        for _ in range(30):
            x, z = 1e6 + float(rnd.normal()) * 50, float(rnd.normal())
            rows.append((f"2001-{m:02d}", x, z, float(2 * (x - 1e6) + 3 * z + 500 + rnd.normal())))
        rows.append((f"2001-{m:02d}", None, 1.0, 100.0))
        rows.append((f"2001-{m:02d}", 1e6, float("nan"), 100.0))
    return rows


SCHEMA = "month string, x double, z double, y double"


def test_folds_equal_least_squares_on_large_means_and_missing_inputs(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r) for r in walk_forward_moments(df, "month", ["x", "z"], "y", 6, 6).collect())
    assert [g[:4] for g in got] == [(0, "2001-00", "2001-05", "2001-06"), (1, "2001-06", "2001-11", "2001-12")]
    for _, lo, hi, test, mape in got:
        whole = [r for r in rows if r[1] is not None and r[2] == r[2]]
        tr = np.array([r[1:] for r in whole if lo <= r[0] <= hi])
        te = np.array([r[1:] for r in whole if r[0] == test])
        design = np.column_stack([tr[:, 0] - 1e6, tr[:, 1], np.ones(len(tr))])
        beta = np.linalg.lstsq(design, tr[:, 2], rcond=None)[0]
        fit = np.column_stack([te[:, 0] - 1e6, te[:, 1], np.ones(len(te))]) @ beta
        assert abs(mape - np.mean(np.abs((te[:, 2] - fit) / te[:, 2]))) < 1e-8


def test_folds_equal_the_glm_of_spark_ml(spark):
    rows = [(m, x - 1e6, z, y) for m, x, z, y in _rows(3) if x is not None and z == z]
    df = spark.createDataFrame(rows, SCHEMA)
    glm = models.walk_forward(df, "month", ["x", "z"], "y", 6, 6)
    got = sorted(tuple(r) for r in walk_forward_moments(df, "month", ["x", "z"], "y", 6, 6).collect())
    for a, b in zip(glm, got, strict=True):
        assert a[:4] == b[:4] and abs(a[4] - b[4]) < 1e-8


def test_constant_and_collinear_inputs_empty_months_and_empty_tables(spark):
    rows = [(f"2001-{m:02d}", float(i), 4.0, 2.0 * i + 7) for m in range(9) for i in range(1, 9) if m != 2]
    rows += [("2001-02", None, 4.0, 1.0), (None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("month", "x", "z", "2 * x AS twice", "y")
    got = walk_forward_moments(df, "month", ["x", "z", "twice"], "y", 6, 6).collect()
    assert len(got) == 1 and got[0]["mape"] < 1e-9
    assert walk_forward_moments(df.limit(0), "month", ["x"], "y").count() == 0
