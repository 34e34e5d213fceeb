import random

from pyspark.sql import functions as F

from quillspark.operators import segmented as seg
from quillspark.operators import windows as win


def _frame(spark):
    rnd = random.Random(9)
    rows = []
    for trade, n, start in (("hot", 300, 1), ("a", 13, 1), ("b", 1, 1), ("suffix", 40, 9), (None, 20, 1)):
        for pos in range(start, start + n):
            v = None if rnd.random() < 0.6 else float(rnd.randint(-5, 50))
            rows.append((trade, pos, float(rnd.randint(1, 99)), v))
    return spark.createDataFrame(rows, "t string, pos int, x double, v double")


def _as_dict(df, cols):
    return {(r["t"], r["pos"]): tuple(r[c] for c in cols) for r in df.collect()}


def test_segmented_equals_plain_windows(spark):
    df = _frame(spark)
    for chunk in (7, 50, 1000):
        a = seg.lags(df, ["t"], "pos", ["x", "v"], [1, 2, 3], chunk_rows=chunk)
        b = win.add_lags(df, ["t"], ["pos"], ["x", "v"], [1, 2, 3])
        cols = [c for c in b.columns if "_lag_" in c]
        assert _as_dict(a, cols) == _as_dict(b, cols)
        a = seg.rolling_mean(df, ["t"], "pos", "x", 4, "r", chunk_rows=chunk)
        b = win.rolling_mean(df, ["t"], ["pos"], "x", 4, "r")
        assert _as_dict(a, ["r"]) == _as_dict(b, ["r"])
        a = seg.cumulative_sum(df, ["t"], "pos", "v", "c", chunk_rows=chunk)
        b = win.cumulative_sum(df, ["t"], ["pos"], "v", "c")
        assert _as_dict(a, ["c"]) == _as_dict(b, ["c"])
        a = seg.forward_fill(df, ["t"], "pos", "v", "f", chunk_rows=chunk)
        b = win.forward_fill(df, ["t"], ["pos"], "v", "f")
        assert _as_dict(a, ["f"]) == _as_dict(b, ["f"])


def test_segmented_spreads_a_hot_entity(spark):
    df = _frame(spark).where(F.col("t") == "hot")
    out = seg.lags(df, ["t"], "pos", ["x"], [1], chunk_rows=25)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_chunk" in plan and out.count() == 300


def test_window_pass_equals_separate_windows_after_prefix_filter(spark):
    df = _frame(spark)
    # ``keep`` is false on a leading run of each entity only.
    df = df.withColumn("keep", F.col("pos") > F.when(F.col("t") == "hot", 40).otherwise(3))
    kept = F.col("keep")
    for chunk in (7, 50, 1000):
        fused = seg.window_pass(df, ["t"], "pos", lag_columns=["x", "v"], lag_values=[1, 2, 3],
                                rolling=[("x", 4, "r", kept)], cumulative=[("x", "c", kept), ("v", "cv", None)],
                                chunk_rows=chunk).where(kept)
        lagged = win.add_lags(df, ["t"], ["pos"], ["x", "v"], [1, 2, 3])
        cv = win.cumulative_sum(lagged, ["t"], ["pos"], "v", "cv").where(kept)
        plain = win.cumulative_sum(win.rolling_mean(cv, ["t"], ["pos"], "x", 4, "r"), ["t"], ["pos"], "x", "c")
        cols = [c for c in plain.columns if "_lag_" in c] + ["r", "c", "cv"]
        assert _as_dict(fused, cols) == _as_dict(plain, cols)


def test_any_positions_and_exclude_current(spark):
    """Gaps, also at chunk edges, and positions of another type."""
    rnd = random.Random(4)
    rows = []
    for trade in ("a", "b", None):
        pos = 0
        for _ in range(60):
            pos += rnd.choice([1, 1, 2, 9, 30])
            rows.append((trade, pos, float(rnd.randint(1, 99)), rnd.choice([None, 2.0, 5.0])))
    df = spark.createDataFrame(rows, "t string, pos int, x double, v double")
    for chunk in (5, 7, 1000):
        got = seg.window_pass(df, ["t"], "pos", lag_columns=["x"], lag_values=[1, 3], chunk_rows=chunk,
                              rolling=[("x", 4, "r", None)], cumulative=[("v", "c", None)])
        want = win.cumulative_sum(win.rolling_mean(win.add_lags(df, ["t"], ["pos"], ["x"], [1, 3]),
                                                   ["t"], ["pos"], "x", 4, "r"), ["t"], ["pos"], "v", "c")
        cols = ["x_lag_1", "x_lag_3", "r", "c"]
        assert got.columns.count("_dense") == 0 and _as_dict(got, cols) == _as_dict(want, cols)
        fill = seg.forward_fill(df, ["t"], "pos", "v", "f", chunk_rows=chunk)
        assert _as_dict(fill, ["f"]) == _as_dict(win.forward_fill(df, ["t"], ["pos"], "v", "f"), ["f"])
    w = win.Window.partitionBy("t").orderBy("pos")
    before = seg.window_pass(df, ["t"], "pos", rolling=[("x", 4, "r", None)], cumulative=[("v", "c", None)],
                             chunk_rows=6, exclude_current=True)
    plain = df.withColumn("r", F.avg("x").over(w.rowsBetween(-4, -1))) \
        .withColumn("c", F.sum("v").over(w.rowsBetween(win.Window.unboundedPreceding, -1)))
    assert _as_dict(before, ["r", "c"]) == _as_dict(plain, ["r", "c"])


def test_range_totals_share_ties(spark):
    rnd = random.Random(4)
    rows = [("hot" if rnd.random() < 0.7 else rnd.choice(["a", None]), rnd.choice([None, *range(40)]),
             rnd.choice([None, *range(9)]), k) for k in range(900)]
    df = spark.createDataFrame(rows + [("late", 1, None, 900), ("late", 2, 5, 901)],
                               "t string, pos int, x long, id int")
    for chunk in (1, 3, 1000):
        got = seg.range_total(df, ["t"], "pos", "x", "c", chunk_rows=chunk)
        want = win.cumulative_sum(df, ["t"], ["pos"], "x", "c")
        assert got.columns == want.columns
        assert sorted(got.select("id", "c").collect()) == sorted(want.select("id", "c").collect())
    assert seg.range_total(df.limit(0), ["t"], "pos", "x").count() == 0
