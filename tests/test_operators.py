import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from quillspark import session
from quillspark.operators import aggregates as agg
from quillspark.operators import split
from quillspark.operators import windows as win
from quillspark.operators.folds import walk_forward_folds
from quillspark.operators.metrics import group_error, regression_metrics
from quillspark.operators.pairs import pair_counts, recommend
from quillspark.operators.split import balanced_parts, row_position
from quillspark.operators.stats import pair_correlation, pooled_t_test, t_p_value, top_correlations, two_period_summary


def test_avg_of_counts_uses_existing_combinations_only(spark):
    # month 1 exists in two years (3 and 1 rows), month 2 in one year (2 rows)
    df = spark.createDataFrame([(2000, 1)] * 3 + [(2001, 1)] + [(2000, 2)] * 2, "y int, m int")
    out = {r["m"]: r["avg_count"] for r in agg.avg_of_counts(df, ["m"], ["y"]).collect()}
    assert out == {1: 2.0, 2: 2.0}


def test_max_by_key_drops_nan(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("b", None), ("b", 2.0)], "k string, v double")
    assert sorted(map(tuple, agg.max_by_key(df, "k", "v").collect())) == [("a", 1.0), ("b", 2.0)]


def test_rate_by_skips_null_ids_and_flags(spark):
    df = spark.createDataFrame([(1, 1, 1), (1, None, 1), (1, 3, None), (2, 4, 0)], "k int, id int, f int")
    out = {r["k"]: (r["total"], r["flagged"], r["pct"]) for r in agg.rate_by(df, "k", "id", "f").collect()}
    assert out[1] == (2, 2, 100.0) and out[2] == (1, 0, 0.0)


def test_grouping_sets_match_separate_groupings(spark):
    rnd = random.Random(1)
    data = [(rnd.randint(0, 3), rnd.randint(0, 2), rnd.randint(0, 1)) for _ in range(200)]
    df = spark.createDataFrame(data, "a int, b int, f int").withColumn("id", F.monotonically_increasing_id())
    gs = agg.rates_grouping_sets(df, {"a": F.col("a"), "b": F.col("b")}, "id", "f")
    got = {(r["dimension"], r["key"]): (r["total"], r["flagged"]) for r in gs.collect()}
    for dim in ("a", "b"):
        for r in agg.rate_by(df, dim, "id", "f").collect():
            assert got[(dim, r[dim])] == (r["total"], r["flagged"])
    assert len(got) == 4 + 3


def test_latest_per_key(spark):
    df = spark.createDataFrame([("k1", 1, "old"), ("k1", 5, "new"), ("k2", 2, "only")], "k string, o int, v string")
    out = sorted(map(tuple, agg.latest_per_key(df, "k", "o").collect()))
    assert out == [("k1", 5, "new"), ("k2", 2, "only")]


def test_windows_lags_fill_rolling_cumsum(spark):
    df = spark.createDataFrame([("t", i, float(i), None if i % 3 else float(i * 10)) for i in range(1, 8)],
                               "k string, n int, p double, a double")
    out = win.add_lags(df, ["k"], ["n"], ["p"], [1, 2])
    out = win.forward_fill(out, ["k"], ["n"], "a", "a_ff")
    out = win.rolling_mean(out, ["k"], ["n"], "p", 4, "roll")
    out = win.cumulative_sum(out, ["k"], ["n"], "p", "cum")
    r = {x["n"]: x for x in out.collect()}
    assert r[1]["p_lag_1"] is None and r[3]["p_lag_2"] == 1.0
    assert r[1]["a_ff"] is None and r[3]["a_ff"] == 30.0 and r[5]["a_ff"] == 30.0 and r[6]["a_ff"] == 60.0
    assert r[2]["roll"] == 1.5 and r[5]["roll"] == 3.5
    assert r[7]["cum"] == 28.0


def test_cumulative_sum_range_frame_shares_ties(spark):
    df = spark.createDataFrame([("t", 1, 1.0), ("t", 2, 2.0), ("t", 2, 3.0)], "k string, n int, p double")
    out = sorted(r["c"] for r in win.cumulative_sum(df, ["k"], ["n"], "p", "c").collect())
    assert out == [1.0, 6.0, 6.0]


def test_carry_previous_block(spark):
    rows = [("a", n, float(n)) for n in range(1, 26)]
    df = spark.createDataFrame(rows, "trade string, bar int, profit double")
    out = {r["bar"]: r["avg_profit"] for r in
           win.carry_previous_block(df, "trade", "bar", "profit", 10).collect()}
    assert out[10] is None and out[11] == 10.0 and out[20] == 10.0 and out[21] == 20.0


def _brute_pairs(data):
    by_user = defaultdict(list)
    for u, m in data:
        by_user[u].append(m)
    c = Counter()
    for items in by_user.values():
        for a, b in itertools.product(items, items):
            if a < b:
                c[(a, b)] += 1
    return c


def test_pair_counts_with_hot_user_salting(spark):
    rnd = random.Random(7)
    data = [(0, rnd.randint(0, 40)) for _ in range(300)]            # one hot user
    data += [(u, rnd.randint(0, 40)) for u in range(1, 40) for _ in range(rnd.randint(1, 6))]
    data += [(5, 3), (5, 3), (5, 4)]                                 # duplicates multiply
    df = spark.createDataFrame(data, "u long, m long")
    got = {(r["m1"], r["m2"]): r["pair_cnt"] for r in pair_counts(df, "u", "m", max_items=25).collect()}
    assert got == dict(_brute_pairs(data))


def test_pair_counts_are_dealt_to_as_many_tasks_as_their_rows_need(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 50)
    data = [(u, m) for u in range(30) for m in range(u % 5, 12)] + [(None, 1), (3, None)]
    got = pair_counts(spark.createDataFrame(data, "u long, m long"), "u", "m", max_items=5) \
        .withColumn("task", F.spark_partition_id()).collect()
    assert {(r["m1"], r["m2"]): r["pair_cnt"] for r in got} == dict(_brute_pairs(data[:-2]))
    assert len({r["task"] for r in got}) > 8  # more than the shuffle partitions of the session


def test_row_positions_are_sorted_in_as_many_tasks_as_their_rows_need(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 50)
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    got = row_position(df, ["k"]).withColumn("task", F.spark_partition_id()).collect()
    assert sorted((r["k"], r["row_pos"]) for r in got) == [(i, i + 1) for i in range(1000)]
    assert len({r["task"] for r in got}) > 8
    lines = df.select((F.col("k") % 3).alias("source_no"), "k")
    got = row_position(lines, ["k"], ["source_no"], out="n", total="of").collect()
    assert {(r["source_no"], r["k"], r["n"], r["of"]) for r in got} == \
        {(k % 3, k, k // 3 + 1, 334 if k % 3 == 0 else 333) for k in range(1000)}


def test_row_positions_come_back_without_gathering_the_rows_of_a_key(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 50)
    lines = spark.range(1000).select((F.col("id") % 3).alias("source_no"),
                                     (F.col("id") * 7919 % 1000).alias("k"))
    lines = lines.withColumn("source_no", F.when(F.col("source_no") > 0, F.col("source_no")))
    sides = {}
    for r in lines.collect():
        sides.setdefault(r["source_no"], []).append(r["k"])
    want = {(s, k, i, len(ks)) for s, ks in sides.items() for i, k in enumerate(sorted(ks), 1)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for few in (split.FEW_KEYS, 0):
            monkeypatch.setattr(split, "FEW_KEYS", few)
            got = row_position(lines, ["k"], ["source_no"], out="n", total="of") \
                .withColumn("task", F.spark_partition_id()).collect()
            assert {(r["source_no"], r["k"], r["n"], r["of"]) for r in got} == want
            tasks = [r["task"] for r in got]
            assert max(map(tasks.count, tasks)) < 300  # a key has 333 rows or more
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_recommend_matches_pair_table(spark):
    rnd = random.Random(3)
    data = [(u, rnd.randint(0, 30), rnd.randint(1, 5)) for u in range(30) for _ in range(rnd.randint(1, 12))]
    df = spark.createDataFrame(data, "u long, m long, r int")
    liked = [(u, m) for u, m, r in data if r > 3]
    pairs = _brute_pairs(liked)
    target = 20
    expect = {a: c for (a, b), c in pairs.items() if b == target}
    got = {r[0]: r[1] for r in recommend(df, "u", "m", target, liked=F.col("r") > 3, k=None).collect()}
    assert got == expect
    sym = Counter()
    for (a, b), c in pairs.items():
        if b == target:
            sym[a] += c
        if a == target:
            sym[b] += c
    got = {r[0]: r[1] for r in recommend(df, "u", "m", target, liked=F.col("r") > 3, k=None,
                                         symmetric=True).collect()}
    assert got == dict(sym)
    top = recommend(df, "u", "m", target, liked=F.col("r") > 3, k=3).collect()
    assert [r[1] for r in top] == sorted(expect.values(), reverse=True)[:3]


def test_pair_correlation_matches_numpy_across_blocks(spark):
    rnd = np.random.default_rng(11)
    ents, periods = list(range(23)), list(range(2000, 2007))
    rows = []
    for e in ents:
        for p in periods:
            if rnd.random() < 0.8:
                rows.append((e, p, int(rnd.integers(0, 50))))
    rows += [(99, p, 5) for p in periods]                            # constant entity -> dropped
    df = spark.createDataFrame(rows, "e int, p int, n long")
    got = {(r["entity_a"], r["entity_b"]): r["corr"] for r in
           pair_correlation(df, "e", "p", "n", block_size=4).collect()}
    grid = np.zeros((len(ents), len(periods)))
    for e, p, n in rows:
        if e != 99:
            grid[e, p - 2000] = n
    live = [e for e in ents if grid[e].std() > 0]
    assert len(got) == len(live) * (len(live) - 1) // 2
    c = np.corrcoef(grid)
    for (a, b), v in got.items():
        assert abs(v - c[a, b]) < 1e-9


def _t_two_sided_p(t, dof):
    # Regularised incomplete beta by continued fraction (test-only reference).
    x = dof / (dof + t * t)
    a, b = dof / 2.0, 0.5

    def cf(a, b, x):
        qab, qap, qam = a + b, a + 1, a - 1
        c, d = 1.0, 1 - qab * x / qap
        d = 1 / d
        h = d
        for m in range(1, 300):
            m2 = 2 * m
            aa = m * (b - m) * x / ((qam + m2) * (a + m2))
            d = 1 / (1 + aa * d)
            c = 1 + aa / c
            h *= d * c
            aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
            d = 1 / (1 + aa * d)
            c = 1 + aa / c
            h *= d * c
        return h
    bt = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x))
    return bt * cf(a, b, x) / a


def test_two_period_summary_and_pvalue(spark):
    rnd = random.Random(5)
    data = [(k, rnd.randint(50, 90), rnd.randint(40, 80)) for k in range(30)]
    df = spark.createDataFrame(data, "k int, n_first long, n_second long")
    s = two_period_summary(df).first()
    a = np.array([d[1] for d in data], float)
    b = np.array([d[2] for d in data], float)
    assert abs(s["sd_first"] - a.std()) < 1e-9 and s["dof"] == 58
    sp = ((len(a) - 1) * a.var(ddof=1) + (len(b) - 1) * b.var(ddof=1)) / (len(a) + len(b) - 2)
    t = (a.mean() - b.mean()) / math.sqrt(sp * (2 / len(a)))
    assert abs(s["t_stat"] - t) < 1e-9
    res = pooled_t_test(df).first()
    assert abs(res["t_stat"] - t) < 1e-9 and res["dof"] == 58
    assert abs(res["p_value"] - _t_two_sided_p(t, 58)) < 1e-9


def test_golden_pvalue_from_published_moments(spark):
    # Published run: 116 keys, means and population sds per period, p-value.
    # Half of the keys one deviation above the mean, half one below, have
    # just these moments.
    (m1, sd1), (m2, sd2) = (39394.15517241379, 65020.151918542935), (19927.543103448275, 24194.618659083822)
    rows = [(i, m1 + (sd1 if i % 2 else -sd1), m2 + (sd2 if i % 2 else -sd2)) for i in range(116)]
    res = pooled_t_test(spark.createDataFrame(rows, "k int, n_first double, n_second double")).first()
    assert res["dof"] == 230 and abs(res["p_value"] - 0.002912385408589375) < 1e-9


def test_row_position_of_other_types_and_zones(spark):
    import datetime as dt
    names = [None, "b", "a", "é", "a", "Z", ""]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "n string, i int")
    got = {r["i"]: r["p"] for r in row_position(df, ["n", "i"], out="p").collect()}
    want = sorted(range(7), key=lambda i: (names[i] is not None, (names[i] or "").encode(), i))
    assert got == {i: k + 1 for k, i in enumerate(want)}
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # zone-less times around the hour that the zone skips
        start = dt.datetime(2001, 4, 1, 0, 30)
        rows = [(i, start + dt.timedelta(minutes=10 * i)) for i in range(24)]
        df = spark.createDataFrame([(i, str(t)) for i, t in rows], "i int, s string") \
            .select("i", F.col("s").cast("timestamp_ntz").alias("t"))
        got = {r["i"]: r["p"] for r in row_position(df, ["t"], out="p").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == {i: i + 1 for i, _ in rows}


def test_next_period_follows_the_newest_date(spark):
    from quillspark.plans.queries import next_period_of
    weekly = spark.createDataFrame([("e", y, w, 10 * y + w) for y in range(1997, 2010) for w in range(1, 54)],
                                   "entity string, year int, week_of_year int, v int")
    for newest, target in (("2000-06-30", (2000, 27)), ("2000-01-01", (2000, 1)), ("2004-12-20", (2004, 53)),
                           ("2009-12-31", (2010, 1)), ("2005-01-01", (2005, 1))):
        dates = spark.createDataFrame([(newest,), ("1998-02-03",), ("2000-01-01" if newest > "2000" else newest,)],
                                      "d string").select(F.col("d").cast("timestamp_ntz").alias("d"))
        got = [tuple(r) for r in next_period_of(weekly, dates, "d").collect()]
        year, week = target
        assert got == [("e", year, week, 10 * (year - 1) + week)]


def test_row_position_equals_row_number(spark):
    rnd = random.Random(2)
    data = [(rnd.choice("ab"), rnd.randint(0, 50), i) for i in range(500)]
    data += [("hot", rnd.randint(0, 1000), 500 + i) for i in range(2000)]
    df = spark.createDataFrame(data, "k string, d long, i long")
    got = {r["i"]: r["row_pos"] for r in row_position(df, ["d", "i"], ["k"]).collect()}
    expect = {}
    for k in ("a", "b", "hot"):
        ordered = sorted((d, i) for kk, d, i in data if kk == k)
        expect.update({i: pos + 1 for pos, (_, i) in enumerate(ordered)})
    assert got == expect


def test_balanced_parts_follow_ntile(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    sizes = sorted((r[0], r[1]) for r in balanced_parts(df, ["k"], 4).groupBy("part").count().collect())
    assert sizes == [(1, 3), (2, 3), (3, 2), (4, 2)]


def test_walk_forward_folds_match_reference_loop(spark):
    months = [f"{2000 + i // 12}-{i % 12 + 1:02d}" for i in range(20)]
    data = [(m,) for j, m in enumerate(months) for _ in range(j + 1)]
    df = spark.createDataFrame(data, "month string")
    got = sorted(tuple(r) for r in walk_forward_folds(df, "month").collect())
    expect = []
    for f, start in enumerate(range(0, len(months) - 7, 6)):
        tr = months[start:start + 6]
        n_tr = sum(range(start + 1, start + 7))
        expect.append((f, tr[0], tr[-1], months[start + 6], n_tr, start + 7))
    assert got == expect


def test_regression_metrics_and_group_error(spark):
    rnd = np.random.default_rng(4)
    y = rnd.integers(0, 10, 200).astype(float)
    p = y + rnd.normal(0, 1, 200)
    s = rnd.uniform(0, 100, 200)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in zip(y, p, s)], "y double, p double, s double")
    m = {r["subset"]: r for r in regression_metrics(df, "y", "p", {"pos": F.col("y") > 0}).collect()}
    assert abs(m["all"]["rmse"] - math.sqrt(np.mean((y - p) ** 2))) < 1e-9
    assert abs(m["all"]["r2"] - (1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2))) < 1e-9
    nz = y != 0
    assert abs(m["all"]["mape"] - np.mean(np.abs((y[nz] - p[nz]) / y[nz]))) < 1e-9
    assert m["pos"]["n"] == int(nz.sum())
    ge = {r["bin"]: r["mse"] for r in group_error(df, "y", "p", "s", 5).collect()}
    edges = np.linspace(s.min(), s.max(), 6)
    bins = np.minimum(np.floor((s - s.min()) / ((s.max() - s.min()) / 5)), 4)
    for b in range(5):
        sel = bins == b
        assert abs(ge[b] - np.mean((y[sel] - p[sel]) ** 2)) < 1e-9
    assert abs(ge[None] - np.mean((y - p) ** 2)) < 1e-9 and len(edges) == 6


def test_weekly_features_options(spark):
    import datetime as dt

    from quillspark.operators.features import weekly_features, weekly_market

    days = [dt.datetime(2020, 1, 6) + dt.timedelta(days=d) for d in range(0, 35)]
    facts = spark.createDataFrame(
        [(f"{e:04d}", t, c, s, f"cust{(i * 7) % 5}") for i, (e, t) in enumerate((e, t) for e in range(3) for t in days)
         for c, s in [("A" if i % 3 else "B", "F" if i % 2 else "O")]],
        "entity string, ts timestamp, cls string, status string, cust string")
    market = weekly_market(spark.createDataFrame([(t, 10.0 + i) for i, t in enumerate(days)], "ts timestamp, v double"),
                           "ts", "v", decimals=2).select("year", "week_of_year", "avg_weekly_close", "weekly_close_change")
    demo = spark.createDataFrame([(f"{e:04d}", float(e)) for e in range(3)], "key string, attr double")
    args = dict(entity="entity", ts="ts", class_flags={"n_a": (F.col("cls") == "A").cast("int"),
                                                       "n_b": (F.col("cls") == "B").cast("int")},
                flag_sums={"n_f": (F.col("status") == "F").cast("int")}, distincts={"n_cust": "cust"},
                demo_key="key", lag_columns=("total",), lags=(1,))
    exact = {(r["entity"], r["week_of_year"]): r for r in weekly_features(facts, market, demo, **args).collect()}
    approx = {(r["entity"], r["week_of_year"]): r for r in
              weekly_features(facts, market, demo, approx_distinct=True, **args).collect()}
    assert exact.keys() == approx.keys() and len(exact) == 3 * 5
    assert all(exact[k]["n_cust"] == approx[k]["n_cust"] for k in exact)        # tiny sets: HLL is exact
    only_a = weekly_features(facts, market, demo, fact_filter=F.col("cls") == "A", **args).collect()
    assert all(r["n_b"] == 0 and r["total"] == 0 for r in only_a)             # NULL class total -> total 0


def test_frequency_index_ranged_equals_window(spark):
    from quillspark.operators.features import frequency_index

    rnd = random.Random(12)
    rows = [(f"k{rnd.randint(0, 60):02d}",) for _ in range(800)]
    df = spark.createDataFrame(rows, "k string")
    a = {r["k"]: r["kIndex"] for r in frequency_index(df, "k").select("k", "kIndex").distinct().collect()}
    b = {r["k"]: r["kIndex"] for r in frequency_index(df, "k", ranged=True).select("k", "kIndex").distinct().collect()}
    assert a == b and sorted(a.values()) == [float(i) for i in range(len(a))]


def test_t_p_value_at_odd_and_even_degrees_of_freedom(spark):
    # Known quantiles: the two-sided 5 % and 1 % points, and far tails.
    rows = [(12.706204736, 1, 0.05), (4.302652730, 2, 0.05), (2.570581836, 5, 0.05), (2.228138852, 10, 0.05),
            (3.169272673, 10, 0.01), (1.983971519, 100, 0.05), (1.960201264, 10000, 0.05), (0.0, 7, 1.0), (-2.570581836, 5, 0.05)]
    df = spark.createDataFrame(rows, "t double, dof long, p double")
    for r in df.withColumn("got", t_p_value(F.col("t"), F.col("dof"))).collect():
        assert abs(r["got"] - r["p"]) < 1e-8, r
    wide = spark.createDataFrame([(t / 4, d) for t in range(1, 40) for d in (1, 2, 3, 8, 57, 230)],
                                 "t double, dof long")
    for r in wide.withColumn("got", t_p_value(F.col("t"), F.col("dof"))).collect():
        assert abs(r["got"] - _t_two_sided_p(r["t"], r["dof"])) < 1e-7, r


def test_top_correlations_prunes_and_equals_all_pairs(spark):
    """Families of like series and noise: the same rows as from all pairs, and
    only a small part of the pairs computed."""
    import quillspark.operators.stats as stats

    rnd, rows = np.random.default_rng(4), []
    for e in range(1500):
        base = np.random.default_rng(e % 50).normal(size=24) * 20
        for p, v in enumerate(base + rnd.normal(size=24) * (1 + e % 7)):
            rows.append((e, p, float(v)))
    df = spark.createDataFrame(rows, "e int, p int, n double")
    x = np.array([r[2] for r in rows]).reshape(1500, 24)
    c = np.corrcoef(x)
    i, j = np.triu_indices(1500, 1)
    order = np.lexsort((j, i, -np.round(c[i, j], 6)))[:10]
    want = [(int(i[k]), int(j[k]), round(float(c[i[k], j[k]]), 6)) for k in order]
    made, inner = [], stats._met

    def counted(*args):
        out = inner(*args)
        made.append(out.count())
        return out

    stats._met = counted
    try:
        got = [tuple(r) for r in top_correlations(df, "e", "p", "n", 10).collect()]
    finally:
        stats._met = inner
    assert sorted(got) == sorted(want)
    assert sum(made) < 0.02 * len(i), sum(made)


def test_top_correlations_of_few_and_tied_entities(spark):
    rows = [(e, p, float((p * 7 + (e % 2) * p * p) % 5)) for e in range(6) for p in range(5)]
    df = spark.createDataFrame(rows, "e int, p int, n double")
    got = [tuple(r) for r in top_correlations(df, "e", "p", "n", 10).collect()]
    want = sorted([(r["entity_a"], r["entity_b"], round(r["corr"], 6)) for r in
                   pair_correlation(df, "e", "p", "n").collect()], key=lambda r: (-r[2], r[0], r[1]))[:10]
    assert sorted(got) == sorted(want)
    assert top_correlations(df.limit(0), "e", "p", "n", 10).count() == 0
