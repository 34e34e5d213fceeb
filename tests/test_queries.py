import pytest

from conftest import SF_SMALL


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert "entity" in df.columns and "total_orders" in df.columns


def test_every_oracle_key_has_a_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    from tools.oracle_check import duck_connection

    return duck_connection(SF_SMALL)


def _oracle_keys():
    import __spark_entry__ as entry

    return sorted(entry.oracle_sql())


@pytest.mark.parametrize("key", _oracle_keys())
def test_query_matches_duckdb(spark, duck, key):
    import __spark_entry__ as entry
    from tools.oracle_check import compare

    assert compare(spark, duck, key, entry.queries()[key], entry.oracle_sql()[key], SF_SMALL, verbose=False)


def test_model_queries_give_sound_rows(spark):
    import __spark_entry__ as entry

    queries = entry.queries()
    for key in set(queries) - set(entry.oracle_sql()):
        if key in ("rf_metrics", "gbt_metrics", "lr_metrics"):
            rows = queries[key](spark, SF_SMALL).collect()
            assert {r["subset"] for r in rows} == {"all", "high_priority"}
            assert all(r["rmse"] >= r["mae"] >= 0 and r["n"] > 0 for r in rows)
    folds = queries["walk_forward_glm"](spark, SF_SMALL).collect()
    assert [r["fold"] for r in folds] == list(range(len(folds))) and folds
    assert all(r["train_start"] < r["train_end"] < r["test_month"] for r in folds)


def test_two_period_pvalue_against_brute_force(spark, duck):
    import math

    import numpy as np

    import __spark_entry__ as entry
    from quillspark.plans import queries as q
    from test_operators import _t_two_sided_p

    (a, b), (c, d) = q.FIRST_PERIOD, q.SECOND_PERIOD
    rows = duck.execute(f"""
        SELECT c.c_nationkey,
               count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '{a}' AND o_orderdate < TIMESTAMP '{b}'),
               count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '{c}' AND o_orderdate < TIMESTAMP '{d}')
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        WHERE (o_orderdate >= TIMESTAMP '{a}' AND o_orderdate < TIMESTAMP '{b}')
           OR (o_orderdate >= TIMESTAMP '{c}' AND o_orderdate < TIMESTAMP '{d}')
        GROUP BY 1""").fetchall()
    x = np.array([r[1] for r in rows], float)
    y = np.array([r[2] for r in rows], float)
    n = len(x)
    t = (x.mean() - y.mean()) / math.sqrt((x.var(ddof=1) + y.var(ddof=1)) / n)
    got = entry.queries()["two_period_pvalue"](spark, SF_SMALL).first()
    assert got["n_keys"] == n and got["dof"] == 2 * n - 2
    assert abs(got["t_stat"] - t) < 1e-6
    assert abs(got["p_value"] - _t_two_sided_p(t, 2 * n - 2)) < 1e-6
