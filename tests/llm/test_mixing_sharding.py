import duckdb
import pytest
from brute import mix as plain_mix
from fixtures import docs_of, odd  # noqa: F401
from pyspark.sql import functions as F

from conftest import SF_CHECK
from quillspark.llm import mixing, queries, sharding


def test_op1_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_CHECK}/documents.parquet'")
    want = con.sql(queries.ORACLE["op1_mixing"]).df()
    got = queries.op1_mixing(spark, SF_CHECK).toPandas()[list(want.columns)]
    keys = ["doc_id", "size", "taken"]
    want, got = (x.sort_values(keys).reset_index(drop=True) for x in (want, got))
    assert want.equals(got.astype(want.dtypes))
    per = got.groupby("source_size").agg(target=("target", "first"), taken=("taken", "sum"))
    assert ((per["target"] - per["taken"]).between(0, 1)).all()
    assert (got["taken"] <= 3 * got["size"]).all()


def test_mix_on_odd_rows(spark, docs_of, odd):
    got = mixing.mix(docs_of(odd)).select("doc_id", "size", "source_size", "target", "taken").collect()
    want = plain_mix(odd)
    key = lambda r: (str(r[0]), r[1], r[4])
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert g[:3] == w[:3] and g[4] == w[4] and g[3] == pytest.approx(w[3])


def test_mix_of_nothing(spark, docs_of):
    assert mixing.mix(docs_of([])).count() == 0
    only = mixing.mix(docs_of([(1, None, None), (2, "", "a")])).collect()
    assert [r["taken"] for r in only] == [0, 0] and all(r["target"] == 0 for r in only)


def test_positions_follow_the_schedule(spark):
    """Falling, flat and rising sources: half of the demand is met before,
    at and after the middle; the inverse returns the integral's share."""
    rows = spark.range(3).select(F.col("id").alias("rank"), F.lit(0.5).alias("share"))
    at = [r[0] for r in rows.orderBy("rank").select(mixing.position_of(
        F.col("share"), F.lit(1.0), F.col("rank"))).collect()]
    assert at[0] < 0.5 == at[1] < at[2]
    for knots in mixing.SCHEDULES:
        for t in (0.1, 0.4, 0.5, 0.9):
            height = lambda x: next(a + (b - a) * (x - u) / (v - u)
                                    for (u, a), (v, b) in zip(knots, knots[1:]) if x <= v)
            steps = 4000
            area = sum(height((i + 0.5) * t / steps) for i in range(steps)) * t / steps
            got = spark.range(1).select(mixing._demand_time(F.lit(area), knots)).first()[0]
            assert got == pytest.approx(t, abs=1e-6)


def test_passes_repeat_documents(spark, docs_of):
    rows = [(i, "a b c", "big") for i in range(20)] + [(100, "d e", "small")]
    mixed = mixing.mix(docs_of(rows), weights=(1, 2))
    each = mixing.passes(mixed)
    assert each.where("doc_id = 100").count() == 3
    assert mixed.agg(F.sum("copies")).first()[0] == each.count()
    order = [r[0] for r in mixing.in_order(each).select("position").collect()]
    assert order == sorted(order)


def test_difference_beats_greedy_on_the_textbook_case():
    sums, went = sharding.difference([([s, 0], str(s)) for s in (8, 7, 6, 5, 4)], 2)
    assert sorted(sums) == [14, 16]
    back = [0, 0]
    for s, w in zip((8, 7, 6, 5, 4), went):
        back[w[0]] += s
    assert back == sums


@pytest.mark.parametrize("fan_in", [4096, 3])
def test_sharding_holds_groups_and_balance(spark, fan_in):
    groups = spark.range(500).select(F.col("id").cast("string").alias("item"),
                                     ((F.col("id") * 7919) % 1000 + 1).alias("bytes"))
    placed = sharding.pack(groups, 8, fan_in).join(groups, "item").collect()
    assert len(placed) == 500 and len({r["item"] for r in placed}) == 500
    piles = [sum(r["bytes"] for r in placed if r["pile"] == p) for p in range(8)]
    assert max(piles) - min(piles) <= 0.01 * sum(piles) / 8 + 5


def test_op8_on_the_table(spark):
    rows = queries.op8_sharding(spark, SF_CHECK).toPandas()
    assert rows.groupby("text_crc32")["shard"].nunique().max() == 1
    for _, part in rows.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    size = rows.groupby("shard")["size"].sum()
    assert len(size) == 8 and size.max() - size.min() < 0.01 * size.mean()


def test_sharding_odd_rows(spark, docs_of, odd):
    rows = sharding.assign(docs_of(odd)).collect()
    assert len(rows) == len(odd) and sharding.assign(docs_of([])).count() == 0
    by = {}
    for r in rows:
        by.setdefault(r["text_md5"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in by.values())
    assert {r["size"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    for s in range(8):
        mine = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert mine == list(range(len(mine)))


def hot(n=1500):
    """A third of the ids null, a third one repeated row, over some tasks."""
    return [(None if k % 3 == 0 else 7 if k % 3 == 1 else k,
             "same words here" if k % 3 == 1 else "w " * (k % 5), "ab"[k % 2]) for k in range(n)]


def test_mix_with_frequent_ids(spark, docs_of):
    rows = hot()
    docs = docs_of(rows).repartition(6)
    mixed = mixing.mix(docs)
    got = mixed.select("doc_id", "size", "source_size", "taken").collect()
    key = lambda r: (str(r[0]), r[1], r[2], r[3])
    assert sorted(map(tuple, got), key=key) == sorted(((w[0], w[1], w[2], w[4]) for w in plain_mix(rows)),
                                                      key=key)
    # No two rows of a source start at one place, unless the first has no words.
    starts = mixed.where("size > 0").select("source", "start")
    assert starts.count() == starts.distinct().count()


def test_slots_with_frequent_rows(spark, docs_of):
    rows = sharding.assign(docs_of(hot()).repartition(6)).toPandas()
    assert len(rows) == 1500
    for _, mine in rows.groupby("shard"):
        assert sorted(mine["slot"]) == list(range(len(mine)))


def test_repeats_are_numbered_by_task(spark, docs_of):
    """The windows that number rows hold the rows of one task at most."""
    rows = [(7, "same words here", "a")] * 900
    plan = sharding.assign(docs_of(rows).repartition(6))._jdf.queryExecution().optimizedPlan().toString()
    numbering = [line for line in plan.splitlines() if "row_number()" in line and "Window" in line]
    assert numbering and all("task" in line.split("], [")[1] for line in numbering)
