import hashlib
import re
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from fixtures import docs_of, odd  # noqa: F401
from pyspark.sql import functions as F

from conftest import SF_CHECK
from quillspark.llm import ann, quality, queries, toxicity
from quillspark.llm.labelled import training_rows
from quillspark.sources.tables import table

SF_LARGE = "/root/testdata/sf0.1"
CHECK_LARGE = "/root/testdata/check_l"


def _accuracy(rows: pd.DataFrame, labels: pd.DataFrame, label: str):
    both = rows.merge(labels, on="doc_id")
    held = both[both["held_out"]]
    y, s = held[label].to_numpy(), held["score"].rank().to_numpy()
    ones, zeros = (y == 1).sum(), (y == 0).sum()
    auc = (s[y == 1].sum() - ones * (ones + 1) / 2) / (ones * zeros)
    return held, auc


@pytest.mark.parametrize("query,label,folds,out,least", [
    ("op2_toxicity", "toxic", 3, 1, 0.85), ("op7_quality", "quality", 4, 2, 0.97)])
def test_held_out_ranking(spark, query, label, folds, out, least):
    rows = queries.QUERIES[query](spark, SF_LARGE).toPandas()
    labels = table(spark, SF_LARGE, "labels").toPandas()
    assert len(rows) == table(spark, SF_LARGE, "documents").count()
    want = [zlib.crc32(str(d).encode()) % folds == out for d in rows["doc_id"]]
    assert rows["held_out"].tolist() == want
    assert rows["score"].between(0, 1).all()
    assert (rows["predicted"] == (rows["score"] >= 0.7)).all()
    held, auc = _accuracy(rows, labels, label)
    assert auc >= least
    assert (held["predicted"] == held[label]).mean() >= 0.93


@pytest.mark.parametrize("operator,label", [(toxicity.toxicity, "toxic"), (quality.quality, "quality")])
def test_classifiers_on_odd_rows(spark, docs_of, odd, operator, label):
    labels = spark.createDataFrame(
        [(i, i % 2, i % 2, "x") for i in range(12)] + [(None, 1, 1, "x"), (5, None, None, "x")],
        "doc_id long, quality int, toxic int, text string")
    docs = docs_of(odd)
    rows = operator(docs, labels).collect()
    assert len(rows) == len(odd) and all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (1, 2)}
    assert len(empty) == 1
    assert operator(docs_of([]), labels).count() == 0
    blank = operator(docs, labels.limit(0)).collect()
    assert {r["score"] for r in blank} == {0.5}


def test_an_id_is_learned_once(spark):
    rows = [(7, f"text {i}") for i in range(300)] + [(i, "same") for i in range(20, 40)] * 3
    docs = spark.createDataFrame(rows + [(8, None), (8, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    got = training_rows(docs, labels, "toxic", 3, 3, 100, "toxic").collect()
    assert len(got) == 22 and sum(r["text"] == "same" for r in got) == 20
    least = min((f"text {i}" for i in range(300)), key=lambda t: hashlib.md5(t.encode()).digest())
    assert {r["text"] for r in got} - {None, ""} == {"same", least}


def test_scores_do_not_see_labels_of_the_held_out_fold(spark):
    docs, labels = table(spark, SF_CHECK, "documents"), table(spark, SF_CHECK, "labels")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, labels).collect()}
    b = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, flipped).collect()}
    assert a == pytest.approx(b)


def test_ftrl_learns_and_thins():
    rng = np.random.default_rng(0)
    model = toxicity.Ftrl(50, l1=1.0)
    for _ in range(400):
        noise = rng.choice(np.arange(2, 50), 6, replace=False)
        toxic = int(rng.random() < 0.3)
        model.learn(np.concatenate([[0], [1] if toxic else [], noise]).astype(int), toxic)
    w = model.weights(np.arange(50))
    assert w[0] < 0 < w[1] and w[1] > 3 * np.abs(w[2:]).max() and (w[2:] == 0).any()


def test_learning_holds_a_few_bytes_for_each_coordinate_of_a_row():
    rng = np.random.default_rng(0)
    texts = [" ".join(map(str, rng.integers(0, 300, 400))) for _ in range(1500)]
    part = pa.table({"text": texts, "label": pa.array(rng.integers(0, 2, 1500), pa.int32()),
                     "part": rng.random(1500)})
    held = 1500 * 400 * 3 * 4  # at most: words, pairs, skipped pairs, four bytes each
    tracemalloc.start()
    weights = toxicity._train_part(part)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert weights.column_names == ["i", "w", "n"] and weights["i"][0].as_py() == 0
    assert peak < 3 * held + (40 << 20)  # 40 MB for the weights and a piece of text


def test_a_kept_text_goes_to_the_scoring_tasks_once(spark, capsys):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(12)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, toxic int")
    rows = toxicity.toxicity(docs, labels, keep=("doc_id", "text"))
    rows.explain()
    asked = re.search(r"MapInArrow run\((.*?)\)", capsys.readouterr().out).group(1)
    assert len(re.findall(r"text#", asked)) == 1
    plain = toxicity.toxicity(docs, labels)
    assert sorted(map(tuple, rows.drop("text").collect())) == sorted(map(tuple, plain.collect()))
    assert {(r["doc_id"], r["text"]) for r in rows.collect()} == {(i, f"text {i}") for i in range(12)}


def _nearest(ids, x, q, k):
    d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
    order = [i for i in np.lexsort((ids, d)) if ids[i] != ids[q]][:k]
    return [(int(ids[i]), d[i]) for i in order]


def test_the_graph_of_the_sample_holds_k_numbers_a_row():
    x = np.random.default_rng(0).standard_normal((4096, 8))
    tracemalloc.start()
    near = ann.neighbours(x, 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < len(x) * len(x) * 8 / 2  # half of what all distances take
    far = ((x[:, None] - x[None, ::64]) ** 2).sum(axis=2)
    for i, column in zip(range(0, len(x), 64), far.T):
        column[i] = np.inf
        assert set(near[i]) == set(np.argsort(column)[:10])


def test_op3_recall_and_scores(spark):
    table_ = table(spark, SF_LARGE, "embeddings").toPandas()
    ids, x = table_["vec_id"].to_numpy(), np.stack(table_["embedding"]).astype(np.float64)
    got = queries.op3_neighbours(spark, SF_LARGE).toPandas().sort_values(["query_id", "rank"])
    hits, place = 0, {v: i for i, v in enumerate(ids)}
    asked = np.flatnonzero(ids % 100 == 0)
    assert set(got["query_id"]) == set(ids[asked])
    for q in asked:
        mine = got[got["query_id"] == ids[q]]
        assert mine["rank"].tolist() == list(range(1, 11))
        pairs = list(zip(mine["score"], mine["vec_id"]))
        assert pairs == sorted(pairs)
        for score, v in pairs:
            assert score == pytest.approx(np.sqrt(((x[place[v]] - x[q]) ** 2).sum()), abs=1e-12)
        hits += len({v for v, _ in _nearest(ids, x, q, 10)} & set(mine["vec_id"]))
    assert hits >= 0.9 * 10 * len(asked)


def test_probes_compare_less_than_half_of_a_larger_table(spark):
    frame = table(spark, CHECK_LARGE, "embeddings")
    index = ann.build(frame)
    held = np.array([index.sizes.get(p, 0) for p in range(len(index.model["b"]))])
    rows = index.rows.toPandas()
    assert held.sum() == len(rows) == frame.count()
    x, part, ids = np.stack(rows["v"]).astype(np.float64), rows["part"].to_numpy(), rows["vec_id"]
    asked = np.flatnonzero(ids.to_numpy() % 100 == 0)
    order = np.argsort(-ann.odds(x[asked], index.model), axis=1, kind="stable")[:, :index.probes]
    share = held[order].sum(axis=1).mean() / len(rows)
    hits = 0
    for q, probed in zip(asked, order):
        far = ((x - x[q]) ** 2).sum(axis=1)
        far[q] = np.inf
        hits += np.isin(part[np.argpartition(far, 9)[:10]], probed).sum()
    print(f"parts {len(held)}, probed {index.probes}, rows {share:.3f}, "
          f"recall {hits / 10 / len(asked):.3f}")
    assert hits >= 0.9 * 10 * len(asked)
    assert share < 0.5


def test_repeated_rows_do_not_fill_the_parts(spark):
    rows = [(100, [1.0, 0.0])] * 300 + [(i, [float(i), 1.0]) for i in range(1, 40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = ann.build(frame)
    assert index.rows.count() == 40 and sum(index.sizes.values()) == 40
    got = ann.search(frame).orderBy("rank").collect()
    assert [r["vec_id"] for r in got if r["query_id"] == 100] == list(range(1, 11))


def test_probes_reach_the_recall():
    order = np.array([[0, 1, 2, 3], [3, 2, 1, 0]])
    asked, parts = np.array([0] * 5 + [1] * 5), np.array([0, 0, 0, 0, 1, 3, 3, 3, 3, 0])
    assert ann.probes_for(order, asked, parts, 0.8) == 1
    assert ann.probes_for(order, asked, parts, 0.9) == 2
    assert ann.probes_for(order, asked, parts, 0.95) == 4
    assert ann.probes_for(order, asked[:0], parts[:0], 0.9) == 4


def test_search_on_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(30)]
    rows += [(100 + i, rows[3][1]) for i in range(20)] + [rows[5], rows[5]]
    bad = [(200, None), (201, [0.0] * 8), (202, [float("nan")] * 8), (203, [1.0, None] * 4),
           (204, [float("inf")] + [0.0] * 7), (None, [1.0] * 8), (205, []), (206, [1.0, 2.0]),
           (300, None)]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows + bad],
                                  "vec_id long, embedding array<double>, rank int")
    got = {}
    for r in ann.search(frame, every=10).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    good = dict(rows)
    ids = np.array(sorted(good))
    x = np.array([good[i] for i in ids])
    assert set(got) == {i for i in ids if i % 10 == 0}
    for q in got:
        want = _nearest(ids, x, list(ids).index(q), 10)
        assert [v for v, _ in got[q]] == [v for v, _ in want]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want])
    few = ann.search(spark.createDataFrame([(0, [1.0]), (1, [2.0]), (100, [5.0])],
                                           "vec_id long, embedding array<float>"))
    assert sorted(map(tuple, few.collect())) == [(0, 1, 1, 1.0), (0, 2, 100, 4.0),
                                                 (100, 1, 1, 3.0), (100, 2, 0, 4.0)]
    assert ann.search(frame.limit(0)).count() == 0
    assert ann.search(frame.where("vec_id = 201")).count() == 0


def test_parts_are_balanced_and_local():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((8, 16)) * 6
    x = np.concatenate([c + rng.standard_normal((60, 16)) for c in centres])
    near = ann.neighbours(x, 10)
    part = ann.balanced_parts(near, 8)
    assert np.ptp(np.bincount(part, minlength=8)) <= 1
    assert (part[near] == part[:, None]).mean() > 0.8


def test_frequent_vector_is_ranked_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 16)
    rows = [(i, [1.0, 0.0]) for i in range(90)] + [(100 + i, [1.0, 0.1 * i]) for i in range(20)]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert {r["vec_id"] for r in got if r["query_id"] == 0} == set(range(1, 11))
    assert {r["vec_id"] for r in got if r["query_id"] == 100} == set(range(10))


def test_rank_block_with_sums_that_overflow():
    c = np.array([[1e200, 0.0], [-1e200, 0.0], [1.0, 0.0], [2e199, 3.0]])
    q = np.array([[1e200, 1.0], [1.0, 1.0]])
    with np.errstate(over="ignore", invalid="ignore"):
        asked, found, far = ann.rank_block(np.array([4, 3, 2, 1]), c, np.array([100, 200]), q, 2)
    assert asked.tolist() == [100, 100, 200, 200]
    assert found[:2].tolist() == [4, 1] and far[:2].tolist() == [1.0, np.inf]
    assert found[2:].tolist() == [2, 1] and far[2:].tolist() == [1.0, np.inf]
