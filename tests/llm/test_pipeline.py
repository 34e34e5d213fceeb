from brute import components, contamination, fingerprint, mix
from fixtures import docs_of, odd  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline as cp
from conftest import SF_CHECK
from quillspark.llm import toxicity
from quillspark.sources.tables import table


def test_stages_against_plain_versions(spark):
    docs = table(spark, SF_CHECK, "documents")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    scored = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(
        docs, table(spark, SF_CHECK, "labels")).collect()}
    rows = [r for r in rows if not scored[r[0]]]
    low = components([(d, fingerprint(t)) for d, t, _ in rows])
    rows = [r for r, c in zip(rows, low) if r[0] == c]
    items = {r["item_id"]: r["text"] for r in table(spark, SF_CHECK, "benchmark").collect()}
    leaks = {d for d, _ in contamination({d: t for d, t, _ in rows}, items)}
    rows = [r for r in rows if r[0] not in leaks]
    words = {}
    for (d, t, _), (_, size, _, _, taken) in zip(rows, mix(rows)):
        words[d] = -(-taken // size) if size else 0
    got = cp.run(spark, SF_CHECK)
    assert got.columns == [*cp.COLUMNS, "shard", "slot"]
    copies = {r["doc_id"]: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert copies.keys() == {d for d, n in words.items() if n}
    # A cut within one pass and whole passes give at most one more than needed.
    assert all(words[d] <= n <= 3 for d, n in copies.items())
    sizes = got.groupBy("shard").agg(F.sum(F.octet_length("text") + 1).alias("b"),
                                     F.count("*").alias("n"), F.max("slot").alias("top")).collect()
    assert len(sizes) == 8 and all(r["top"] == r["n"] - 1 for r in sizes)
    assert max(r["b"] for r in sizes) - min(r["b"] for r in sizes) < 0.02 * sizes[0]["b"]
    assert got.groupBy("text").agg(F.count_distinct("shard").alias("n")).where("n > 1").count() == 0


def test_stages_on_odd_rows(spark, docs_of, odd):
    docs = docs_of(odd + [(None, "one two", None), (None, "another text with no id", "q")])
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF_CHECK)
        assert out.columns[:5] == list(cp.COLUMNS)
        assert stage(spark, docs.limit(0), SF_CHECK).count() == 0
        if name == "near_duplicates":
            ids = sorted(str(r["doc_id"]) for r in out.collect())
            # 1 and 2 are empty, 4 is a repeated row, 5 and 6 agree, null ids differ in text
            assert ids == ["1", "3", "4", "5", "7", "8", "None"]
        if name in ("toxicity", "decontamination", "sharding"):
            assert out.count() == len(odd) + 2
