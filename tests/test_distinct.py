import random

import pytest
from pyspark.sql import functions as F

from quillspark.operators.distinct import grouped, small_dictionaries


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(3)
    data = [(rnd.choice(["hot", "hot", "b", None]), rnd.choice([None, *"xyz"]), rnd.randint(0, 199),
             rnd.randint(0, 5000), rnd.randint(0, 4000), None, rnd.randint(0, 9)) for _ in range(6000)]
    return spark.createDataFrame(data, "g string, few string, some int, many int, more long, none int, v int")


NAMES = {"n_few": "few", "n_some": "some", "n_many": "many", "n_more": "more", "n_none": "none"}


def test_counts_equal_plain_distinct_counts(rows):
    total = F.sum("v").alias("total")
    want = rows.groupBy("g").agg(total, *[F.count_distinct(c).alias(n) for n, c in NAMES.items()])
    for most in (0, 3, 150, 1024):
        got = grouped(rows, ["g"], [total], NAMES, most=most)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert grouped(rows.limit(0), ["g"], [total], NAMES).count() == 0


def test_dictionaries_and_plan(rows):
    known = small_dictionaries({c: rows for c in ("few", "some", "many", "none")}, 1024)
    assert known["few"] == ["x", "y", "z"] and known["some"] == list(range(200)) and known["none"] == []
    assert "many" not in known
    source = rows.select("few").distinct()
    plan = grouped(rows, ["g"], [F.count(F.lit(1)).alias("n")], NAMES, {"few": source}) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "CartesianProduct" not in plan
