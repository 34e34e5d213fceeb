"""Property tests: exact operators against brute force on random inputs."""

import itertools
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quillspark.operators.pairs import pair_counts
from quillspark.operators.split import balanced_parts, row_position

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 20))),
                min_size=1, max_size=80))
def test_row_position_is_row_number(spark, rows):
    # NULL partition keys form their own group and NULL sort values come
    # first, as in a plain row_number window.
    data = [(k, d, i) for i, (k, d) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, d long, i long")
    got = {r["i"]: r["row_pos"] for r in row_position(df, ["d", "i"], ["k"]).collect()}
    expect = {}
    for k in ("a", "b", None):
        ordered = sorted(((d is not None, d or 0), i) for kk, d, i in data if kk == k)
        for pos, (_, i) in enumerate(ordered):
            expect[i] = pos + 1
    assert got == expect


@SETTINGS
@given(st.integers(1, 60), st.integers(1, 9))
def test_balanced_parts_sizes(spark, total, parts):
    df = spark.range(total).withColumnRenamed("id", "k")
    out = {r["k"]: r["part"] for r in balanced_parts(df, ["k"], parts).collect()}
    q, r = divmod(total, parts)
    sizes = Counter(out.values())
    expect = [q + 1] * r + [q] * (parts - r)
    assert [sizes.get(p, 0) for p in range(1, parts + 1)] == expect
    assert all(out[a] <= out[b] for a, b in zip(range(total), range(1, total)))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 12)), min_size=1, max_size=120),
       st.integers(1, 6))
def test_pair_counts_brute_force(spark, rows, max_items):
    df = spark.createDataFrame(rows, "u long, m long")
    got = {(r["m1"], r["m2"]): r["pair_cnt"] for r in pair_counts(df, "u", "m", max_items=max_items).collect()}
    by_user = defaultdict(list)
    for u, m in rows:
        by_user[u].append(m)
    expect = Counter()
    for items in by_user.values():
        for a, b in itertools.product(items, items):
            if a < b:
                expect[(a, b)] += 1
    assert got == dict(expect)
