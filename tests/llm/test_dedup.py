import random

import pytest
from brute import components as plain_components
from brute import fingerprint, repeats
from fixtures import docs_of, odd  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from quillspark.llm import queries, simhash, suffix
from quillspark.llm.components import components
from quillspark.sources.tables import table


def _check_simhash(rows, got):
    want = [(d, fingerprint(t)) for d, t, _ in rows]
    low = plain_components(want)
    key = lambda r: (str(r[0]), r[1], str(r[2]))
    mine = sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got), key=key)
    assert mine == sorted(((d, f, c) for (d, f), c in zip(want, low)), key=key)


def test_op5_matches_brute_force(spark):
    docs = [(r["doc_id"], r["text"], None) for r in table(spark, SF_CHECK, "documents").collect()]
    got = queries.op5_simhash(spark, SF_CHECK).collect()
    want = [(d, fingerprint(t)) for d, t, _ in docs]
    low = dict(zip((d for d, _ in want), plain_components(want)))
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {d: f"{f:016x}" for d, f in want}
    assert {r["doc_id"]: r["component_id"] for r in got} == low


def test_simhash_odd_rows(spark, docs_of, odd):
    _check_simhash(odd, simhash.near_duplicates(docs_of(odd)).collect())
    assert simhash.near_duplicates(docs_of([])).count() == 0


def test_fingerprints_in_small_chunks(monkeypatch):
    import pyarrow as pa

    from quillspark.llm import words
    texts = ["", None, "a", "É x\ty  z", "q w e r t y", "", "The END the end The End", None]
    monkeypatch.setattr(words.chunks, "__defaults__", (5,))
    got = simhash._fingerprints(pa.array(texts), 3)
    assert [int(x) for x in got] == [fingerprint(t) for t in texts]


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_links_join_all_near_fingerprints(spark, distance):
    rng = random.Random(distance)
    base = [rng.getrandbits(64) for _ in range(12)]
    fps = {b ^ sum(1 << rng.randrange(64) for _ in range(k)) for b in base for k in range(5)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    links = simhash.links(frame, distance)
    assert all(((r["a"] ^ r["b"]) % (1 << 64)).bit_count() <= distance for r in links.collect())
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    want = plain_components([(f, f % (1 << 64)) for f in signed], distance)
    mine = [roots.get(f, f) for f in signed]
    assert len(set(zip(mine, want))) == len(set(mine)) == len(set(want))


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)]
    random.Random(1).shuffle(chain)
    got = components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == {
        **{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(200)}}


def _check_repeats(spark, texts, length=200):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = suffix.remove_repeats(frame, length).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")), F.size("removed"),
        F.sha2("kept", 256)).collect()
    assert [tuple(r)[1:] for r in sorted(got)] == repeats(texts, length)


def test_op9_matches_brute_force(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in table(spark, SF_SMALL, "documents").collect())
    got = sorted(tuple(r) for r in queries.op9_suffix(spark, SF_SMALL).collect())
    assert got == [(d, *r) for (d, _), r in zip(docs, repeats([t for _, t in docs]))]


def test_suffix_planted_overlaps(spark):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdeé \n") for _ in range(n))
    shared, run = word(420), "xy" * 300
    texts = [None, "", "short", word(500), run, shared + word(50), word(70) + shared,
             word(90) + shared[:250] + word(40) + shared[180:], shared[100:299], shared[100:300],
             run[:150], "z" * 199, "z" * 230, shared[:210] + word(10) + shared[190:]]
    for k in range(6):  # near copies with one letter changed
        t = list(shared + texts[3])
        t[60 * k + 30] = "#"
        texts.append("".join(t))
    _check_repeats(spark, texts)
    _check_repeats(spark, texts, 100)


@settings(max_examples=3, deadline=None)
@given(st.integers(0, 10 ** 6))
def test_suffix_random_pastes(spark, seed):
    rng = random.Random(seed)
    pool = "".join(rng.choice("ab c") for _ in range(900))
    texts = ["".join(pool[(a := rng.randrange(700)):a + rng.randrange(20, 300)]
                     for _ in range(rng.randrange(4))) for _ in range(25)]
    _check_repeats(spark, texts, 80)


def test_suffix_long_text_in_segments(spark, monkeypatch):
    rng = random.Random(9)
    monkeypatch.setattr(suffix, "SEGMENT", 1000)
    part = "".join(rng.choice("abcdefgh ") for _ in range(900))
    texts = [part + "".join(rng.choice("abcdefgh ") for _ in range(4000)) + part, part[100:700]]
    from pyspark import cloudpickle  # noqa: F401  the patched module travels by value
    _check_repeats(spark, texts)


def test_suffix_windows_of_repeated_rows_are_listed_once(spark, monkeypatch):
    listed, join = [], suffix._remove

    def remove(texts, spans, keep, length):
        listed.append((spans.count(), [len(r["cuts"]) for r in suffix._lists(spans).collect()]))
        return join(texts, spans, keep, length)

    monkeypatch.setattr(suffix, "_remove", remove)
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefgh ") for _ in range(2000))
    rows = [(7, text)] * 40 + [(None, text[::-1])] * 30 + [(8, text)]
    got = suffix.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 71 and all(r["n_bytes"] == 2000 and not r["kept"] for r in got)
    [(spans, sizes)] = listed
    assert len(sizes) == 3 and max(sizes) <= 1801 and spans >= 30 * max(sizes)


def test_suffix_repeated_rows_and_ids(spark, docs_of, odd):
    rows = odd + [(7, "t" * 300, "a"), (7, "u" * 250, "a"), (None, "v" * 30, "a"), odd[-1]]
    got = suffix.remove_repeats(docs_of(rows)).collect()
    want = repeats([t for _, t, _ in rows])
    key = lambda r: (str(r[0]), r[1], r[2])
    mine = sorted(((r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"])) for r in got), key=key)
    assert mine == sorted(((d, w[0], w[1]) for (d, _, _), w in zip(rows, want)), key=key)
    assert suffix.remove_repeats(docs_of([])).count() == 0
