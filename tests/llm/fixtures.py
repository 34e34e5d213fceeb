import pytest

MAIN = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs_of(spark):
    """Documents table from (doc_id, text, source) rows, with columns whose
    names clash with those used inside."""
    def make(rows):
        full = [(d, t, "en", s, len(t or ""), "x", 1, 2.0, 3, "y") for d, t, s in rows]
        return spark.createDataFrame(full, MAIN + ", size string, key int, score double, "
                                     "shard int, digest string")
    return make


ODD = [(1, None, "a"), (2, "", "a"), (None, "one two", None), (3, "One  two\n", "b"),
       (4, "x", "b"), (4, "x", "b"), (5, "the quick brown fox jumps over it", "b"),
       (6, "the quick brown fox jumps over it", ""), (7, "w%d " * 3 + "z" * 5000, "c"),
       (8, " ".join(f"w{i}" for i in range(30000)), "c")]


@pytest.fixture()
def odd():
    return list(ODD)
