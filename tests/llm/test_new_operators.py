"""op11 to op13 against plain computations on small and odd tables."""

import collections
import itertools
import math
import random
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quillspark.llm import alignment, jaccard, lexical
from quillspark.llm.queries import TOKENIZERS
from quillspark.sources.tables import table

MODELS = [Path(TOKENIZERS, name).read_bytes() for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
ODD = [(1, None), (2, ""), (3, " "), (4, "one"), (4, "one"), (None, "one two three four five six"), (None, None),
       (7, "tab\tand\nnew line  two  blanks   three "), (8, "▁ bar U+2581"), (9, "Ünïcode ﬁne 漢字 🙂 é"),
       (10, "<|endoftext|> <s> </s> <0x41>"), (11, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 40),
       (12, "\x00\x01 nul"), (13, "word " * 30000), (14, "x" * 5000), (15, "   "), (16, "🙂" * 300),
       (17, " leading and trailing "), (18, "1234567890 3.14 !!! ...,,,;;;")]


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string") \
        .select("*", *[F.lit("x").alias(c) for c in ("n", "token", "uid", "cid", "pair", "shard", "item")])


# ---------------------------------------------------------------- op11
def _plain_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_str(MODELS[0].decode())
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=MODELS[1])
    a_bytes = {i: t for t, i in alignment.byte_level(MODELS[0]).items()}

    def b_bytes(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    groups = []
    for _, text in rows:
        found = []
        x = a.encode(" " + (text or ""), add_special_tokens=False).ids
        y = b.encode(text or "")
        raw = (" " + (text or "")).encode()
        if text and b"".join(a_bytes[i] for i in x) == raw and b"".join(map(b_bytes, y)) == raw:
            ends_a = list(itertools.accumulate(len(a_bytes[i]) for i in x))
            ends_b = list(itertools.accumulate(len(b_bytes(i)) for i in y))
            i = j = 0
            for end in sorted(set(ends_a) & set(ends_b)):
                k, m = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
                found.append((x[i:k], y[j:m]))
                i, j = k, m
        groups.append(found)
    counts = collections.Counter(p for g in groups for p in {(s, t) for x, y in g for s in x for t in y})
    best = collections.defaultdict(int)
    for (s, _), n in counts.items():
        best[s] = max(best[s], n)
    out = []
    for (doc, _), g in zip(rows, groups):
        n_links = sum(len(x) * len(y) for x, y in g)
        links = [(counts[s, t], best[s]) for x, y in g for s in x for t in y] if n_links < 10 ** 7 else None
        out.append((doc, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), n_links,
                    links and sum(c == m for c, m in links) or 0, links and sum(c for c, _ in links) or 0,
                    ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)))
    return out


@pytest.mark.parametrize("shard, rounds", [(1 << 16, 32), (64, 3)])
def test_alignment_equals_plain_on_odd_texts(spark, monkeypatch, shard, rounds):
    """Also with many small shards, tree sums and several look-up rounds."""
    monkeypatch.setattr(alignment, "PER_SHARD", shard)
    monkeypatch.setattr(alignment, "ROUND", rounds)
    if shard == 64:
        monkeypatch.setattr(alignment, "PER_VECTOR", 16)
        monkeypatch.setattr(alignment, "FAN_IN", 2)
    got = alignment.align(_docs(spark, ODD).repartition(3), *MODELS, keep=("token",))
    assert {r["token"] for r in got.collect()} == {"x"}
    rows = [tuple(r) for r in got.drop("token").collect()]
    assert sorted(rows, key=str) == sorted(_plain_alignment(ODD), key=str)
    assert alignment.align(_docs(spark, ODD).limit(0), *MODELS).count() == 0


def test_texts_with_blanks_at_their_end_keep_their_tokens():
    """Around the places where a text is cut for the second tokenizer."""
    tok = alignment.Tokenizers(*MODELS)
    texts = ["x" * n + " " * blanks for n in (1, *range(95, 206)) for blanks in range(4)]
    texts += ["some words and a line \n" * 20, "some words " * 20, "é 漢 " * 40]
    ids, n_a, _, n_b = tok.encode(texts)
    assert (n_a > 0).all() and n_b.tolist() == [len(tok.b.encode(t)) for t in texts]
    assert b"".join(tok.a_bytes[i] for i in ids) == b"".join((" " + t).encode() for t in texts)


def test_alignment_equals_plain_on_documents(spark):
    rows = [tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    got = [tuple(r) for r in alignment.align(table(spark, SF_SMALL, "documents"), *MODELS).collect()]
    assert sorted(got) == sorted(_plain_alignment(rows))


def test_groups_of_very_many_links_are_linked_by_distinct_ids(monkeypatch):
    tok = alignment.Tokenizers(*MODELS)
    texts = ["🙂" * 50 + " some words " + "漢字" * 40, "", "plain text"]

    def total():
        found = collections.Counter()
        for text, pair, often in alignment.Aligned(tok, *tok.encode(texts)).links():
            for t, p, n in zip(text.tolist(), pair.tolist(), often.tolist()):
                found[t, p] += n
        return found

    plain = total()
    monkeypatch.setattr(alignment, "DENSE", 0)
    monkeypatch.setattr(alignment, "LINKS", 7)
    assert total() == plain


def test_minimal_perfect_hash_has_no_gaps_and_knows_its_keys():
    keys = np.random.default_rng(1).choice(1 << 40, 20000, replace=False).astype(np.int64)
    fields, known = alignment.place_pairs(keys)
    fields = alignment._unpack(alignment._pack(fields))
    at = alignment.places(keys, fields, known)
    assert sorted(at.tolist()) == list(range(len(keys))) and (known[at] == keys).all()
    assert (alignment.places(keys + (1 << 41), fields, known) == -1).all()
    assert alignment.places(keys[:3], *alignment.place_pairs(keys[:0])).tolist() == [-1, -1, -1]


# ---------------------------------------------------------------- op12
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _plain_search(docs, items, k):
    found = [(d, collections.Counter(WORDS.findall((t or "").translate(LOWER)))) for d, t in docs]
    big_n = sum(1 for _, c in found if c)
    big_l = sum(sum(c.values()) for _, c in found)
    df = collections.Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        terms = {t for t in WORDS.findall((text or "").translate(LOWER)) if df[t]}
        scores = []
        for d, c in found:
            m = 50 + (50 * sum(c.values()) * big_n) // max(1, big_l)
            score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                        * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if score > 0:
                scores.append((-score, d is None, d))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(scores[:k], 1)]
    return out


def test_search_equals_plain_on_odd_tables(spark):
    items = [(1, "ONE Two, three-four"), (2, None), (3, ""), (None, "word word WORD"), (5, "nowhere"),
             (5, "Ünïcode 漢字 1234567890"), (6, "one one two")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = lexical.search(_docs(spark, ODD), frame, 5)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(_plain_search(ODD, items, 5), key=str)
    assert lexical.search(_docs(spark, ODD).limit(0), frame).count() == 0
    assert lexical.search(_docs(spark, ODD), frame.limit(0)).count() == 0


@pytest.mark.parametrize("shard, block, first, vocabulary",
                         [(4096, 64, 1 << 13, 1 << 16), (64, 8, 100, 1 << 16), (64, 4, 50, 200)])
def test_search_equals_plain_in_many_shards_blocks_waves_and_rounds(spark, monkeypatch, shard, block, first,
                                                                    vocabulary):
    for name, value in (("SHARD", shard), ("BLOCK", block), ("FIRST", first), ("VOCABULARY", vocabulary)):
        monkeypatch.setattr(lexical, name, value)
    rnd = random.Random(5)
    topics = [[f"t{k}w{i}" for i in range(60)] for k in range(8)]

    def text():
        mine = rnd.choice(topics)
        return " ".join(rnd.choice(mine) if rnd.random() < 0.7 else f"c{int(rnd.paretovariate(0.6)) % 300}"
                        for _ in range(rnd.randrange(5, 60)))

    docs = [(i, text()) for i in range(700)]
    docs += [(1000 + i, docs[i % 3][1]) for i in range(150)]  # copies: ties
    items = [(i, text()) for i in range(12)]
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = lexical.search(_docs(spark, docs).repartition(4), frame, 20)
    assert sorted(map(tuple, got.collect())) == sorted(_plain_search(docs, items, 20))


def test_blocks_are_skipped_where_topics_differ(monkeypatch):
    """Half of the documents speak of the query's topic; with a known floor the
    blocks of others, though they share a term, are not scored."""
    monkeypatch.setattr(lexical, "BLOCK", 8)
    rnd = np.random.default_rng(3)
    docs = []
    for d in range(400):
        topic = np.arange(1, 11) if d % 2 else np.arange(11, 21)
        docs.append(np.sort(np.append(rnd.choice(topic, 8, replace=False), 0)))
    terms = np.concatenate(docs)
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    impacts = rnd.integers(5, 10, len(terms))
    size = 21
    query = lexical.Query(0, np.arange(11), np.ones(11, dtype=np.int64), 1)
    vectors = lexical.sketches(terms, impacts, bounds, size)
    members, cuts, block_term = lexical.list_blocks(terms, bounds, vectors, np.arange(size) < 11)
    parts = list(lexical.summaries(members, cuts, block_term, terms, impacts, bounds, size,
                                   lexical.asked_with([query], np.full(size, 9))))
    of_bounds = np.concatenate([[0], np.cumsum(np.concatenate([p[0] for p in parts]))])
    first = np.flatnonzero(np.diff(block_term, prepend=-1))
    by_term = dict(zip(block_term[first].tolist(), zip(first.tolist(), np.append(first[1:], len(block_term)).tolist())))
    found, scores, visited, blocks = lexical.search_shard(
        query, (np.arange(400), terms, impacts, bounds, np.full(size, 9)),
        (by_term, members, cuts, np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts]),
         of_bounds), 10)
    plain = np.array([impacts[a:b][terms[a:b] < 11].sum() for a, b in zip(bounds, bounds[1:])])
    assert scores.tolist() == np.sort(plain)[::-1][:10].tolist()
    other = sum((members[a:b] % 2 == 0).all() for a, b in zip(cuts, cuts[1:]))
    assert other > 10 and blocks - visited >= 0.8 * other


# ---------------------------------------------------------------- op13
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def _plain_groups(rows, shingle=4, percent=85):
    sets = []
    for _, text in rows:
        w = SPLIT.findall((text or "").translate(LOWER))
        full = {tuple(w[i:i + shingle]) for i in range(len(w) - shingle + 1)}
        sets.append(full if full else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            root[find(j)] = find(i)
    low = collections.defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)].append(doc)
    return [(doc, len(s), (min(low[find(i)]) if low[find(i)] else None) if s else doc)
            for i, ((doc, _), s) in enumerate(zip(rows, sets))]


def test_jaccard_groups_equal_plain_on_odd_texts(spark):
    rows = ODD + [(30, "ONE"), (31, "one two"), (32, "one  TWO"), (33, "one two three"), (34, "one two three four"),
                  (35, None), (36, "\t\n")]
    got = jaccard.jaccard_groups(_docs(spark, rows), keep=("token",)).drop("token")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(_plain_groups(rows), key=str)
    assert jaccard.jaccard_groups(_docs(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("seed, spread", [(1, 4096), (2, 4)])
def test_jaccard_groups_equal_plain_on_families(spark, monkeypatch, seed, spread):
    """Families around the threshold, chains, a shared passage and copies; also
    with neighbours looked for in very small buckets."""
    monkeypatch.setattr(jaccard, "SPREAD", spread)
    rnd = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for family in range(12):
        base = [f"f{family}w{rnd.randrange(500)}" for _ in range(rnd.choice([6, 20, 60, 150]))]
        last = base
        for member in range(14):
            words = list(last if member % 3 == 0 else base)
            for _ in range(rnd.randrange(0, max(2, len(words) // 25))):
                words[rnd.randrange(len(words))] = f"n{rnd.randrange(10 ** 6)}"
            if rnd.random() < 0.2:
                words += passage
            rows.append((len(rows) * 3 % 1009, " ".join(words)))
            last = words
    rows += [(5000 + i, rows[i % 5][1].upper()) for i in range(40)]
    got = jaccard.jaccard_groups(_docs(spark, rows))
    assert sorted(map(tuple, got.collect())) == sorted(_plain_groups(rows))


def test_copies_without_near_partners_are_no_candidates(spark):
    """Their texts are sent on to no comparison, however many copies there are."""
    texts = [" ".join(f"t{k}w{i}" for i in range(60)) for k in range(5)]
    rows = [(i, texts[i % 5]) for i in range(60)] + [(100, texts[0] + " more"), (101, None)]
    base = _docs(spark, rows).withColumn("key", F.xxhash64("doc_id", "text")) \
        .select("doc_id", "key", F.coalesce(F.octet_length("text"), F.lit(-1)).alias("size"), "text")
    found = jaccard._candidates(jaccard._rows(base, 4, 0.25), 85).collect()
    assert sorted(r["n"] for r in found) == [57, 58]


@pytest.mark.parametrize("packed", [False, True])
def test_shared_ngrams_equal_plain(spark, monkeypatch, packed):
    """Small batches and buckets, ids that come twice, n-grams of most sets."""
    monkeypatch.setattr(jaccard, "BUCKET", 64)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rnd = random.Random(3)
        sets = {i: {rnd.randrange(-2 ** 63, 2 ** 63) for _ in range(rnd.randrange(30))} for i in range(60)}
        common = [rnd.randrange(-2 ** 63, 2 ** 63) for _ in range(80)]
        for i in range(60):
            sets[i] |= set(rnd.sample(common, rnd.randrange(20))) | ({common[0]} if i % 4 else set())
        rows = [(i, sorted(t)) for i, t in sets.items()] + [(i, sorted(sets[i])) for i in range(0, 60, 3)]
        if packed:
            rows = [(i, b"".join(int(x).to_bytes(8, "little")[:jaccard.SHORT] for x in
                                 jaccard._short(np.array(t, dtype=np.int64).view(np.uint64)))) for i, t in rows]
        frame = spark.createDataFrame(rows, "id long, tokens " + ("binary" if packed else "array<long>"))
        got = {r["id"]: r["got"] for r in jaccard._shared(frame.repartition(3), 2000).collect()}
        df = collections.Counter(t for s in sets.values() for t in s)
        assert got == {i: n for i, s in sets.items() if (n := sum(df[t] > 1 for t in s))}
        assert jaccard._shared(frame.limit(0), 0).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_sieve_keeps_what_is_asked_for(spark):
    ids = spark.range(0, 3000, 3)
    kept = {r["id"] for r in jaccard._sieved(spark.range(3000), ids, "id").collect()}
    assert kept >= set(range(0, 3000, 3)) and len(kept) < 1300
    assert jaccard._sieved(spark.range(3000), ids.limit(0), "id").count() == 0
