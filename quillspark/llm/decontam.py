"""Benchmark decontamination by SimHash of item-sized windows.

Documents are cut into windows of as many words as an item has. Windows and
items get SimHash fingerprints over five-word shingles; a multi-index of
radius + 1 fingerprint blocks finds every item of that length within the
radius, and exact weighted-shingle similarity verifies what is found. Only
windows that can reach the similarity are made: such a window shares a run of
shingles with its item, so some shingle at every ``stride``-th word of the
document is one of an item, and it holds as many item shingles as the
similarity needs, in whatever order. Built-in functions only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stored, text_or_empty

SHINGLE = 5
SIMILARITY = 0.8
# Bits in which the fingerprints of a window and its item may differ. At
# similarity 0.8 they differ in about 10 of 64 bits, deviation 3.
RADIUS = 15
# Bits of the sieve for item shingles: a fixed 1 MB whatever the items.
SIEVE = 1 << 23


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(words: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(words) - (SHINGLE - 1)),
                       lambda i: F.array_join(F.slice(words, i, SHINGLE), " "))


def simhash(words: Column) -> Column:
    """64-bit fingerprint: a bit is set where more than half of the shingles,
    repeats counted, set it in their hash."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")

    def votes(hashes: Column, b: Column) -> Column:
        return F.aggregate(hashes, none, lambda n, h: n + F.call_function(
            "shiftrightunsigned", h, b).bitwiseAND(one))

    hashes = F.transform(_shingles(words), lambda s: F.xxhash64(s))
    return let(hashes, lambda hashes: F.aggregate(
        F.sequence(F.lit(0), F.lit(63)), none, lambda acc, b: acc.bitwiseOR(
            F.when(votes(hashes, b) * 2 > F.size(hashes), F.call_function("shiftleft", one, b))
            .otherwise(none))))


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard of two shingle lists, a shingle weighing as often as it
    occurs: sum of the smaller over sum of the larger counts."""
    def times(shingles: Column, s: Column) -> Column:
        return F.size(F.filter(shingles, lambda x: x == s))

    def of(ab: Column) -> Column:
        a, b = ab["a"], ab["b"]
        common = F.aggregate(F.array_intersect(a, b), F.lit(0),
                             lambda acc, s: acc + F.least(times(a, s), times(b, s)))
        return let(common, lambda c: c / (F.size(a) + F.size(b) - c))

    return let(F.struct(a.alias("a"), b.alias("b")), of)


def needed(item: Column, window: Column, least: float = SIMILARITY) -> Column:
    """Shingles that an item and a window must share at similarity ``least``,
    from how many each has: common / (item + window - common) >= least."""
    return F.ceil((item + window) * (least / (1 + least)) - 1e-9).cast("int")


def blocks(fp: Column, radius: int) -> Column:
    """The fingerprint cut into ``radius + 1`` blocks: array of (no, bits).
    Fingerprints within the radius agree in one of them."""
    edges = [round(k * 64 / (radius + 1)) for k in range(radius + 2)]
    return F.array(*[F.struct(
        F.lit(k).alias("no"),
        F.shiftrightunsigned(F.shiftleft(fp, 64 - high), 64 - high + low).alias("bits"))
        for k, (low, high) in enumerate(zip(edges, edges[1:]))])


def _stride(items: DataFrame, least: float) -> int:
    """Words between the tested places. A window shares at least ``least`` of
    the item's shingles, fewer than all only where the document is shorter, and
    what it does not share, each maybe alone, cuts them into runs."""
    n = F.col("n") - (SHINGLE - 1)
    run = F.ceil(F.ceil(n * least - 1e-9) / (n - needed(n, n, least) + 1))
    return int(items.agg(F.coalesce(F.min(run), F.lit(1))).first()[0])


def _sieve(shingles: DataFrame) -> DataFrame:
    """Bit set of the shingle hashes: one row, an array of longs of fixed size."""
    place = F.pmod("hash", F.lit(SIEVE)).cast("int")
    bits = shingles.select(F.shiftright(place, 6).alias("part"), F.call_function(
        "shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63))).alias("bit")) \
        .groupBy("part").agg(F.bit_or("bit").alias("bits"))
    every = shingles.sparkSession.range(SIEVE // 64).select(F.col("id").cast("int").alias("part"))
    row = every.join(F.broadcast(bits), "part", "left") \
        .select("part", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    return row.agg(F.transform(F.array_sort(F.collect_list(F.struct("part", "bits"))),
                               lambda x: x["bits"]).alias("sieve"))


def contaminated(docs: DataFrame, benchmark: DataFrame, keep: Sequence[str] = ("doc_id",),
                 least: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """Benchmark items in documents: ``keep, text_md5, item_id, similarity,
    start_word, words``, one row per text and item, with the most similar
    window (the first of equals; words count from 0).

    Words are lower-cased runs of letters and digits; a document shorter than
    the item is one window. Items under five words have no shingle and take no
    part, nor do null texts on either side. Equal items are all reported.
    Repeated rows come out once per ``keep`` and text. No rows on either side
    give no rows. Other columns are ignored.

    A benchmark shingle in a great many documents only makes rows for those
    documents: its side of the joins is a few rows, and the join may split the
    other side. Windows go by words around the shared shingle, so texts are
    neither shuffled nor copied. Every window that holds the shingle is made if
    it holds as many item shingles as it must share, wherever they stand in the
    item.
    """
    words = words_of(F.col("text").cast("string"))
    items = stored(benchmark.select("item_id", words.alias("words"))
                   .where(F.size("words") >= SHINGLE)
                   .select("item_id", "words", F.size("words").alias("n")))
    hashes = F.transform(_shingles(F.col("words")), lambda s: F.xxhash64(s))
    shingles = items.select("n", F.explode(hashes).alias("hash")).distinct()
    stride, sieve = _stride(items, least), _sieve(shingles)
    longest = items.agg(F.coalesce(F.max("n"), F.lit(SHINGLE))).first()[0]

    rows = docs.select(*[F.col(c).alias(f"k_{c}") for c in keep],
                       F.md5(text_or_empty().cast("binary")).alias("text_md5"),
                       words.alias("words"))
    keys = [f"k_{c}" for c in keep] + ["text_md5"]

    def hash_at(words: Column, i: Column) -> Column:
        return F.xxhash64(F.array_join(F.slice(words, i, SHINGLE), " "))

    def passes(sieve: Column, h: Column) -> Column:
        at = F.pmod(h, F.lit(SIEVE)).cast("int")
        bits = F.element_at(sieve, F.shiftright(at, 6) + 1)
        return F.call_function("shiftrightunsigned", bits, at.bitwiseAND(F.lit(63))) \
            .bitwiseAND(F.lit(1).cast("long")) == 1

    def meeting(of: Column) -> Column:
        words, sieve = of["words"], of["sieve"]
        final = F.size(words) - (SHINGLE - 1)
        tested = F.transform(F.sequence(F.lit(1), final, F.lit(stride)),
                             lambda i: F.struct(i.alias("i"), hash_at(words, i).alias("hash")))
        # Texts with a hit get a flag for every shingle that may be one of an item.
        flags = F.transform(F.sequence(F.lit(1), final), lambda i: passes(sieve, hash_at(words, i)))
        return let(F.filter(tested, lambda x: passes(sieve, x["hash"])), lambda hits: F.when(
            F.size(hits) > 0, F.struct(words.alias("words"), hits.alias("hits"), flags.alias("flags"))))

    # The sieve is a subquery and not a constant: plans stay small, and so do the
    # texts of them that the driver keeps. Words and sieve are used once, so that
    # they need no rows of their own.
    hits = rows.where(F.size("words") >= SHINGLE).withColumn("sieve", sieve.scalar()) \
        .select(*keys, let(F.struct("words", "sieve"), meeting).alias("met")) \
        .select(*keys, F.col("met.words").alias("words"), F.col("met.flags").alias("flags"),
                F.explode("met.hits").alias("hit"))
    i, first = F.col("hit.i"), F.greatest(F.lit(1), F.col("hit.i") - longest)
    marks = F.filter(F.sequence(first, F.least(F.size("flags"), i + longest)),
                     lambda p: F.element_at(F.col("flags"), p))
    hits = hits.select(*keys, F.size("words").alias("size"), i.alias("i"),
                       F.col("hit.hash").alias("hash"), first.alias("first"),
                       F.slice("words", first, F.lit(2 * longest)).alias("around"),
                       marks.alias("marks"))
    last = F.greatest(F.lit(1), F.col("size") - F.col("n") + 1)
    most = F.least("n", "size") - (SHINGLE - 1)
    near = hits.join(shingles, "hash").select(
        "*", last.alias("last"), most.alias("most"),
        needed(F.col("n") - (SHINGLE - 1), most, least).alias("need"))

    def starts(r: Column) -> Column:
        """Starts of the windows around the hit that hold ``need`` marks from
        the r-th on."""
        low = F.greatest(F.lit(1), F.col("i") - F.col("most") + 1,
                         F.element_at("marks", r + F.col("need") - 1) - F.col("most") + 1)
        high = F.least(F.element_at("marks", r), F.col("i"), F.col("last"))
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    rank = F.sequence(F.lit(1), F.size("marks") - F.col("need") + 1)
    found = near.where((F.col("need") <= F.col("most")) & (F.size("marks") >= F.col("need"))) \
        .select(*keys, "n", "first", "around", F.explode(F.array_distinct(F.flatten(
            F.transform(rank, starts)))).alias("start"))
    windows = found.select(
        *keys, "n", "start", F.slice("around", F.col("start") - F.col("first") + 1, F.col("n"))
        .alias("window")).dropDuplicates([*keys, "n", "start"])
    marked = windows.where(F.size("window") >= SHINGLE).withColumn("fp", simhash(F.col("window")))
    left = marked.select("*", F.explode(blocks(F.col("fp"), radius)).alias("block"))
    right = items.withColumn("item_fp", simhash(F.col("words")))
    right = right.select("item_id", "n", "item_fp", F.explode(
        blocks(F.col("item_fp"), radius)).alias("block"))
    # Of the blocks that agree, the first one speaks for the pair.
    differ = F.col("fp").bitwiseXOR(F.col("item_fp"))
    agree = F.filter(F.transform(blocks(differ, radius), lambda x: F.when(
        x["bits"] == 0, x["no"])), lambda x: x.isNotNull())
    pairs = left.join(right, ["n", "block"]) \
        .where((F.bit_count(differ) <= radius) & (F.element_at(agree, 1) == F.col("block.no"))) \
        .join(items.select("item_id", F.col("words").alias("item_words"), "n"), ["item_id", "n"])
    near = pairs.select(*keys, "item_id", "start", "n", similarity(
        _shingles(F.col("window")), _shingles(F.col("item_words"))).alias("similarity"))
    best = F.max_by(F.struct("start", "n"), F.struct("similarity", -F.col("start")))
    return near.where(F.col("similarity") >= least).groupBy(*keys, "item_id").agg(
        F.max("similarity").alias("similarity"), best.alias("best")).select(
        *[F.col(f"k_{c}").alias(c) for c in keep], "text_md5", "item_id", "similarity",
        (F.col("best.start") - 1).alias("start_word"), F.col("best.n").alias("words"))
