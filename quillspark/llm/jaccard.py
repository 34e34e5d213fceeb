"""Jaccard links between documents by vertical partitioning of their n-grams.

All n-grams stand in one global order, rarest first. The order is cut into
fragments, every set is cut with it, overlaps are counted in each fragment
separately and summed up per pair. Which pairs are counted follows from the
order too: sets that are similar enough share one of their first n-grams.

Only n-grams that two sets hold can be in an overlap. A piece of the corpus's
n-grams (a range of their hashes, itself a vertical part) shows which documents
share too little of it to have any partner; most drop out there, and most of
the others when all of their n-grams are looked at in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from .common import stored
from .components import components
from .words import Powers, chunks, flat, flat_bytes, scramble, spans

FRAGMENTS = 16
SPREAD = 4096   # members of an n-gram whose neighbours are looked for together
PARTNERS = 8    # first n-grams that bring a set a partner of random place
PARTS = 64      # counted parts of a set, by hash, that bound an overlap
SHORT = 5       # bytes of an n-gram's hash that tell whether it may be shared
BUCKET = 1 << 21    # short n-grams that one task compares
SIEVE = 1 << 26     # most bits of a sieve of ids (8 MB)

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _hashes(words: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each of ``first`` on."""
    h = np.full(len(first), size, dtype=np.uint64)
    for k in range(size):
        h = scramble(h * _ODD + words[first + k])
    return h


def shingle_sets(column: pa.Array, shingle: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, ascending, and the bounds of the texts."""
    data, bounds = flat(column)
    powers, parts, counts = Powers(), [], [np.zeros(1, dtype=np.int64)]
    for first, last in chunks(bounds):
        low, n = bounds[first], last - first
        part, starts, ends, owner = spans(data[low:bounds[last]], bounds[first:last + 1] - low)
        words = scramble(powers.stretch(powers.sums(part), starts, ends))
        of = np.bincount(owner, minlength=n)
        begin = np.cumsum(of) - of
        full = np.flatnonzero(owner[:len(owner) - shingle + 1] == owner[shingle - 1:]) \
            if len(owner) >= shingle else np.zeros(0, np.int64)
        hashes, texts = [_hashes(words, full, shingle)], [owner[full]]
        for size in range(1, shingle):  # shorter texts are one shingle
            short = np.flatnonzero(of == size)
            hashes.append(_hashes(words, begin[short], size))
            texts.append(short)
        h, t = np.concatenate(hashes), np.concatenate(texts)
        order = np.lexsort((h, t))
        h, t = h[order], t[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
        parts.append(h[new])
        counts.append(np.bincount(t[new], minlength=n))
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.cumsum(np.concatenate(counts))


def _digests(h: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums over each set: equal sets, and no others, agree."""
    sums = []
    for seed in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03):
        run = np.concatenate([[np.uint64(0)], np.cumsum(scramble(h ^ np.uint64(seed)), dtype=np.uint64)])
        sums.append((run[bounds[1:]] - run[bounds[:-1]]).view(np.int64))
    return sums


def _short(h: np.ndarray) -> np.ndarray:
    """The bytes of hashes by which ``_shared`` compares."""
    return scramble(h) >> np.uint64(64 - 8 * SHORT)


def _binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary values, cut from ``data`` at ``bounds``."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [
        None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data).tobytes())])


def _rows(docs: DataFrame, shingle: int, share: float) -> DataFrame:
    """``doc_id, keep..., key, size, n, d1, d2, part, head``: the number of
    shingles, the digest of their set, and how many and which (short) shingles
    are in the first ``share`` of hashes."""
    keep = [c for c in docs.columns if c != "text"]
    top = np.uint64(min(int(share * 2.0 ** 64), (1 << 64) - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, bounds = shingle_sets(batch.column(len(keep)), shingle)
            d1, d2 = _digests(h, bounds)
            low = h <= top
            head = np.concatenate([[0], np.cumsum(low)])[bounds]
            columns = [pa.array(np.diff(bounds)), pa.array(d1), pa.array(d2), pa.array(np.diff(head)),
                       _binary(_short(h[low]).view(np.uint8).reshape(-1, 8)[:, :SHORT], head * SHORT)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], *columns],
                                             names=[*keep, "n", "d1", "d2", "part", "head"])

    new = [F.lit(0).cast("long").alias(c) for c in ("n", "d1", "d2", "part")]
    shape = docs.select(*keep, *new, F.lit(b"").alias("head"))
    return docs.select(*keep, "text").mapInArrow(run, shape.schema)


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    """``cid, n, tokens`` of the texts whose set has the digest asked for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, bounds = shingle_sets(batch.column("text"), shingle)
            d1, d2 = _digests(h, bounds)
            tokens = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(h.view(np.int64)))
            out = pa.RecordBatch.from_arrays([batch.column("cid"), pa.array(np.diff(bounds)), tokens],
                                             names=["cid", "n", "tokens"])
            right = (d1 == batch.column("d1").to_numpy()) & (d2 == batch.column("d2").to_numpy())
            yield out.filter(pa.array(right))

    return texts.select("cid", "d1", "d2", "text").mapInArrow(run, "cid long, n long, tokens array<long>")


def _least(n: Column | str, percent: int) -> Column:
    """Smallest overlap that a set of ``n`` can have with a partner."""
    return F.ceil(F.col(n) * percent / 100) if isinstance(n, str) else F.ceil(n * percent / 100)


def _cut(ids: np.ndarray, short: np.ndarray, bounds: np.ndarray, buckets: int) -> Iterator[tuple]:
    """The sets of a batch by bucket of their short n-grams: the bucket, and
    ``ids``, ``sure``, ``sizes``, ``keys`` and ``marks`` as ``_meet`` takes them."""
    _, once = np.unique(ids, return_index=True)  # equal sets are one
    sizes = np.zeros(len(ids), dtype=np.int64)
    sizes[once] = np.diff(bounds)[once]
    owner = np.repeat(np.arange(len(ids)), np.diff(bounds))
    here = sizes[owner] > 0
    owner, short = owner[here], short[here]
    order = np.argsort(short, kind="stable")
    owner, short = owner[order], short[order]
    new = np.ones(len(short), dtype=bool)
    new[1:] = short[1:] != short[:-1]
    run = np.cumsum(new) - 1
    several = np.bincount(run) > 1  # no id twice: a set holds an n-gram once
    sure = several[run] if len(run) else np.zeros(0, dtype=bool)
    bucket = (short * np.uint64(buckets)) >> np.uint64(8 * SHORT)
    key = short.astype(np.uint32)
    edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
    for k in range(buckets):
        at = slice(edges[k], edges[k + 1])
        known = np.bincount(owner[at][sure[at]], minlength=len(ids))
        left = np.flatnonzero(~sure[at])
        left = left[np.argsort(owner[at][left], kind="stable")]
        asked = np.bincount(owner[at][left], minlength=len(ids))
        who = np.flatnonzero(known + asked)
        if len(who):
            yield (k, ids[who], known[who].astype(np.int32), asked[who].astype(np.int32), key[at][left],
                   key[at][sure[at] & new[at]])


def _meet(ids: np.ndarray, sure: np.ndarray, sizes: np.ndarray, keys: np.ndarray,
          marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many n-grams in a bucket each of ``ids`` has in common with others.

    Each of ``ids`` has ``sure`` of them, and its ``sizes`` of the ``keys`` are to
    be compared; those in ``marks`` are known to be shared. An id that came
    with several batches brings the same n-grams each time.
    """
    names, of = np.unique(ids, return_inverse=True)
    row = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
    order = np.argsort(keys, kind="stable")
    row, keys = row[order], keys[order]
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    length = np.diff(np.append(start, len(keys)))
    owner = of[row]
    other = owner != np.repeat(owner[start], length)
    shared = np.logical_or.reduceat(other, start) if len(start) else np.zeros(0, dtype=bool)
    shared |= np.isin(keys[start], marks)
    found = sure + np.bincount(row[np.repeat(shared, length)], minlength=len(ids))
    got = np.zeros(len(names), dtype=np.int64)
    np.maximum.at(got, of, found)  # the same for each row of an id
    return names, got


def _shared(sets: DataFrame, total: int) -> DataFrame:
    """``id, got``: how many of the n-grams of ``id`` a set of another id holds.

    N-grams are compared by ``SHORT`` bytes of their hashes, so that a few too
    many may be counted, never too few. A task compares those in one range of
    hashes. What a batch finds to be shared goes there once, so that an n-gram
    of very many sets does not gather them. Rows of one id hold one set;
    ``total`` is about how many n-grams there are.
    """
    buckets = max(FRAGMENTS, -(-total // BUCKET))
    packs = (("ids", np.int64), ("sure", np.int32), ("sizes", np.int32), ("keys", np.uint32), ("marks", np.uint32))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            if pa.types.is_binary(column.type):
                data, bounds = flat_bytes(column)
                bounds, wide = bounds // SHORT, np.zeros((len(data) // SHORT, 8), dtype=np.uint8)
                wide[:, :SHORT] = data[:len(wide) * SHORT].reshape(-1, SHORT)
                short = wide.view(np.uint64).ravel()[bounds[0]:bounds[-1]]
            else:
                bounds = column.offsets.to_numpy().astype(np.int64)
                short = _short(column.flatten().to_numpy().view(np.uint64))
            ids, bounds = batch.column(0).to_numpy(), bounds - bounds[0]
            for first, last in chunks(bounds, BUCKET // 2):
                part = bounds[first:last + 1]
                rows = list(_cut(ids[first:last], short[part[0]:part[-1]], part - part[0], buckets))
                if not rows:
                    continue
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()),
                     *[pa.array([x.tobytes() for x in c], pa.binary()) for c in list(zip(*rows))[1:]]],
                    names=["bucket", *[name for name, _ in packs]])

    def meet(table: pa.Table) -> pa.Table:
        parts = [np.concatenate([np.frombuffer(x.as_buffer(), dtype=kind) for x in table.column(name)])
                 for name, kind in packs]
        names, got = _meet(*parts)
        return pa.table({"id": names[got > 0], "got": got[got > 0]})

    dealt = sets.mapInArrow(cut, "bucket int, " + ", ".join(f"{name} binary" for name, _ in packs))
    return dealt.groupBy("bucket").applyInArrow(meet, "id long, got long") \
        .groupBy("id").agg(F.sum("got").alias("got"))


def _sieved(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """``rows`` but most of those whose ``column`` is not in ``ids``.

    A bit set of hashes, 16 bits an id up to ``SIEVE``, goes to all tasks: rows
    that it keeps out need not be sent to where the ids are. It only spares
    that; a join or a count decides.
    """
    bits = min(SIEVE, 1 << max(10, (16 * ids.count()).bit_length()))

    def place(name: str) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(bits)).cast("int")

    words = ids.select(F.shiftright(place(column), 6).alias("part"), F.call_function(
        "shiftleft", F.lit(1).cast("long"), place(column).bitwiseAND(F.lit(63))).alias("bit")) \
        .groupBy("part").agg(F.bit_or("bit").alias("bits"))
    every = ids.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("part"))
    words = every.join(words, "part", "left").select("part", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    sieve = words.agg(F.transform(F.array_sort(F.collect_list(F.struct("part", "bits"))), lambda x: x["bits"]))
    word = F.element_at(sieve.scalar(), F.shiftright(place(column), 6) + 1)
    return rows.where(F.bit_get(word, place(column).bitwiseAND(F.lit(63))) == 1)


def _candidates(rows: DataFrame, percent: int) -> DataFrame:
    """Distinct sets that may have a partner: ``cid, n, d1, d2, key, size``.

    A partner misses at most ``n - least`` n-grams of a set, so of any part of
    the set it shares all but that many.
    """
    total = rows.agg(F.sum("part")).first()[0] or 0
    got = _shared(rows.where("part > 0").select("d1", "head"), total)
    classes = rows.where("n > 0").groupBy("d1", "d2").agg(
        F.first("n").alias("n"), F.first("part").alias("part"), F.min(F.struct("key", "size")).alias("row"))
    need = F.col("part") - (F.col("n") - _least("n", percent))
    left = classes.join(got, classes["d1"] == got["id"], "left").where(F.coalesce("got", F.lit(0)) >= need)
    return stored(left.select("n", "d1", "d2", "row.*", F.monotonically_increasing_id().alias("cid")))


def _partnered(sets: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Those of the sets that share enough of all their n-grams, and few others."""
    got = _shared(sets.select("cid", "tokens"), found.agg(F.sum("n")).first()[0] or 0)
    enough = got.join(found, got["id"] == found["cid"]).where(F.col("got") >= _least("n", percent))
    return _sieved(sets, stored(enough.select("cid")), "cid")


@F.pandas_udf(ArrayType(IntegerType()))
def _part_sizes(tokens: pd.Series) -> pd.Series:
    return tokens.map(lambda t: np.bincount(np.asarray(t, dtype=np.int64) & (PARTS - 1), minlength=PARTS))


def _ordered(sets: DataFrame, percent: int) -> DataFrame:
    """Sets of which enough is shared, their shared n-grams in global order, as
    places: ``cid, n, s, tokens``, each token with the ``df`` that orders it."""
    tokens = sets.select("cid", "n", F.explode("tokens").alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # The order is by frequency, then by hash.
    placed = tokens.join(shared, "token").select("cid", "n", F.struct("df", "token").alias("t"))
    whole = placed.groupBy("cid").agg(F.first("n").alias("n"), F.sort_array(F.collect_list("t")).alias("tokens"))
    whole = whole.withColumn("s", F.size("tokens").cast("long")).where(F.col("s") >= _least("n", percent))
    return stored(whole.withColumn("parts", _part_sizes(F.col("tokens.token"))))


def _at(t: Column) -> Column:
    """Place of a token in the order as a number, df plus a fraction."""
    return t["df"] + (F.shiftrightunsigned(t["token"], 11) / F.lit(2.0 ** 53))


def _segments(sets: DataFrame) -> DataFrame:
    """``cid, fragment, tokens``: the sets cut along the global order, at places
    that leave about as many postings in each fragment."""
    sets = sets.select("cid", F.transform("tokens", lambda t: F.struct(_at(t).alias("at"), t["token"].alias("token")))
                       .alias("tokens"))
    cuts = sets.select(F.explode("tokens.at").alias("at")).agg(F.percentile_approx(
        "at", [k / FRAGMENTS for k in range(1, FRAGMENTS)], 1000)).first()[0] or []
    bounds = [float("-inf"), *sorted(set(cuts)), float("inf")]

    def piece(a: float, b: float) -> Column:
        return F.transform(F.filter("tokens", lambda t: (t["at"] > a) & (t["at"] <= b)), lambda t: t["token"])

    pieces = [piece(a, b) for a, b in zip(bounds, bounds[1:])]
    cut = sets.select("cid", F.posexplode(F.array(*pieces)).alias("fragment", "tokens"))
    return stored(cut.where(F.size("tokens") > 0))


def _fits(percent: int) -> Column:
    """Whether sizes and shared parts of ``a`` and ``b`` allow the similarity."""
    common = F.least("sa", "sb")
    return (100 + percent) * common >= percent * (F.col("na") + F.col("nb"))


def _shared_parts() -> Column:
    """No more of ``a`` and ``b`` is common than the smaller holds of each part."""
    return F.aggregate(F.zip_with("pa", "pb", lambda x, y: F.least(x, y)), F.lit(0).cast("long"),
                       lambda x, y: x + y)


def _reach(percent: int) -> Column:
    """Whether ``a`` and ``b`` that have their first common n-gram here can be
    similar: it leaves the rest of either set, and their parts allow it."""
    common = _shared_parts()
    need = percent * (F.col("na") + F.col("nb"))
    return ((100 + percent) * F.least(F.col("sa") - F.col("ka"), F.col("sb") - F.col("kb")) >= need) \
        & ((100 + percent) * common >= need)


def _verified(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b``: overlaps of the pairs counted by fragment and summed. Few
    but the segments of the pairs are sent to where these are."""
    pairs = stored(pairs)
    left = _sieved(segments, pairs.select(F.col("a").alias("cid")), "cid") \
        .select(F.col("cid").alias("a"), "fragment", F.col("tokens").alias("of_a"))
    right = _sieved(segments, pairs.select(F.col("b").alias("cid")), "cid") \
        .select(F.col("cid").alias("b"), "fragment", F.col("tokens").alias("of_b"))
    partial = pairs.join(left, "a").join(right, ["b", "fragment"]) \
        .select("a", "b", "na", "nb", F.size(F.array_intersect("of_a", "of_b")).alias("common"))
    total = partial.groupBy("a", "b").agg(F.sum("common").alias("common"), F.first("na").alias("na"),
                                          F.first("nb").alias("nb"))
    return total.where((100 + percent) * F.col("common") >= percent * (F.col("na") + F.col("nb"))) \
        .select("a", "b")


def links(sets: DataFrame, percent: int) -> DataFrame:
    """Links between the sets of ``_ordered``, enough of them to join whatever
    all of them would: ``a, b``.

    Sets meet on the n-grams of their prefix. First only neighbours do, in two
    orders, which joins groups of copies at the cost of their size. After that a
    pair is counted only where its ends are not joined yet, so all pairs are
    met or joined, and a group of any size is never paired out with itself.
    """
    segments = _segments(sets)
    length = (F.col("s") - _least("n", percent) + 1).cast("int")
    prefix = sets.select("cid", "n", "s", F.posexplode(F.slice("tokens", F.lit(1), length)).alias("k", "t"))
    prefix = stored(prefix.select("cid", "n", "s", "k", F.col("t.token").alias("token"),
                                  F.col("t.df").alias("df")))
    spread = F.pmod(F.xxhash64("cid"), F.ceil(F.col("df") / SPREAD))
    met = []
    for order, rows in ((["n", "cid"], prefix), ([F.xxhash64("token", "cid")], prefix.where(F.col("k") < PARTNERS))):
        near = Window.partitionBy("token", spread).orderBy(*order)
        before = F.lag(F.struct("cid", "n", "s")).over(near)
        met.append(rows.select(before.alias("p"), "cid", "n", "s").where("p is not null").select(
            F.least("p.cid", "cid").alias("a"), F.greatest("p.cid", "cid").alias("b"),
            F.when(F.col("p.cid") < F.col("cid"), F.struct(F.col("p.n").alias("na"), F.col("n").alias("nb")))
            .otherwise(F.struct(F.col("n").alias("na"), F.col("p.n").alias("nb"))).alias("sizes"),
            F.col("p.s").alias("sa"), F.col("s").alias("sb")))
    pairs = met[0].union(met[1]).select("a", "b", "sizes.*", "sa", "sb").where(_fits(percent)) \
        .select("a", "b", "na", "nb").distinct()
    first = stored(_verified(pairs, segments, percent))
    joined = components(first)
    placed = stored(prefix.join(joined, prefix["cid"] == joined["node"], "left")
                    .select("token", "cid", "n", "s", "k", F.coalesce("root", "cid").alias("root")))
    # On each n-gram: who is not of its largest group meets everyone outside the own group.
    by_root = placed.groupBy("token", "root").agg(F.count(F.lit(1)).alias("c"))
    largest = by_root.groupBy("token").agg(F.max_by("root", F.struct("c", "root")).alias("most"),
                                           F.count(F.lit(1)).alias("roots")).where("roots > 1")
    open_ = stored(placed.join(largest.select("token", "most"), "token").join(sets.select("cid", "parts"), "cid"))

    def side(rows: DataFrame, x: str) -> DataFrame:
        names = {"cid": x, "n": f"n{x}", "s": f"s{x}", "k": f"k{x}", "parts": f"p{x}", "root": f"r{x}"}
        return rows.select("token", *[F.col(c).alias(n) for c, n in names.items()])

    rest = side(open_.where("root <> most"), "a").join(side(open_, "b"), "token") \
        .where((F.col("ra") != F.col("rb")) & _reach(percent)) \
        .select("a", "b", "na", "nb", "rb", _shared_parts().alias("bound"))
    rest = stored(rest.groupBy("a", "b").agg(*[F.first(c).alias(c) for c in ("na", "nb", "rb", "bound")]))
    # One link joins a set with a whole group, so the likeliest pair goes first.
    likely = rest.groupBy("a", "rb").agg(F.max_by(F.struct("b", "na", "nb"), F.struct("bound", "b")).alias("p"))
    second = stored(_verified(_once(likely.select("a", "p.*")), segments, percent))
    joined = components(first.union(second))
    of_a = joined.select(F.col("node").alias("a"), F.col("root").alias("ga"))
    of_b = joined.select(F.col("node").alias("b"), F.col("root").alias("gb"))
    left = rest.join(of_a, "a", "left").join(of_b, "b", "left") \
        .where(F.coalesce("ga", "a") != F.coalesce("gb", "b"))
    return first.union(second).union(_verified(_once(left), segments, percent))


def _once(pairs: DataFrame) -> DataFrame:
    """Each pair once, whichever of its ends came first."""
    turned = F.col("a") > F.col("b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                        F.when(turned, F.col("nb")).otherwise(F.col("na")).alias("na"),
                        F.when(turned, F.col("na")).otherwise(F.col("nb")).alias("nb")).distinct()


def jaccard_groups(docs: DataFrame, shingle: int = 4, percent: int = 85,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``doc_id, keep..., n_shingles, component_id``.

    Words are runs without blanks or the controls 09-0D, A-Z lower-cased; a set
    is the distinct runs of ``shingle`` words, or the whole of a shorter text.
    Sets link when ``100 * intersection >= percent * union``; ``component_id``
    is the smallest id that a chain of links reaches, the own one included.

    Null and blank texts have an empty set and link with nothing, not even with
    each other. Equal sets are one node, so a group of copies of any size costs
    its rows only. N-grams are known by 64-bit hashes, sets by 128 bits. Long
    texts are taken whole. Null ids are never the smallest unless all of the
    component are null. Repeated rows come out repeated. No rows give no rows.

    Where very many different sets of almost the needed similarity share one
    rare n-gram, all their pairs have to be refuted; sizes and shared parts of
    the sets rule out what they can first.
    """
    key = F.xxhash64("doc_id", "text")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keep,
                       F.col("text").cast("string").alias("text"))
    base = base.select("doc_id", *keep, key.alias("key"),
                       F.coalesce(F.octet_length("text"), F.lit(-1)).alias("size"), "text")
    rows = stored(_rows(base, shingle, min(1.0, 1.1 - percent / 100)))
    found = _candidates(rows, percent)
    texts = base.select("key", "size", "text")
    texts = _sieved(texts, found, "key").join(found.select("key", "size", "cid", "d1", "d2"), ["key", "size"])
    sets = stored(_sets(texts.dropDuplicates(["cid"]), shingle))
    sets = _ordered(_partnered(sets, found, percent), percent)
    roots = components(links(sets, percent))
    root_of = found.join(roots, found["cid"] == roots["node"]).select("d1", "d2", "root")
    classes = rows.where("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("low")) \
        .join(root_of, ["d1", "d2"], "left")
    lowest = classes.where("root is not null").groupBy("root").agg(F.min("low").alias("group_low"))
    named = classes.join(lowest, "root", "left") \
        .select("d1", "d2", F.coalesce("group_low", "low").alias("component_id"))
    empty = rows.where("n = 0").select("doc_id", *keep, F.col("n").alias("n_shingles"),
                                       F.col("doc_id").alias("component_id"))
    return rows.where("n > 0").join(named, ["d1", "d2"]) \
        .select("doc_id", *keep, F.col("n").alias("n_shingles"), "component_id").unionByName(empty)
