"""Ranked lexical search over posting lists that are blocked by similarity.

Documents are dealt to shards by the direction of their weighted terms. In a
shard the posting list of a term is clustered by document similarity, each
cluster is a block, and a block stores the greatest impact that each term has
in any of its documents. For a query such a summary bounds the score of every
document of the block exactly; a block is skipped only where that bound is below
a score that enough documents are known to have. All other documents of the
visited lists are scored in full, so the ranking is that of a full scan.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, stored

# What separates terms.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

VOCABULARY = 1 << 16  # term occurrences of the items that one round searches for
PIECE = 1 << 20       # bytes of a text whose terms are listed at a time
SHARD = 4096          # documents of a shard
BLOCK = 64            # documents of a block, twice that at most
DEPTH = 8             # halvings of the cell tree
SAMPLE = 1 << 12      # documents the cell tree is fitted on
DIMENSIONS = 16       # of the sketch that similarity is measured on
FIRST = 1 << 13       # documents of the first wave
CELLS = 1 << 22       # numbers of a summary table in work


class Query(NamedTuple):
    item: int          # number of the item
    terms: np.ndarray  # ascending by weight times greatest impact
    weights: np.ndarray
    floor: int         # a score that enough documents have, 1 if not known


# ---------------------------------------------------------------- terms
def item_terms(items: DataFrame, text: str = "text") -> DataFrame:
    """``items`` with their distinct ``terms``."""
    lower = ascii_lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    return items.withColumn("terms", F.array_distinct(F.filter(F.split(lower, SEPARATORS), lambda t: t != "")))


def _count_terms(text: bytes) -> Counter:
    """Terms of a whole text; a long one in pieces that end between terms."""
    if len(text) <= PIECE:
        return Counter(_TERM.findall(text.translate(_LOWER)))
    found: Counter = Counter()
    for match in _TERM.finditer(text.translate(_LOWER)):
        found[match[0]] += 1
    return found


def _vectors(docs: DataFrame, vocabulary) -> DataFrame:
    """``uid, doc_id, n, terms, tf``: number of terms of each document, and the
    known ones by their number with their occurrences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t.encode(): i for i, t in enumerate(vocabulary.value)}
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            n, terms, tf, to = [], [], [], [0]
            for text in batch.column("text"):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                found = _count_terms(data)
                n.append(sum(found.values()))
                known = sorted((number[t], c) for t, c in found.items() if t in number)
                terms += [t for t, _ in known]
                tf += [c for _, c in known]
                to.append(len(terms))
            bounds = pa.array(to, pa.int32())
            uids = np.arange(uid, uid + batch.num_rows)
            uid += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(uids), batch.column("doc_id"), pa.array(n, pa.int64()),
                 pa.ListArray.from_arrays(bounds, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(bounds, pa.array(tf, pa.int32()))],
                names=["uid", "doc_id", "n", "terms", "tf"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "uid long, doc_id long, n long, terms array<int>, tf array<int>")


# ---------------------------------------------------------------- similarity
def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the bounds of its lists."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    bounds = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)[bounds[0]:bounds[-1]]
    return values, bounds - bounds[0]


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of each list (rows of ``values``), 0 for empty ones."""
    run = np.concatenate([np.zeros((1, *values.shape[1:]), values.dtype), np.cumsum(values, axis=0)])
    return run[bounds[1:]] - run[bounds[:-1]]


def sketches(terms: np.ndarray, value: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """Documents as unit vectors: random projection of their weighted terms."""
    axes = np.random.default_rng(7).standard_normal((size, DIMENSIONS))
    out = _sums(axes[terms] * value[:, None], bounds)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


class Cells(NamedTuple):
    """A tree that halves the sample along its widest direction, again and again."""

    depth: int
    axes: np.ndarray
    cuts: np.ndarray

    @staticmethod
    def fit(vectors: np.ndarray, depth: int) -> Cells:
        axes, cuts = np.zeros((1 << depth, DIMENSIONS)), np.zeros(1 << depth)
        node = np.ones(len(vectors), dtype=np.int64)
        for k in range(1, 1 << depth):
            mine = vectors[node == k]
            if len(mine) > 1:
                axes[k] = np.linalg.svd(mine - mine.mean(axis=0), full_matrices=False)[2][0]
                cuts[k] = np.median(mine @ axes[k])
            node[node == k] = 2 * k + (mine @ axes[k] > cuts[k])
        return Cells(depth, axes, cuts)

    def of(self, vectors: np.ndarray) -> np.ndarray:
        node = np.ones(len(vectors), dtype=np.int64)
        for _ in range(self.depth):
            node = 2 * node + ((vectors * self.axes[node]).sum(axis=1) > self.cuts[node])
        return node - (1 << self.depth)


def _impacts(vectors: DataFrame, weights, cells) -> DataFrame:
    """``uid, doc_id, cell, terms, impacts`` of documents with a known term.
    ``m`` is a column of ``vectors``, impacts are whole millionths."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for batch in batches:
            terms, bounds = _flat(batch.column("terms"))
            tf = _flat(batch.column("tf"))[0].astype(np.int64)
            m = np.repeat(batch.column("m").to_numpy(), np.diff(bounds))
            impact = 1_000_000_000 * tf // (1000 * tf + 20 * m)
            vector = sketches(terms, w[terms] * impact, bounds, len(w))
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), batch.column("doc_id"), pa.array(cells.value.of(vector).astype(np.int32)),
                 batch.column("terms"), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)),
                                                                 pa.array(impact.astype(np.int32)))],
                names=["uid", "doc_id", "cell", "terms", "impacts"])

    return vectors.where(F.size("terms") > 0).select("uid", "doc_id", "m", "terms", "tf").mapInArrow(
        run, "uid long, doc_id long, cell int, terms array<int>, impacts array<int>")


# ---------------------------------------------------------------- blocks
def _clusters(vectors: np.ndarray) -> np.ndarray:
    """Cluster of each document of a posting list: the nearest of some of the
    documents themselves, about one for each block."""
    k = math.ceil(len(vectors) / BLOCK)
    middles = vectors[np.arange(k) * len(vectors) // k]
    return np.argmax(vectors @ middles.T, axis=1)


def list_blocks(terms: np.ndarray, bounds: np.ndarray, vectors: np.ndarray, wanted: np.ndarray):
    """Blocks of the posting lists of the ``wanted`` terms: members (documents),
    their bounds, and the term of each block."""
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    use = wanted[terms]
    doc, term = doc[use], terms[use]
    order = np.argsort(term, kind="stable")
    doc, term = doc[order], term[order]
    cluster = np.zeros(len(doc), dtype=np.int64)
    starts = np.flatnonzero(np.diff(term, prepend=-1))
    sizes = np.diff(np.append(starts, len(term)))
    for start, size in zip(starts[sizes > BLOCK].tolist(), sizes[sizes > BLOCK].tolist()):
        cluster[start:start + size] = _clusters(vectors[doc[start:start + size]])
    order = np.lexsort((doc, cluster, term))
    doc, term, cluster = doc[order], term[order], cluster[order]
    new = (np.diff(term, prepend=-1) != 0) | (np.diff(cluster, prepend=-1) != 0)
    start = np.flatnonzero(new)
    place = np.arange(len(doc)) - np.repeat(start, np.diff(np.append(start, len(doc))))
    new |= place % (2 * BLOCK) == 0
    start = np.flatnonzero(new)
    return doc, np.append(start, len(doc)), term[start]


def asked_with(queries: list[Query], greatest: np.ndarray) -> dict[int, np.ndarray]:
    """For each term whose list a query may have to visit, the terms that are
    asked for together with it; without lists that are too light to lift a
    document to the floor."""
    found: dict[int, list[np.ndarray]] = {}
    for q in queries:
        for t in q.terms[np.cumsum(q.weights * greatest[q.terms]) >= q.floor].tolist():
            found.setdefault(t, []).append(q.terms)
    return {t: np.unique(np.concatenate(x)) for t, x in found.items()}


def summaries(members: np.ndarray, block_bounds: np.ndarray, block_term: np.ndarray, terms: np.ndarray,
              impacts: np.ndarray, bounds: np.ndarray, size: int,
              asked: dict[int, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Greatest impacts in each block, of the terms that are asked for with the
    block's own: numbers of terms, terms, maxima, for some blocks at a time."""
    step, blocks = max(1, CELLS // size), len(block_bounds) - 1
    for first in range(0, blocks, step):
        last = min(blocks, first + step)
        docs = members[block_bounds[first]:block_bounds[last]]
        block = np.repeat(np.arange(last - first), np.diff(block_bounds[first:last + 1]))
        length = bounds[docs + 1] - bounds[docs]
        at = np.repeat(bounds[docs] - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
        table = np.zeros((last - first) * size, dtype=np.int32)
        np.maximum.at(table, np.repeat(block, length) * size + terms[at], impacts[at])
        own, number = np.unique(block_term[first:last], return_inverse=True)
        wanted = np.zeros((len(own), size), dtype=bool)
        for row, t in zip(wanted, own.tolist()):
            row[asked[t]] = True
        table *= wanted[number].ravel()
        hit = np.flatnonzero(table)
        yield np.bincount(hit // size, minlength=last - first), hit % size, table[hit]


INDEX = ("shard int, doc_id array<long>, doc_bounds array<int>, terms array<int>, impacts array<int>, "
         "block_term array<int>, members array<int>, member_bounds array<int>, of array<int>, "
         "greatest array<int>, of_bounds array<int>")


def _index(docs: DataFrame, asked, weights) -> DataFrame:
    """The index, a row for each shard: its documents with terms and impacts;
    its blocks by ``block_term`` with their members (places of documents), and
    their summaries, the ``greatest`` impact of the terms ``of`` each block."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("uid")
        terms, bounds = _flat(table.column("terms"))
        impacts, _ = _flat(table.column("impacts"))
        w = weights.value
        vectors = sketches(terms, w[terms] * impacts.astype(np.int64), bounds, len(w))
        wanted = np.zeros(len(w), dtype=bool)
        wanted[list(asked.value)] = True
        members, cuts, block_term = list_blocks(terms, bounds, vectors, wanted)
        parts = list(summaries(members, cuts, block_term, terms, impacts, bounds, len(w), asked.value))
        size, of, most = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64)
                          for k in range(3))
        lists = [bounds, terms, impacts, block_term, members, cuts, of, most,
                 np.concatenate([[0], np.cumsum(size)])]
        return pa.Table.from_arrays(
            [table.column("shard").slice(0, 1), pa.array([table.column("doc_id").to_pylist()], pa.list_(pa.int64())),
             *[pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x.astype(np.int32)))
               for x in lists]],
            names=[c.split()[0] for c in INDEX.split(", ")])

    return docs.select("shard", "uid", "doc_id", "terms", "impacts").groupBy("shard").applyInArrow(run, INDEX)


# ---------------------------------------------------------------- search
def _pick(bounds: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the values of the chosen lists, and the bounds of those lists."""
    length = bounds[chosen + 1] - bounds[chosen]
    to = np.concatenate([[0], np.cumsum(length)])
    return np.repeat(bounds[chosen] - to[:-1], length) + np.arange(int(to[-1])), to


def best(scores: np.ndarray, doc_id: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to smaller ids."""
    return np.lexsort((doc_id, -scores))[:k]


def search_shard(query: Query, docs: tuple, blocks: tuple, k: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Best documents of a shard (places, scores), blocks scored and in all."""
    doc_id, terms, impacts, bounds, greatest_here = docs
    by_term, members, member_bounds, of, greatest, of_bounds = blocks
    none = np.zeros(0, dtype=np.int64)
    # Lists of small weight: if all of them together stay below the floor, who
    # is in no other list does, too.
    reach = np.cumsum(query.weights * greatest_here[query.terms])
    lists = query.terms[reach >= query.floor]
    picked = [np.arange(*by_term[t]) for t in lists.tolist() if t in by_term]
    if not picked:
        return none, none, 0, 0
    chosen = np.concatenate(picked)
    weight = np.zeros(len(greatest_here), dtype=np.int64)
    weight[query.terms] = query.weights
    at, to = _pick(of_bounds, chosen)
    bound = _sums(weight[of[at]] * greatest[at], to)
    order = np.argsort(-bound, kind="stable")
    chosen, bound = chosen[order], bound[order]
    floor, first, visited = query.floor, 0, 0
    found, scores = none, none
    step = max(1, 2 * k // BLOCK)
    while first < len(chosen) and bound[first] >= floor:
        last = min(first + step, int(np.searchsorted(-bound, -floor, side="right")))
        at, _ = _pick(member_bounds, chosen[first:last])
        fresh = np.setdiff1d(members[at], found)
        at, to = _pick(bounds, fresh)
        score = _sums(weight[terms[at]] * impacts[at], to)
        visited += last - first
        found, scores = np.concatenate([found, fresh]), np.concatenate([scores, score])
        if len(scores) >= k:
            floor = max(floor, int(np.partition(scores, -k)[-k]))
        first, step = last, 4 * step
    right = scores >= floor
    found, scores = found[right], scores[right]
    top = best(scores, doc_id[found], k)
    return found[top], scores[top], visited, len(chosen)


def _search(index: DataFrame, queries, size: int, k: int) -> DataFrame:
    """Best documents of each shard for each query: ``item, doc_id, score``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard = batch.slice(row, 1)
                ids = shard.column("doc_id")[0].values
                doc_id = ids.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
                bounds, terms, impacts, block_term, members, cuts, of, most, of_bounds = (
                    _flat(shard.column(c))[0].astype(np.int64) for c in (
                        "doc_bounds", "terms", "impacts", "block_term", "members", "member_bounds", "of",
                        "greatest", "of_bounds"))
                here = np.zeros(size, dtype=np.int64)
                np.maximum.at(here, terms, impacts)
                first = np.flatnonzero(np.diff(block_term, prepend=-1))
                by_term = dict(zip(block_term[first].tolist(),
                                   zip(first.tolist(), np.append(first[1:], len(block_term)).tolist())))
                for query in queries.value:
                    found, scores, _, _ = search_shard(query, (doc_id, terms, impacts, bounds, here),
                                                       (by_term, members, cuts, of, most, of_bounds), k)
                    if len(found):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(found), query.item)), ids.take(pa.array(found)),
                             pa.array(scores)], names=["item", "doc_id", "score"])

    return index.drop("shard").mapInArrow(run, "item long, doc_id long, score long")


def _dealt(docs: DataFrame, cells: int) -> DataFrame:
    """``docs`` with their ``shard``: a cell, or one of as many parts of a cell
    as leave about ``SHARD`` documents each, however alike they are."""
    counts = {r["cell"]: r["n"] for r in docs.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = F.array(*[F.lit(math.ceil(counts.get(c, 0) / SHARD)) for c in range(cells)])
    part = F.pmod(F.xxhash64("uid"), F.greatest(F.lit(1), F.element_at(parts, F.col("cell") + 1)))
    return docs.withColumn("shard", (F.col("cell") + cells * part).cast("int"))


def _top(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _round(docs: DataFrame, items: list, k: int) -> DataFrame:
    """``item, rank, doc_id, score`` for a bounded list of (number, terms)."""
    sc = docs.sparkSession.sparkContext
    vocabulary = sorted({t for _, terms in items for t in terms})
    number, size = {t: i for i, t in enumerate(vocabulary)}, max(1, len(vocabulary))
    vectors = stored(_vectors(docs, sc.broadcast(vocabulary)))
    total, length = vectors.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    length = max(1, length or 0)
    df, weights = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
    for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[r["t"]] = r["count"]
    for t in np.flatnonzero(df).tolist():
        weights[t] = math.floor(1000 * math.log((2 * total + 2) / (2 * int(df[t]) + 1)))
    # 50 * n * N may need more than 64 bits on the way.
    scaled = F.lit(50).cast("decimal(3,0)") * F.col("n").cast("decimal(16,0)") * F.lit(total).cast("decimal(16,0)")
    m = F.lit(50) + F.expr("scaled div cast({} as decimal(20,0))".format(length))
    vectors = vectors.withColumn("scaled", scaled).withColumn("m", m.cast("long")).drop("scaled")
    every = max(1, total // SAMPLE)
    sample = vectors.where(F.size("terms") > 0).where(F.pmod(F.xxhash64("uid"), F.lit(every)) == 0) \
        .select("terms", "tf", "m").limit(2 * SAMPLE).toArrow()
    terms, bounds = _flat(sample.column("terms"))
    tf, m_of = _flat(sample.column("tf"))[0].astype(np.int64), np.repeat(sample.column("m").to_numpy(), np.diff(bounds))
    value = weights[terms] * (1_000_000_000 * tf // (1000 * tf + 20 * m_of))
    depth = min(DEPTH, max(0, math.ceil(math.log2(max(1, total) / SHARD))))
    cells = Cells.fit(sketches(terms, value, bounds, size), depth)
    weights_b = sc.broadcast(weights)
    impacts = stored(_impacts(vectors, weights_b, sc.broadcast(cells)))
    greatest = np.zeros(size, dtype=np.int64)
    pair = F.explode(F.arrays_zip("terms", "impacts")).alias("p")
    for r in impacts.select(pair).groupBy("p.terms").agg(F.max("p.impacts").alias("most")).collect():
        greatest[r["terms"]] = r["most"]
    known = []
    for item, words in items:
        ids = np.array(sorted(number[t] for t in words), dtype=np.int64)
        ids = ids[np.argsort(weights[ids] * greatest[ids], kind="stable")]
        known.append((item, ids, weights[ids]))
    found, floors = None, {}
    share = max(1, total // FIRST)
    wave = F.pmod(F.xxhash64("uid", F.lit(1)), F.lit(share))
    eighth = max(1, share // 8)
    waves = [wave == 0, (wave > 0) & (wave <= eighth), wave > eighth] if share > 1 else [F.lit(True)]
    for chosen in waves:
        queries = [Query(*q, floors.get(q[0], 1)) for q in known]
        part = _dealt(impacts.where(chosen), 1 << depth)
        index = stored(_index(part, sc.broadcast(asked_with(queries, greatest)), weights_b))
        hits = _search(index, sc.broadcast(queries), size, k).where("score > 0")
        found = stored(_top(hits if found is None else found.select("item", "doc_id", "score").union(hits), k))
        floors = {r["item"]: r["score"] for r in found.where(F.col("rank") == k).collect()}
    return found.select("item", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 50, item_id: str = "item_id") -> DataFrame:
    """The ``k`` best documents of each row of ``items``: ``item_id, rank,
    doc_id, score``, highest first, equal scores by ascending id, null ids last.

    Terms are runs of letters and digits (all code points from 80 on are
    letters), A-Z lower-cased. A document's score adds over the distinct terms of
    the item ``weight * ((10^9 tf) div (1000 tf + 20 m))``, weight and ``m`` from
    the counts of all documents with a term. Only scores above 0 are returned.

    Null and empty texts have no terms: such documents are in no count and such
    items find nothing. Long texts are read whole. Every row of either table
    counts for itself, repeated rows and ids too. No rows give no rows.

    The lists, weights and blocks are those of the terms that occur in items; the
    items are taken in rounds of about ``VOCABULARY`` term occurrences, which
    bounds what is broadcast. The first of three waves of documents is small; the
    scores known after each are the floors of the next. The cell tree is fitted on
    about ``SAMPLE`` documents and decides only who stands in a block with whom.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stored(item_terms(items.select(F.col(item_id).alias("item_id"), F.col("text").alias("text")))
                  .select("item_id", "terms", F.monotonically_increasing_id().alias("item")))
    occurrences = rows.agg(F.sum(F.size("terms"))).first()[0] or 0
    rounds = max(1, math.ceil(occurrences / VOCABULARY))
    out = None
    for r in range(rounds):
        mine = rows.where((F.pmod(F.xxhash64("item"), F.lit(rounds)) == r) & (F.size("terms") > 0))
        part = _round(docs, [(x["item"], x["terms"]) for x in mine.select("item", "terms").collect()], k)
        out = part if out is None else out.union(part)
    return out.join(rows.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
