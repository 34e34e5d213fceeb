"""Nearest neighbours through learned partitions.

The neighbour graph of a bounded sample is cut into balanced parts that keep
neighbours together, and a small classifier learns in which parts a vector has
its neighbours. Every row is indexed under its most probable part; a query goes
to its several most probable ones, and what is there is ranked by exact
distance. How many that are is measured: exact neighbours of a few hundred
vectors that the classifier has not seen, found among all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SAMPLE = 16384  # vectors the index is fitted on
PARTS = 512  # at most; twice the root of the rows, if that is less
MEMBERS = 16  # vectors of the sample in a part, at least
GRAPH = 10  # neighbours in the graph
TRIED = 512  # vectors whose exact neighbours set the number of probes
RECALL = 0.92  # of these neighbours that the probes must reach
BLOCK = 4096  # vectors, or queries, that meet in one task's product


def neighbours(x: np.ndarray, k: int) -> np.ndarray:
    """Nearest other rows of each row, some rows at a time."""
    norm = (x * x).sum(axis=1)
    out = np.empty((len(x), k), dtype=np.int64)
    for a in range(0, len(x), 256):
        d = norm[None, :] - 2 * x[a:a + 256] @ x.T
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
        # Copied: a slice kept would keep the order of all rows behind it.
        out[a:a + 256] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(near: np.ndarray, parts: int, rounds: int = 60) -> np.ndarray:
    """Parts of equal size (to one) with few graph edges between them, by
    bisection: order each piece by the second eigenvector of its graph, halve
    it, then swap the pairs that gain most."""
    n = len(near)
    part = np.zeros(n, dtype=np.int64)
    rng = np.random.default_rng(0)
    rows, cols = np.repeat(np.arange(n), near.shape[1]), near.ravel()
    rows, cols = np.concatenate([rows, cols]), np.concatenate([cols, rows])
    pieces = 1
    while pieces < parts:
        inside = part[rows] == part[cols]
        r, c = rows[inside], cols[inside]
        degree = np.bincount(r, minlength=n) + 1e-9
        v = rng.standard_normal(n)
        for _ in range(rounds):
            v = (np.bincount(r, weights=v[c], minlength=n) / degree + v) / 2
            v -= (np.bincount(part, weights=v * degree)
                  / np.bincount(part, weights=degree))[part]
            v /= np.sqrt(np.bincount(part, weights=v * v) + 1e-300)[part]
        order = np.lexsort((v, part))
        size = np.bincount(part, minlength=pieces)
        place = np.empty(n, dtype=np.int64)
        place[order] = np.arange(n) - np.repeat(np.cumsum(size) - size, size)
        side = (place >= (size[part] + 1) // 2).astype(np.int64)
        for _ in range(8):
            other = np.bincount(r, weights=side[r] != side[c], minlength=n)
            gain = 2 * other - np.bincount(r, minlength=n)
            moved = False
            for p in range(pieces):
                zero = np.flatnonzero((part == p) & (side == 0))
                one = np.flatnonzero((part == p) & (side == 1))
                zero, one = zero[np.argsort(-gain[zero])], one[np.argsort(-gain[one])]
                m = min(len(zero), len(one)) // 8 + 1
                zero, one = zero[:m], one[:m]
                m = min(len(zero), len(one))
                good = np.flatnonzero(gain[zero[:m]] + gain[one[:m]] > 2)
                side[zero[good]], side[one[good]] = 1, 0
                moved |= bool(len(good))
            if not moved:
                break
        part = part * 2 + side
        pieces *= 2
    return part


def odds(x: np.ndarray, model: dict[str, np.ndarray]) -> np.ndarray:
    """Log-odds of the parts, up to a constant of each row."""
    return (x - model["mean"]) / model["scale"] @ model["w"] + model["b"]


def _learn(x: np.ndarray, part: np.ndarray, goal: np.ndarray, epochs: int = 5) -> dict:
    """Multinomial logistic regression, begun at the centres of the parts."""
    rng = np.random.default_rng(1)
    parts = goal.shape[1]
    mean, scale = x.mean(axis=0), np.array([x.std() + 1e-12])
    z = (x - mean) / scale
    centres = np.zeros((parts, x.shape[1]))
    np.add.at(centres, part, z)
    centres /= np.bincount(part, minlength=parts)[:, None]
    length = np.linalg.norm(centres, axis=1).mean() + 1e-12
    weights = {"w": centres.T / length, "b": -(centres * centres).sum(axis=1) / (2 * length)}
    first, second = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for a in range(0, len(x), 256):
            i = order[a:a + 256]
            out = z[i] @ weights["w"] + weights["b"]
            p = np.exp(out - out.max(axis=1, keepdims=True))
            d = (p / p.sum(axis=1, keepdims=True) - goal[i]) / len(i)
            step += 1
            for k, g in (("w", z[i].T @ d), ("b", d.sum(axis=0))):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                weights[k] -= 0.002 * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return {"mean": mean, "scale": scale, **weights}


def fit(x: np.ndarray, parts: int = PARTS) -> dict[str, np.ndarray]:
    """Classifier of the parts in which a vector has its neighbours."""
    x = np.unique(np.asarray(x, dtype=np.float64), axis=0)
    parts = max(1, min(parts, len(x) // MEMBERS))
    parts = 1 << int(np.log2(parts))
    if parts == 1:
        dim = x.shape[1]
        return {"mean": np.zeros(dim), "scale": np.ones(1), "w": np.zeros((dim, 1)),
                "b": np.zeros(1)}
    k = min(GRAPH, len(x) - 1)
    near = neighbours(x, k)
    part = balanced_parts(near, parts)
    goal = np.zeros((len(x), parts))
    np.add.at(goal, (np.repeat(np.arange(len(x)), k), part[near].ravel()), 1 / k)
    return _learn(x, part, goal)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def rank_block(c_ids: np.ndarray, c: np.ndarray, q_ids: np.ndarray, q: np.ndarray,
               k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest candidates of each query by exact distance, ties to the
    smaller id, the query's own id left out: query ids, ids, distances. Equal
    vectors are compared once and stand for their smallest ids."""
    vectors, group = np.unique(c, axis=0, return_inverse=True)
    group = group.ravel()
    order = np.lexsort((c_ids, group))
    starts = np.searchsorted(group[order], np.arange(len(vectors)))
    ids = c_ids[order]
    ends = np.append(starts[1:], len(ids))
    norm = (vectors * vectors).sum(axis=1)
    t = min(k + 1, len(vectors))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a in range(0, len(q), 256):
        rough = norm[None, :] - 2 * q[a:a + 256] @ vectors.T
        bound = np.partition(rough, t - 1, axis=1)[:, t - 1]
        for r, row in enumerate(rough):
            slack = 1e-9 * (1 + abs(bound[r]) + float(q[a + r] @ q[a + r]))
            # Sums that overflow compare with nothing, so those rows stay in.
            near = np.flatnonzero(~(row > bound[r] + slack))
            exact = np.sqrt(((vectors[near] - q[a + r]) ** 2).sum(axis=1))
            mine = [ids[starts[g]:min(ends[g], starts[g] + k + 1)] for g in near]
            dist, mine = np.repeat(exact, [len(m) for m in mine]), np.concatenate(mine)
            dist, mine = dist[mine != q_ids[a + r]], mine[mine != q_ids[a + r]]
            best = np.lexsort((mine, dist))[:k]
            found.append((np.full(len(best), q_ids[a + r]), mine[best], dist[best]))
    return tuple(np.concatenate(x) for x in zip(*found))


def probes_for(order: np.ndarray, asked: np.ndarray, parts: np.ndarray,
               recall: float = RECALL) -> int:
    """Probes that reach ``recall`` of known neighbours: ``order`` ranks the
    parts of each query, ``asked`` and ``parts`` name query and part of every
    neighbour. All parts, if there is no neighbour to go by."""
    rank = np.argsort(order, axis=1)[asked, parts]
    reached = np.cumsum(np.bincount(rank, minlength=order.shape[1]))
    enough = np.flatnonzero(reached >= max(1, recall * len(rank)))
    return int(enough[0]) + 1 if len(enough) else order.shape[1]


class Index(NamedTuple):
    """A fitted index: the classifier, all rows with their part
    (``vec_id, v, part``), rows by part, and how many parts a query probes."""

    model: dict[str, np.ndarray]
    rows: DataFrame
    sizes: dict[int, int]
    probes: int


def _shared_hash(name: str) -> Column:
    """Place of a row from 0 to 1, the same in every run."""
    return F.pmod(F.xxhash64(F.lit(name), F.col("vec_id"), F.col("v")),
                  F.lit(1 << 30)) / float(1 << 30)


def build(vectors: DataFrame, k: int = 10, vec: str = "embedding",
          parts: int | None = None) -> Index | None:
    """The index of all usable rows, repeated rows once; None without any."""
    usable = F.col(vec).isNotNull() & (F.size(vec) > 0) & ~F.exists(
        vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) \
        & F.exists(vec, lambda x: x != 0)
    rows = vectors.where(F.col("vec_id").isNotNull() & usable) \
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vec).alias("v")) \
        .dropDuplicates(["vec_id", "v"])
    rows = stored(rows)
    lengths = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    if not lengths:
        return None
    dim, total = lengths[0]["dim"], lengths[0]["n"]
    rows = rows.where(F.size("v") == dim)
    parts = parts or min(PARTS, 1 << round(np.log2(2 * np.sqrt(total))))
    tried = min(TRIED / total, 0.25)
    place = _shared_hash("sample")
    sample = rows.where((place >= tried) & (place < tried + SAMPLE / total))
    if sample.isEmpty():  # so few rows that the hash took none
        sample = rows.limit(SAMPLE)

    def fitted(pdf: pd.DataFrame) -> pd.DataFrame:
        with np.errstate(all="ignore"):
            model = fit(np.array(sorted(map(tuple, pdf["v"])), dtype=np.float64), parts)
        return pd.DataFrame({"name": list(model),
                             "shape": [list(v.shape) for v in model.values()],
                             "data": [v.astype(np.float64).tobytes() for v in model.values()]})

    got = sample.select("v", F.lit(0).alias("one")).groupBy("one").applyInPandas(
        fitted, "name string, shape array<int>, data binary").collect()
    model = {r["name"]: np.frombuffer(bytes(r["data"])).reshape(r["shape"]) for r in got}
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with np.errstate(all="ignore"):
                part = odds(_matrix(batch.column("v")), shared.value).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part.astype(np.int32))],
                                             names=["vec_id", "v", "part"])

    kind = dict(rows.dtypes)["v"]
    index = stored(rows.mapInArrow(assign, f"vec_id long, v {kind}, part int"))
    sizes = {r["part"]: r["n"] for r in index.groupBy("part").agg(
        F.count(F.lit(1)).alias("n")).collect()}  # one row per part
    return Index(model, index, sizes, _probes(rows.where(place < tried), index, model, k))


def _probes(asked: DataFrame, index: DataFrame, model: dict, k: int) -> int:
    """Probes by the exact neighbours of about TRIED rows among all: each task
    keeps the k nearest of its rows, of which the k nearest of all count."""
    queries = asked.orderBy("vec_id", "v").collect()  # about TRIED distinct rows
    if not queries:
        return len(model["b"])
    ids = np.array([r["vec_id"] for r in queries])
    x = np.array([r["v"] for r in queries], dtype=np.float64)
    shared = index.sparkSession.sparkContext.broadcast((ids, x))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, x = shared.value
        best = np.full((len(x), k), np.inf)
        where = np.zeros((len(x), k), dtype=np.int64)
        few = (b.slice(i, 2048) for b in batches for i in range(0, len(b), 2048))
        for batch in few:
            rows, v = batch.column("vec_id").to_numpy(), _matrix(batch.column("v"))
            part = batch.column("part").to_numpy()
            with np.errstate(all="ignore"):
                far = (x * x).sum(axis=1)[:, None] + (v * v).sum(axis=1) - 2 * x @ v.T
            far = np.where((ids[:, None] == rows) | ~np.isfinite(far), np.inf, far)
            far = np.concatenate([best, far], axis=1)
            place = np.concatenate([where, np.broadcast_to(part, (len(x), len(part)))], axis=1)
            keep = np.argpartition(far, k - 1, axis=1)[:, :k]
            best = np.take_along_axis(far, keep, axis=1)
            where = np.take_along_axis(place, keep, axis=1)
        some = np.isfinite(best)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.nonzero(some)[0]), pa.array(where[some]), pa.array(best[some])],
            names=["query", "part", "far"])

    first = Window.partitionBy("query").orderBy("far", "part")
    found = index.mapInArrow(nearest, "query long, part long, far double") \
        .withColumn("n", F.row_number().over(first)).where(F.col("n") <= k) \
        .select("query", "part").collect()  # k rows of each query
    if not found:
        return len(model["b"])
    with np.errstate(all="ignore"):
        order = np.argsort(-odds(x, model), axis=1, kind="stable")
    return probes_for(order, np.array([r["query"] for r in found]),
                      np.array([r["part"] for r in found]))


def search(vectors: DataFrame, k: int = 10, every: int = 100, vec: str = "embedding",
           parts: int | None = None) -> DataFrame:
    """Nearest neighbours of the rows whose ``vec_id`` is divisible by
    ``every``, among all other rows: ``query_id, rank, vec_id, score``, the
    score being the Euclidean distance in double precision.

    The index is fitted on about SAMPLE rows by hash; every row is indexed.
    A query probes as many parts as reach RECALL of the exact neighbours of
    about TRIED other rows, and further ones until they hold more than k rows,
    so it misses rows only if the others found are k.

    Vectors that are null, zero, or hold nulls or non-finite numbers take no
    part, nor do null ids and vectors of another length than most. Ties go to
    the smaller id. Repeated rows count once; an id with several vectors is
    several candidates, none of them for its own queries. No rows give no rows.
    Other columns are ignored. Parts are split into blocks of about BLOCK rows
    by hash, so one frequent vector, whose part may hold a third of the rows,
    is ranked by many tasks; the best k of each block meet in a grouped top k.
    """
    index = build(vectors, k, vec, parts)
    if index is None:
        return vectors.sparkSession.createDataFrame(
            [], "query_id long, rank int, vec_id long, score double")
    return _ranked(index, index.rows.where(F.col("vec_id") % every == 0), k)


def _ranked(index: Index, queries: DataFrame, k: int) -> DataFrame:
    """The k nearest rows of each query in the parts it probes."""
    sizes, probes = index.sizes, index.probes
    held = np.array([sizes.get(p, 0) for p in range(len(index.model["b"]))])
    shared = queries.sparkSession.sparkContext.broadcast((index.model, held))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, held = shared.value
        for batch in batches:
            with np.errstate(all="ignore"):
                order = np.argsort(-odds(_matrix(batch.column("v")), model), axis=1, kind="stable")
            before = np.cumsum(held[order], axis=1) - held[order]
            take = ((np.arange(len(held)) < probes) | (before <= k)) & (held[order] > 0)
            flat = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(take.sum(axis=1))), pa.int32()),
                pa.array(order[take], pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], flat],
                                             names=["vec_id", "v", "parts"])

    kind = dict(queries.dtypes)["v"]
    asked = stored(queries.mapInArrow(choose, f"vec_id long, v {kind}, parts array<int>")
                   .select(F.col("vec_id").alias("query_id"), "v", F.explode("parts").alias("part")))
    blocks = {p: -(-n // BLOCK) for p, n in sizes.items()}
    turns = {r["part"]: -(-r["n"] // BLOCK) for r in asked.groupBy("part").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    if not turns:
        turns = {0: 1}
    named = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])
    spread = lambda col, n: F.pmod(F.xxhash64(F.lit(col), F.col(col)), n).cast("int")
    left = index.rows.where(F.col("part").isin(list(turns))).select(
        "vec_id", "v", "part", spread("vec_id", named(blocks)[F.col("part")]).alias("block"),
        F.explode(F.sequence(F.lit(0), named(turns)[F.col("part")] - 1)).alias("turn"))
    right = asked.select(
        "query_id", "v", "part", spread("query_id", named(turns)[F.col("part")]).alias("turn"),
        F.explode(F.sequence(F.lit(0), named(blocks)[F.col("part")] - 1)).alias("block"))

    def meet(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(c) or not len(q):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        qi, vi, d = rank_block(c["vec_id"].to_numpy(), np.stack(c["v"].to_numpy()).astype(np.float64),
                               q["query_id"].to_numpy(),
                               np.stack(q["v"].to_numpy()).astype(np.float64), k)
        return pd.DataFrame({"query_id": qi, "vec_id": vi, "score": d})

    key = ["part", "block", "turn"]
    near = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
        meet, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
