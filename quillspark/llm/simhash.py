"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within 2r bits share a variant within r bits of both. So every
distinct fingerprint emits all variants in its ball of half the radius, the
variants are shuffled, and fingerprints that meet on one are verified by their
distance. Components of the verified links are the groups of copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .components import components
from .words import chunks, flat, spans

SEED = 42
PIECE = 1 << 16  # shingles whose bits are counted at a time


def _vote(hashes: list[int], counts: np.ndarray) -> None:
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1,
                         bitorder="little")
    counts += bits.sum(axis=0, dtype=np.int64)


def fingerprint(line: bytes, starts: np.ndarray, ends: np.ndarray, shingle: int) -> int:
    """Fingerprint of words that stand joined by single spaces in ``line``."""
    n = len(starts)
    if not n:
        return 0
    if n < shingle:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[:n - shingle + 1], ends[shingle - 1:]
    counts, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for k in range(0, len(starts), PIECE):
        _vote([digest(line[i:j], SEED) for i, j in zip(starts[k:k + PIECE].tolist(),
                                                       ends[k:k + PIECE].tolist())], counts)
    bits = (2 * counts > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprints(column: pa.Array, shingle: int) -> np.ndarray:
    data, bounds = flat(column)
    out = np.zeros(len(bounds) - 1, dtype=np.uint64)
    for first, last in chunks(bounds):
        low = bounds[first]
        part, local = data[low:bounds[last]], bounds[first:last + 1] - low
        part, starts, ends, owner = spans(part, local)
        # Words in one line with one byte between them: shingles are slices.
        sizes = ends - starts
        to = np.concatenate([[0], np.cumsum(sizes + 1)])
        line = np.full(int(to[-1]), 0x20, dtype=np.uint8)
        line[np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)] = \
            part[np.arange(int(sizes.sum()))
                 + np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)]
        line, at, to = line.tobytes(), to[:-1], to[:-1] + sizes
        cut = np.searchsorted(owner, np.arange(last - first + 1))
        for k in range(last - first):
            s = slice(cut[k], cut[k + 1])
            out[first + k] = fingerprint(line, at[s], to[s], shingle)
    return out


def with_fingerprint(docs: DataFrame, shingle: int = 3, text: str = "text") -> DataFrame:
    """The rows of ``docs`` without ``text``, plus ``fp`` (the 64 bits as a
    signed long)."""
    keep = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = _fingerprints(batch.column(len(keep)), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(fp)],
                                             names=[*keep, "fp"])

    schema = docs.select(*keep, F.lit(0).cast("long").alias("fp")).schema
    return docs.select(*keep, F.col(text).cast("string").alias(text)).mapInArrow(run, schema)


def ball(radius: int) -> list[int]:
    """Masks with up to ``radius`` of 64 bits set, as signed longs."""
    masks = [sum(1 << b for b in bits) for k in range(radius + 1)
             for bits in combinations(range(64), k)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fps: DataFrame, distance: int = 2) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (column ``fp``) of at most
    ``distance`` bits, enough of them to join whatever all of them would.

    Variants within ``ceil(distance / 2)`` bits meet. What meets on one variant
    lies in its ball, so there are at most as many as the ball has masks,
    whatever the size of a group of copies. For an even distance any two of them
    are linked, so neighbours in that list join all; for an odd one all its
    pairs are tried. Either way the bits decide.
    """
    half = (distance + 1) // 2
    masks = F.array(*[F.lit(m).cast("long") for m in ball(half)])
    variants = fps.select("fp", F.explode(F.transform(masks, lambda m: m.bitwiseXOR(F.col("fp"))))
                          .alias("variant"))
    met = Window.partitionBy("variant").orderBy("fp")
    pairs = variants.select("fp", F.lag("fp").over(met).alias("before"))
    if distance % 2:  # odd: the ball is wider than half, so all pairs of a ball are tried
        left = variants.select("variant", F.col("fp").alias("before"))
        pairs = variants.join(left, "variant").where("before < fp").select("fp", "before")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("before"))) <= distance
    return pairs.where(F.col("before").isNotNull() & near) \
        .select(F.col("before").alias("a"), F.col("fp").alias("b")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``doc_id, keep..., fp, component_id, root``, the
    root being the fingerprint that names the component.

    Words are runs without blanks or the controls 09-0D, A-Z lower-cased;
    shingles hash by XXH64 with seed 42; a bit is set where more than half of
    the shingles set it. ``component_id`` is the smallest id that a chain of
    links of at most ``distance`` bits reaches, the own one included.

    Null and empty texts have the fingerprint 0, linked like any other. Texts
    shorter than a shingle hash whole. Copies share a fingerprint, so they are
    one node: a group of any size costs its rows only, met by partial minima.
    Null ids are never the smallest unless all of the component are null.
    Repeated rows come out repeated. No rows give no rows.
    """
    rows = stored(with_fingerprint(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keep,
                                               F.col("text").cast("string").alias("text")), shingle))
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = components(links(nodes.select("fp"), distance))
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left") \
        .select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    of = placed.join(lowest, "root").select("fp", "component_id", "root")
    return rows.join(of, "fp").select("doc_id", *keep, "fp", "component_id", "root")
