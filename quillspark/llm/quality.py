"""Quality by nearest-neighbour voting in a latent-semantic space.

A bounded sample of labelled texts is turned to weighted term counts and
reduced by a singular value decomposition. The labelled latent vectors are
broadcast; every document is projected the same way, its exact cosines with all
of them are computed in blocks, and the nearest vote with their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .labelled import fold, training_rows
from .words import Powers, chunks, flat, scramble, spans

MOST_ROWS = 8192  # labelled vectors, the size of the broadcast
TERMS = 1024  # hashed terms: words in the lower half, word forms in the upper
RANK = 48
NEIGHBOURS = 15
SHARPNESS = 4  # power of the similarity in a vote
PREDICT = 0.7


def term_counts(data: np.ndarray, bounds: np.ndarray, powers: Powers) -> np.ndarray:
    """Term counts of each text. Terms are words, and of each word its last
    three bytes, and whether it is the word before again."""
    texts, half = len(bounds) - 1, TERMS // 2
    data, starts, ends, owner = spans(data, bounds)
    sums = powers.sums(data)
    whole = scramble(powers.stretch(sums, starts, ends))
    tail = scramble(powers.stretch(sums, np.maximum(starts, ends - 3), ends) + np.uint64(1))
    again = np.flatnonzero((whole[1:] == whole[:-1]) & (owner[1:] == owner[:-1])) + 1
    terms = np.concatenate([(whole % np.uint64(half)).astype(np.int64),
                            half + 1 + (tail % np.uint64(half - 1)).astype(np.int64),
                            np.full(len(again), half)])
    of = np.concatenate([owner, owner, owner[again]])
    return np.bincount(of * TERMS + terms, minlength=texts * TERMS) \
        .reshape(texts, TERMS).astype(np.float32)


def counts_of(column: pa.Array, powers: Powers) -> Iterator[tuple[int, int, np.ndarray]]:
    data, bounds = flat(column)
    for first, last in chunks(bounds):
        for a in range(first, last, 1024):
            b = min(last, a + 1024)
            low = bounds[a]
            yield a, b, term_counts(data[low:bounds[b]], bounds[a:b + 1] - low, powers)


def _weighted(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * rarity
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _fit(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["part", "label", "text"], kind="stable")
    powers = Powers()
    column = pa.array(pdf["text"].fillna("").tolist(), pa.large_string())
    counts = np.concatenate([c for _, _, c in counts_of(column, powers)])
    rarity = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
    x = _weighted(counts, rarity)
    values, vectors = np.linalg.eigh((x.T @ x).astype(np.float64))
    axes = vectors[:, ::-1][:, :RANK].astype(np.float32)
    axes *= np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
    latent = _unit(x @ axes).astype(np.float32)
    labels = pdf["label"].to_numpy(np.float32)
    return pd.DataFrame({"name": ["rarity", "axes", "latent", "labels"],
                         "data": [a.astype(np.float32).tobytes()
                                  for a in (rarity, axes, latent, labels)]})


def fit(rows: DataFrame) -> dict[str, np.ndarray]:
    """Term weights, axes, labelled latent vectors and labels from ``text,
    label, part``; one task over the bounded sample."""
    found = rows.groupBy(F.lit(0).alias("all")).applyInPandas(
        lambda pdf: _fit(pdf), "name string, data binary").collect()
    model = {r["name"]: np.frombuffer(bytes(r["data"]), np.float32) for r in found}
    if model:
        model["axes"] = model["axes"].reshape(TERMS, -1)
        model["latent"] = model["latent"].reshape(len(model["labels"]), -1)
    return model


def vote(latent: np.ndarray, model: dict[str, np.ndarray]) -> np.ndarray:
    labels = model["labels"]
    near = latent @ model["latent"].T
    k = min(NEIGHBOURS, near.shape[1])
    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(near, top, axis=1), 0.0).astype(np.float64) ** SHARPNESS
    total = weight.sum(axis=1)
    share = (weight * labels[top]).sum(axis=1) / np.maximum(total, 1e-300)
    return np.where(total > 0, np.clip(share, 0, 1), float(labels.mean()))


def quality(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",),
            folds: int = 4, held_out: int = 2, most: int = MOST_ROWS) -> DataFrame:
    """Score every document: ``keep, held_out, score, predicted``.

    At most about ``most`` labelled rows outside the held-out fold (crc32 of
    the id as text modulo ``folds``) are learned and broadcast. Only the text
    is an input.

    Null and empty texts have no direction; the share of label 1 scores them.
    Without labelled rows every score is 0.5. Texts are read whole, in chunks.
    Repeated rows score alike; of labelled vectors that tie for the last place
    any votes. No rows give no rows. Other columns are ignored.
    """
    rows = stored(training_rows(docs, labels, "quality", folds, held_out, most, "quality"))
    model = fit(rows)
    base = docs.select(*[F.col(c).alias(f"k_{c}") for c in keep],
                       (fold("doc_id", folds) == held_out).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    shared, names = docs.sparkSession.sparkContext.broadcast(model), base.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, powers = shared.value, Powers()
        for batch in batches:
            score = np.full(batch.num_rows, 0.5)
            for a, b, counts in counts_of(batch.column(len(names)), powers) if model else ():
                latent = _unit(_weighted(counts, model["rarity"]) @ model["axes"])
                score[a:b] = vote(latent, model)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(names)], pa.array(score, pa.float64())],
                names=[*names, "score"])

    schema = base.select(*names, F.lit(0.0).alias("score")).schema
    return base.mapInArrow(run, schema).select(
        *[F.col(f"k_{c}").alias(c) for c in keep], "held_out", "score",
        (F.col("score") >= PREDICT).cast("int").alias("predicted"))
