"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams.

Words, word pairs and pairs with one word skipped are hashed to coordinates.
Parts of the labelled rows are learned by one task each, row by row, with a
rate per coordinate and L1 sparsity; the parts' weights are averaged, each by
the evidence it has on the coordinate. Few weights are not zero, so they fit a
broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .labelled import fold, training_rows
from .words import Powers, chunks, flat, scramble, spans

BITS = 20  # coordinates are 2 ** BITS
PART_ROWS = 8192  # labelled rows learned by one task
MOST_ROWS = 65536  # labelled rows learned at most
EPOCHS = 6
PIECE = 1 << 18  # bytes of text whose n-grams are made at a time
ALPHA, BETA = 8.0, 1.0  # rate per coordinate: ALPHA / (BETA + root of its squared gradients)
# Sparsity; chance alone moves a gradient sum by the root of its rows. Chosen on an
# inner fold: learned from crc32 remainder 0, compared on remainder 2.
L1_PER_ROOT = 0.25
PREDICT = 0.7

# Word characters: letters, digits and all bytes of other scripts.
_SEPARATOR = np.ones(256, dtype=bool)
_SEPARATOR[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_PAIR, _SKIP = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)


def grams(data: np.ndarray, bounds: np.ndarray, powers: Powers,
          bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of all n-grams of the texts, and the text each is of."""
    data, starts, ends, owner = spans(data, bounds, _SEPARATOR)
    h = scramble(powers.stretch(powers.sums(data), starts, ends))
    out, of = [h], [owner]
    for step, factor in ((1, _PAIR), (2, _SKIP)):
        same = owner[step:] == owner[:-step]
        out.append(scramble(h[:-step][same] * factor + h[step:][same]))
        of.append(owner[step:][same])
    coordinates = np.concatenate(out) >> np.uint64(64 - bits)
    return coordinates.astype(np.int64), np.concatenate(of)


def _sigmoid(x: np.ndarray | float) -> np.ndarray | float:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


class Ftrl:
    """FTRL-proximal with binary features; coordinate 0 is the bias, which is
    not thinned."""

    def __init__(self, size: int, l1: float):
        self.z, self.n, self.l1 = np.zeros(size), np.zeros(size), l1

    def weights(self, i: np.ndarray) -> np.ndarray:
        z = self.z[i]
        l1 = np.where(i == 0, 0.0, self.l1)
        w = -(z - np.sign(z) * l1) / (BETA + np.sqrt(self.n[i])) * ALPHA
        return np.where(np.abs(z) <= l1, 0.0, w)

    def learn(self, i: np.ndarray, label: int) -> None:
        w = self.weights(i)
        g = float(_sigmoid(w.sum())) - label
        n = self.n[i]
        self.z[i] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[i] = n + g * g


def _train_part(part: pa.Table) -> pa.Table:
    """Weights of one part. Its coordinates stand in one array, four bytes each:
    they are what the task holds while it learns."""
    part = part.select(["text", "label", "part"]) \
        .sort_by([(c, "ascending") for c in ("part", "label", "text")])
    powers, found, sizes = Powers(), [], [np.zeros(1, np.int64)]
    labels = part.column("label").to_pylist()
    data, bounds = flat(part.column("text"))
    for first, last in chunks(bounds, PIECE):
        low = bounds[first]
        i, of = grams(data[low:bounds[last]], bounds[first:last + 1] - low, powers, BITS)
        pairs = np.unique(of * (1 << BITS) + i)
        found.append((pairs & ((1 << BITS) - 1)).astype(np.int32))
        sizes.append(np.bincount(pairs >> BITS, minlength=last - first))
    rows, cut = np.concatenate(found), np.cumsum(np.concatenate(sizes))
    del part, data, bounds, powers, found, sizes
    seen = np.zeros(1 << BITS, dtype=bool)
    seen[rows] = True
    rows = np.cumsum(seen, dtype=np.int32)[rows]  # from 1: the bias comes first
    model = Ftrl(int(seen.sum()) + 1, L1_PER_ROOT * len(labels) ** 0.5)
    for _ in range(EPOCHS):
        for label, a, b in zip(labels, cut, cut[1:]):
            model.learn(np.append(0, rows[a:b]), label)
    del rows
    size = len(model.z)
    w = [model.weights(np.arange(a, min(a + PIECE, size))) for a in range(0, size, PIECE)]
    return pa.table({"i": np.append(0, np.flatnonzero(seen) + 1).astype(np.int32),
                     "w": np.concatenate(w), "n": model.n})


def train(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and weights, bias first, from ``text, label, part``. At most
    2 ** BITS + 1 rows reach the driver, in practice some thousands."""
    parts = max(1, round(rows.count() / PART_ROWS))
    part = F.least(F.floor(F.col("part") * parts), F.lit(parts - 1)).cast("int")
    found = rows.withColumn("task", part).groupBy("task").applyInArrow(
        lambda part: _train_part(part), "i int, w double, n double")
    # A part without evidence on a coordinate has no say on it.
    mixed = found.where("n > 0").groupBy("i") \
        .agg((F.sum(F.col("w") * F.col("n")) / F.sum("n")).alias("w")).where("w <> 0").toPandas().sort_values("i")
    return mixed["i"].to_numpy(np.int64), mixed["w"].to_numpy()


def score_rows(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], keep: list[str],
               text: str = "text") -> DataFrame:
    """``keep`` plus ``score`` in (0, 1). A text that is kept goes to the tasks
    once, and rows come back in pieces of about PIECE bytes of text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, w = shared.value
        dense = np.zeros((1 << BITS) + 1, dtype=np.float32)
        dense[at] = w
        bias, powers = float(dense[0]), Powers()
        for batch in batches:
            kept = batch.select(keep)
            data, bounds = flat(batch.column(text))
            for first, last in chunks(bounds, PIECE):
                low = bounds[first]
                i, of = grams(data[low:bounds[last]], bounds[first:last + 1] - low, powers, BITS)
                hit = dense[i + 1] != 0
                pairs = np.unique(of[hit] * (1 << BITS) + i[hit])
                total = bias + np.bincount(
                    pairs >> BITS, weights=dense[(pairs & ((1 << BITS) - 1)) + 1],
                    minlength=last - first)
                yield pa.RecordBatch.from_arrays(
                    [*kept.slice(first, last - first).columns, pa.array(_sigmoid(total), pa.float64())],
                    names=[*keep, "score"])

    schema = docs.select(*keep, F.lit(0.0).alias("score")).schema
    read = [] if text in keep else [F.col(text).cast("string").alias(text)]
    return docs.select(*keep, *read).mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",),
             folds: int = 3, held_out: int = 1, most: int = MOST_ROWS) -> DataFrame:
    """Score every document: ``keep, score, predicted, held_out``.

    Learned from at most about ``most`` labelled rows outside the held-out fold
    (crc32 of the id as text modulo ``folds``). Only the text is an input.

    Null and empty texts have no n-gram; the bias alone scores them. Without
    labelled rows the bias is 0, so every score is 0.5. Texts of any length are
    read whole, in chunks. Repeated rows and ties score alike. No rows give no
    rows. Other columns, whatever their names, are ignored.
    """
    rows = stored(training_rows(docs, labels, "toxic", folds, held_out, most, "toxic"))
    model = train(rows)
    if not len(model[0]):
        model = (np.zeros(1, np.int64), np.zeros(1))
    kept = "text" in keep and dict(docs.dtypes)["text"] == "string"
    base = docs.select(*[F.col(c).alias(f"k_{c}") for c in keep],
                       (fold("doc_id", folds) == held_out).alias("held_out"),
                       *[] if kept else ["text"])
    out = score_rows(base, model, [f"k_{c}" for c in keep] + ["held_out"], "k_text" if kept else "text")
    return out.select(*[F.col(f"k_{c}").alias(c) for c in keep], "held_out", "score",
                      (F.col("score") >= PREDICT).cast("int").alias("predicted"))
