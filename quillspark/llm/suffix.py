"""Removal of repeated byte strings by distributed prefix doubling.

A rank names what stands in a stretch of bytes. Positions start with the rank
of a short stretch; Spark sorts them by (rank, rank of what surrounds it),
those whose rank is unique drop out, and the others go on with longer
stretches, until the length asked for is reached. Two things keep the tables
far below one row per byte:

* Windows of the full length are handled in blocks. Each window names the
  least hash among its short stretches as its anchor, which depends on its own
  bytes only, so equal windows have their anchors at the same place. Windows in
  a row with one anchor are a block: (core = the stretch all of them hold,
  context = all bytes any of them holds).
* A core that occurs once settles its whole block as unique, a context that
  occurs twice as repeated. Only blocks with a repeated core in different
  contexts are cut into smaller ones with longer cores, one block for each
  different context, down to single windows.

So a text with thousands of copies is ranked once beyond the first step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, text_or_empty
from .words import Powers, chunks, flat, flat_bytes, scramble

SEED = 48  # bytes of the first stretches
STEP = 24  # windows in a block of the second round
SEGMENT = 1 << 21  # windows of one text handled at a time
_PLACE = np.uint64((1 << 22) - 1)

_ROW = "core long, context long, id long, hash long, block long, at long, n int, back int"
_NAMES = [c.split()[0] for c in _ROW.split(", ")]


def _powers() -> tuple[Powers, Powers]:
    return Powers(), Powers(base=0xD1B54A32D192ED03, seed=11)


def blocks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int,
           powers: tuple[Powers, Powers]) -> tuple[np.ndarray, ...]:
    """Blocks of the windows that begin in [starts[k], ends[k]) of ``data``:
    core rank, context rank, text k, first window, number of windows, and how
    far the anchor stands behind the first window."""
    wide = length - SEED + 1
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none, none
    sums = powers[0].sums(data)
    grams = scramble(powers[0].stretch(sums, np.arange(len(data) - SEED + 1),
                                       np.arange(SEED, len(data) + 1)))
    # Sliding minimum by doubling; of equal hashes the last in the window.
    low = (grams & ~_PLACE) | (_PLACE - np.arange(len(grams), dtype=np.uint64))
    span = 1
    while span * 2 <= wide:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if wide > span:
        low = np.minimum(low[:span - wide], low[wide - span:])
    anchor = (_PLACE - (low & _PLACE)).astype(np.int64)
    owner = np.full(len(anchor), -1, dtype=np.int64)
    for k in np.flatnonzero(ends > starts):
        owner[starts[k]:ends[k]] = k
    new = np.ones(len(anchor), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(anchor)))
    real = owner[first] >= 0
    first, n = first[real], n[real]
    sums = powers[1].sums(data)
    context = scramble(powers[1].stretch(sums, first, first + n + length - 1)
                       + n.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)
                       + (anchor[first] - first).astype(np.uint64))
    return (grams[anchor[first]].view(np.int64), context.view(np.int64), owner[first], first, n,
            anchor[first] - first)


def _emit(docs: DataFrame, length: int) -> DataFrame:
    """Blocks of all texts (``id, hash, text``) as rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _powers()

        def rows(ids, hashes, offset, found):
            core, context, owner, first, n, back = found
            owned, at = pa.array(owner), pa.array(first - offset[owner])
            return pa.RecordBatch.from_arrays(
                [pa.array(core), pa.array(context), ids.take(owned), hashes.take(owned), at, at,
                 pa.array(n, pa.int32()), pa.array(back, pa.int32())], names=_NAMES)

        for batch in batches:
            data, bounds = flat(batch.column(2))
            for a, b in chunks(bounds):
                low, size = bounds[a], bounds[b] - bounds[a]
                ids, hashes = batch.column(0)[a:b], batch.column(1)[a:b]
                if size <= SEGMENT:
                    edges = bounds[a:b + 1] - low
                    found = blocks(data[low:bounds[b]], edges[:-1], edges[1:] - length + 1,
                                   length, powers)
                    yield rows(ids, hashes, edges[:-1], found)
                else:  # one long text, in segments that share the last window
                    for cut in range(0, int(size) - length + 1, SEGMENT):
                        part = data[low + cut:min(low + cut + SEGMENT + length - 1, bounds[b])]
                        found = blocks(part, np.array([0]), np.array([len(part) - length + 1]),
                                       length, powers)
                        yield rows(ids, hashes, np.array([-cut]), found)

    return docs.select("id", "hash", "text").mapInArrow(run, _ROW)


def rerank(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round over block rows: those that are repeated whole, and for each
    context of a core that has several, one block to be cut further.

    Counts are partial sums, written before they are joined: so both sides of
    the joins are plain shuffles, and Spark may split those of a frequent core.
    """
    often = stored(rows.groupBy("core").agg(F.count(F.lit(1)).alias("times"))
                   .where("times > 1").select("core"))
    alive = stored(rows.join(often, "core"))
    one = F.min(F.struct("id", "hash", "block", "at", "n", "back")).alias("one")
    classes = stored(alive.groupBy("core", "context").agg(F.count(F.lit(1)).alias("times"), one))
    whole = alive.join(classes.where("times > 1").select("core", "context"), ["core", "context"])
    several = stored(classes.groupBy("core").agg(F.count(F.lit(1)).alias("contexts"))
                     .where("contexts > 1").select("core"))
    return whole.select("id", "hash", "at", "n"), classes.join(several, "core").select("one.*")


def _packed(docs: DataFrame) -> DataFrame:
    """The last column, ``text``, as compressed bytes, for shuffles of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            data, bounds = flat(batch.column(batch.num_columns - 1))
            texts = [squeeze.compress(data[a:b].tobytes()) for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.binary())],
                                             names=batch.schema.names)

    schema = docs.withColumn("text", F.col("text").cast("binary")).schema
    return docs.mapInArrow(run, schema)


def _contexts(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The wanted blocks with the bytes of their contexts. Rows that repeat an
    id and its text bring the text once: their repeats are settled before."""
    lists = wanted.groupBy("id", "hash").agg(
        F.collect_list(F.struct("block", "at", "n", "back")).alias("cuts"))
    met = _packed(texts.select("id", "hash", "text")).dropDuplicates(["id", "hash"]) \
        .join(lists, ["id", "hash"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            cuts, lengths = batch.column("cuts").flatten(), batch.column("cuts").value_lengths()
            of = np.repeat(np.arange(batch.num_rows), lengths.to_numpy(zero_copy_only=False))
            field = {k: cuts.field(k) for k in ("block", "at", "n", "back")}
            at, n = (field[k].to_numpy(zero_copy_only=False).tolist() for k in ("at", "n"))
            parts, text, last = [], b"", -1
            for r, a, w in zip(of.tolist(), at, n):
                if r != last:
                    text, last = unpack.decompress(batch.column("text")[r].as_py()), r
                parts.append(text[a:a + w + length - 1])
            of = pa.array(of)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(of), batch.column("hash").take(of), *field.values(),
                 pa.array(parts, pa.binary())], names=["id", "hash", *field, "bytes"])

    return met.select("id", "hash", "text", "cuts").mapInArrow(
        run, "id long, hash long, block long, at long, n int, back int, bytes binary")


def _cut(frame: DataFrame, length: int, step: int) -> DataFrame:
    """Block rows of at most ``step`` windows from blocks with the ``bytes`` of
    the context that they lie in. Blocks are cut at multiples of ``step`` from
    the anchor, so that equal windows come into blocks with one core, which is
    what all windows of an uncut block hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _powers()
        for batch in batches:
            data, bounds = flat_bytes(batch.column("bytes"))
            whole = {k: batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64)
                     for k in ("block", "at", "n", "back")}
            for a, b in chunks(bounds):
                block, at, n, back = (whole[k][a:b] for k in ("block", "at", "n", "back"))
                part, base = data[bounds[a]:bounds[b]], bounds[a:b] - bounds[a] + at - block
                high, low = back // step, (back - n + 1) // step
                of = np.repeat(np.arange(b - a), high - low + 1)
                turn = np.arange(len(of)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1),
                                                      high - low + 1)
                j = high[of] - turn
                far = np.minimum(back[of], step * j + step - 1)
                near = np.maximum(back[of] - n[of] + 1, step * j)
                first, count, start = back[of] - far, far - near + 1, base[of]
                core = powers[0].stretch(powers[0].sums(part), start + back[of] - step * j,
                                         start + back[of] - (step * j + step - 1) + length)
                context = powers[1].stretch(powers[1].sums(part), start + first,
                                            start + first + count + length - 1)
                context = context + count.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25) \
                    + far.astype(np.uint64)
                row = pa.array(of + a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(scramble(core).view(np.int64)),
                     pa.array(scramble(context).view(np.int64)),
                     batch.column("id").take(row), batch.column("hash").take(row),
                     pa.array(block[of]), pa.array(at[of] + first),
                     pa.array(count, pa.int32()), pa.array(far, pa.int32())], names=_NAMES)

    return frame.select("id", "hash", "block", "at", "n", "back", "bytes").mapInArrow(run, _ROW)


def _lists(spans: DataFrame) -> DataFrame:
    """The windows of each ``id, hash``, every one once: rows that repeat an id
    and its text share the key and bring the same windows."""
    return spans.distinct().groupBy("id", "hash").agg(
        F.collect_list(F.struct("at", "n")).alias("cuts"))


def _remove(texts: DataFrame, spans: DataFrame, keep: list[str], length: int) -> DataFrame:
    """Join every text with its repeated windows and take them out."""
    met = _packed(texts.select(*keep, "id", "hash", "text")) \
        .join(_lists(spans), ["id", "hash"], "left").select(*keep, "text", "cuts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            sizes, removed, kept = [], [], []
            for packed, cuts in zip(batch.column("text"), batch.column("cuts")):
                text = unpack.decompress(packed.as_py())
                runs: list[tuple[int, int]] = []
                if cuts.is_valid:
                    at, n = (cuts.values.field(k).to_numpy(zero_copy_only=False).astype(np.int64)
                             for k in ("at", "n"))
                    order = np.argsort(at, kind="stable")
                    at, end = at[order], at[order] + n[order] + length - 1
                    reach = np.maximum.accumulate(end)
                    head = np.flatnonzero(np.concatenate([[True], at[1:] > reach[:-1]]))
                    tail = np.append(head[1:], len(at)) - 1
                    runs = list(zip(at[head].tolist(), reach[tail].tolist()))
                edges = [0, *(x for r in runs for x in r), len(text)]
                sizes.append(len(text))
                removed.append([{"start": x, "end": y} for x, y in runs])
                kept.append(b"".join(text[edges[k]:edges[k + 1]] for k in range(0, len(edges), 2)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), pa.array(sizes, pa.int64()),
                 pa.array(removed, pa.list_(pa.struct([("start", pa.int64()),
                                                       ("end", pa.int64())]))),
                 pa.array(kept, pa.binary())], names=[*keep, "n_bytes", "removed", "kept"])

    schema = ", ".join(f"{c} {t}" for c, t in texts.select(*keep).dtypes)
    return met.mapInArrow(run, f"{schema}, n_bytes long, "
                               "removed array<struct<start:long,end:long>>, kept binary")


def remove_repeats(docs: DataFrame, length: int = 200, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Remove every byte that a repeated string of ``length`` bytes covers.

    Returns ``keep, n_bytes, removed, kept``: bytes of the text, the maximal
    removed runs as (``start, end``) byte places, and the bytes left over.
    Strings are judged on the input, overlaps with themselves count, matches
    never cross documents, and all occurrences go, the first too.

    Null texts are empty; texts under ``length`` bytes keep all. Repeated rows
    are occurrences like any other: both go. Very long texts go through the
    first step in segments, whole. No rows give no rows. Other columns are
    ignored. A row is known by its id and a hash of its text, and each rank
    pair has 128 bits.
    """
    if length < SEED + STEP:
        raise ValueError(f"length must be at least {SEED + STEP}")
    texts = docs.select(*[F.col(c).alias(f"k_{c}") for c in keep],
                        F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("id"),
                        F.xxhash64(F.col("doc_id").isNull(), text_or_empty()).alias("hash"),
                        text_or_empty().alias("text"))
    whole, several = rerank(_emit(texts, length))
    contexts = stored(_contexts(texts, several, length))
    spans = [whole]
    whole, several = rerank(_cut(contexts, length, STEP))
    spans.append(whole)
    inside = several.join(contexts.select("id", "hash", "block", "bytes"), ["id", "hash", "block"])
    whole, _ = rerank(_cut(inside, length, 1))
    spans.append(whole)
    every = spans[0].union(spans[1]).union(spans[2])
    return _remove(texts, every, [f"k_{c}" for c in keep], length) \
        .select(*[F.col(f"k_{c}").alias(c) for c in keep], "n_bytes", "removed", "kept")
