"""Alignment of two tokenizers over a corpus, with link counts.

Both tokenizers cut the same bytes, so where tokens of both end the text falls
into groups, and within a group every A token is linked with every B token. How
many documents hold a pair linked is counted by minimal perfect hashing: a
first pass aligns all documents and collects what pairs there are, a minimal
perfect hash gives each distinct pair a place without gaps, counts are dense
vectors over those places that are summed up a tree, and a second pass aligns
the documents again and looks its pairs up, checked against the stored keys.
Texts are encoded once; both passes align the stored token ids.
"""

from __future__ import annotations

import json
import math
import re
import sys
import types
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .words import chunks, flat, scramble

PER_SHARD = 1 << 16   # distinct pairs in one hash
PER_VECTOR = 1 << 19  # partial counts added up in one task
FAN_IN = 16           # vectors added up at a time
ROUND = 32            # shards looked up in one pass: some 36 MB to each task
HELD = 1 << 20        # pairs a task holds before it hands them on
LINKS = 1 << 21       # links made at a time
DENSE = 1 << 12       # groups of more links are taken by distinct ids

PIECE = 100           # characters of a text that B reads at a time, and the word they end in

# What splits a text before byte-level merges, written so that no
# step back is needed.
PATTERN = (r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s")
_CUT = re.compile(r"[^ ] (?!\Z)")


# ---------------------------------------------------------------- tokenizers
def byte_level(model: bytes) -> dict[bytes, int]:
    """Bytes of every entry of a byte-level BPE file, without special tokens.

    Bytes that print stand for themselves there, the others for the code points
    from 256 on, in order. Ids must follow the order of the merges, as they do
    where a vocabulary is written as it was learned.
    """
    spec = json.loads(model)
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {**{chr(b): b for b in shown}, **{chr(256 + k): b for k, b in enumerate(hidden)}}
    vocab = spec["model"]["vocab"]
    merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
    ids = [vocab[m] for m in merges]
    if ids != sorted(ids):
        raise ValueError("ids do not follow the merges")
    special = {t["id"] for t in spec.get("added_tokens", []) if t.get("special")}
    return {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if i not in special}


class Tokenizers:
    """A: byte-level BPE file. B: sentencepiece model. Both as file contents."""

    def __init__(self, a_model: bytes, b_model: bytes):
        import sentencepiece
        import tiktoken

        ranks = byte_level(a_model)
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i)
                        else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_size = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        # Merges never cross from a word to the blank behind it unless a piece
        # does, so a text can be cut before its blanks and words be remembered.
        self.by_word = not any("▁" in p.lstrip("▁") for p in pieces) \
            and "".join(self.b.encode(" a  b ", out_type=str)) == "▁▁a▁▁b▁"
        self.b_start = np.cumsum(self.b_size) - self.b_size
        self.b_flat = np.frombuffer(b"".join(self.b_bytes), np.uint8)

    def _pieces(self, text: str) -> Iterator[str]:
        """A text cut before blanks, each part without its first one, which the
        model adds itself; it adds none to an empty part, so the last character
        of a text is never cut off."""
        first = 0
        while self.by_word and (blank := _CUT.search(text, first + PIECE)):
            yield text[first:blank.start() + 1]
            first = blank.start() + 2
        yield text[first:]

    def _encode_b(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and how many each has; none where bytes differ."""
        cut = [list(self._pieces(t)) if t else [] for t in texts]
        found = self.b.encode(list(chain.from_iterable(cut)), num_threads=1)
        size = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.int64, int(size.sum()))
        of = np.repeat(np.repeat(np.arange(len(texts)), [len(c) for c in cut]), size)
        raw = [b" " + t.encode() if t else b"" for t in texts]
        length = np.bincount(of, self.b_size[ids], len(texts)).astype(np.int64)
        right = length == [len(r) for r in raw]
        ids, of = ids[right[of]], of[right[of]]
        n = self.b_size[ids]
        at = np.repeat(self.b_start[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        wanted = np.frombuffer(b"".join([r for r, x in zip(raw, right.tolist()) if x]), np.uint8)
        differs = np.unique(np.repeat(of, n)[self.b_flat[at] != wanted])
        if len(differs):
            keep = ~np.isin(of, differs)
            ids, of = ids[keep], of[keep]
        return ids, np.bincount(of, minlength=len(texts))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and how many each text has, then those of B; a text whose
        bytes either does not give back has none. Byte-level tokens are parts of
        the text, so their bytes are right if their length is."""
        b, n_b = self._encode_b(texts)
        found = [self.a.encode_ordinary(" " + t) if n else () for t, n in zip(texts, n_b.tolist())]
        n_a = np.array([*map(len, found)], dtype=np.int64)
        a = np.fromiter(chain.from_iterable(found), np.int64, int(n_a.sum()))
        of = np.repeat(np.arange(len(texts)), n_a)
        size = np.bincount(of, self.a_size[a], len(texts))
        wrong = (n_a > 0) & (size != [len(t.encode()) + 1 for t in texts])
        if wrong.any():
            a, b = a[~np.repeat(wrong, n_a)], b[~np.repeat(wrong, n_b)]
            n_a, n_b = np.where(wrong, 0, n_a), np.where(wrong, 0, n_b)
        return a, n_a, b, n_b


def _loaded(key: str, a_model: bytes, b_model: bytes) -> Tokenizers:
    """The tokenizers of a worker process, made once for all of its tasks."""
    cache = sys.modules.setdefault("_llm_tokenizers", types.ModuleType("_llm_tokenizers"))
    if not hasattr(cache, key):
        setattr(cache, key, Tokenizers(a_model, b_model))
    return getattr(cache, key)


# ---------------------------------------------------------------- alignment
class Aligned:
    """Tokens of some texts in groups. ``links`` gives text, pair and how often."""

    def __init__(self, tok: Tokenizers, a: np.ndarray, n_a: np.ndarray, b: np.ndarray,
                 n_b: np.ndarray):
        self.n = len(n_a)
        self.a, self.n_a, self.b, self.n_b = a, n_a, b, n_b
        self.width = len(tok.b_bytes)
        ends_a, ends_b = np.cumsum(tok.a_size[self.a]), np.cumsum(tok.b_size[self.b])
        at = np.minimum(np.searchsorted(ends_b, ends_a), max(0, len(ends_b) - 1))
        last_a = ends_b[at] == ends_a if len(ends_b) else np.zeros(0, dtype=bool)
        last_b = np.zeros(len(ends_b), dtype=bool)
        last_b[at[last_a]] = True
        self.group_a = np.cumsum(last_a) - last_a
        self.group_b = np.cumsum(last_b) - last_b
        self.last_a, self.last_b = last_a, last_b
        groups = int(last_a.sum())
        self.size_a = np.bincount(self.group_a, minlength=groups)
        self.size_b = np.bincount(self.group_b, minlength=groups)
        self.text = np.repeat(np.arange(self.n), self.n_a)[last_a]
        self.n_groups = np.bincount(self.text, minlength=self.n)
        self.n_links = np.zeros(self.n, dtype=np.int64)
        np.add.at(self.n_links, self.text, self.size_a * self.size_b)

    def _members(self, ids: np.ndarray, group: np.ndarray, dense: np.ndarray):
        """Ids by group with their number there: one by one, or, in groups of
        many links, each id once."""
        often = np.ones(len(ids), dtype=np.int64)
        if dense.any():
            many = dense[group]
            key, n = np.unique(group[many] << 32 | ids[many], return_counts=True)
            group = np.concatenate([group[~many], key >> 32])
            order = np.argsort(group, kind="stable")
            ids = np.concatenate([ids[~many], key & 0xFFFFFFFF])[order]
            often, group = np.concatenate([often[~many], n])[order], group[order]
        return ids, group, often

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        dense = self.size_a * self.size_b > DENSE
        a, group_a, n_a = self._members(self.a, self.group_a, dense)
        b, group_b, n_b = self._members(self.b, self.group_b, dense)
        size = np.bincount(group_b, minlength=len(dense))
        start = np.cumsum(size) - size
        reps = size[group_a]
        to = np.cumsum(reps)
        first = 0
        while first < len(a):
            done = to[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(to, done + LINKS, side="right")))
            r = reps[first:last]
            at = np.repeat(start[group_a[first:last]] - (np.cumsum(r) - r), r) + np.arange(int(r.sum()))
            yield (np.repeat(self.text[group_a[first:last]], r),
                   np.repeat(a[first:last], r) * self.width + b[at],
                   np.repeat(n_a[first:last], r) * n_b[at])
            first = last

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs and how many of the texts hold them."""
        space = np.int64(self.width) << 20  # ids of A stay below 2**20
        seen = [np.unique(text * space + pair) for text, pair, _ in self.links()]
        if not seen:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys = seen[0] if len(seen) == 1 else np.unique(np.concatenate(seen))
        return np.unique(keys % space, return_counts=True)

    def groups(self) -> list[str]:
        """The groups of each text as ``a1,a2|b1;a3|b2``."""
        top = int(max(self.a.max(initial=0), self.b.max(initial=0)))
        digits = [str(i).encode() for i in range(top + 1)]
        wide = len(digits[-1]) + 1
        table = np.zeros((top + 1, wide), dtype=np.uint8)
        table[:, :wide - 1] = np.array(digits, dtype=f"S{wide - 1}").view(np.uint8).reshape(top + 1, -1)
        size = np.array([len(d) for d in digits])
        ids = np.concatenate([self.a, self.b])
        group = np.concatenate([self.group_a, self.group_b])
        mark = np.concatenate([np.where(self.last_a, 0x7C, 0x2C), np.where(self.last_b, 0x3B, 0x2C)])
        order = np.argsort(group, kind="stable")  # A before B in each group
        ids, mark = ids[order], mark[order]
        cells = table[ids]
        cells[np.arange(len(ids)), size[ids]] = mark
        line = cells[np.arange(wide) <= size[ids][:, None]].tobytes()
        tokens = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])
        at = np.concatenate([[0], np.cumsum(size[ids] + 1)])[tokens]
        return [line[i:max(i, j - 1)].decode() for i, j in zip(at[:-1].tolist(), at[1:].tolist())]


def _texts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """First row and texts of pieces of about a megabyte; nulls are empty."""
    _, bounds = flat(column)
    for first, last in chunks(bounds - bounds[0]):
        yield first, ["" if t is None else t for t in column.slice(first, last - first).to_pylist()]


def _cells(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Ids of each row as bytes, four to an id."""
    bounds = np.append(0, np.cumsum(sizes) * 4).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [
        None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(ids.astype("<i4").tobytes())]) \
        .cast(pa.binary())


def encoded(docs: DataFrame, load: Callable[[], Tokenizers], keep: list[str]) -> DataFrame:
    """``keep..., ids_a, ids_b``: the token ids of every text, as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load()
        for batch in batches:
            for first, texts in _texts(batch.column(len(keep))):
                part = batch.slice(first, len(texts))
                a, n_a, b, n_b = tok.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(keep)], _cells(a, n_a), _cells(b, n_b)],
                    names=[*keep, "ids_a", "ids_b"])

    shape = docs.select(*keep, F.lit(b"").alias("ids_a"), F.lit(b"").alias("ids_b")).schema
    return docs.select(*keep, "text").mapInArrow(run, shape)


def _aligned(batch: pa.RecordBatch, tok: Tokenizers) -> Iterator[tuple[pa.RecordBatch, Aligned]]:
    """Rows and their alignment, in pieces of about a megabyte of ids."""
    a, b = batch.column("ids_a"), batch.column("ids_b")
    sizes = [pc.binary_length(c).to_numpy(zero_copy_only=False).astype(np.int64) // 4 for c in (a, b)]
    for first, last in chunks(np.append(0, np.cumsum(sizes[0] + sizes[1]) * 4)):
        part = batch.slice(first, last - first)
        ids = [np.frombuffer(b"".join(part.column(c).to_pylist()), "<i4").astype(np.int64)
               for c in ("ids_a", "ids_b")]
        yield part, Aligned(tok, ids[0], sizes[0][first:last], ids[1], sizes[1][first:last])


# ---------------------------------------------------------------- minimal perfect hash
def _mixed(keys: np.ndarray) -> np.ndarray:
    """24 bits that deal pairs out to the shards."""
    return (scramble(keys.astype(np.uint64) + np.uint64(1)) >> np.uint64(40)).astype(np.int32)


def place_pairs(keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Minimal perfect hash of distinct keys: bit fields by level, and the keys
    by their place.

    On each level the keys left over try a place of their own in a field twice
    their number; those that get one stay, the others go on. A key's place is
    the number of set bits before its own.
    """
    fields, by_place, left = [], [], keys.astype(np.int64)
    while len(left):
        at = _spot(left, len(fields), 2 * len(left))
        alone = np.bincount(at, minlength=2 * len(left))[at] == 1
        field = np.zeros(2 * len(left), dtype=bool)
        field[at[alone]] = True
        order = np.argsort(at[alone])
        by_place.append(left[alone][order])
        fields.append(field)
        left = left[~alone]
    return fields, np.concatenate(by_place) if by_place else left


def _spot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    h = scramble(scramble(keys.astype(np.uint64) ^ seed) + seed)
    return ((h >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)


def places(keys: np.ndarray, fields: list[np.ndarray], known: np.ndarray) -> np.ndarray:
    """Place of each key, -1 for a key that is not one of those hashed."""
    out = np.full(len(keys), -1, dtype=np.int64)
    left, base = np.arange(len(keys)), 0
    for level, field in enumerate(fields):
        at = _spot(keys[left], level, len(field))
        hit = field[at]
        out[left[hit]] = base + (np.cumsum(field) - 1)[at[hit]]
        left, base = left[~hit], base + int(field.sum())
    right = out >= 0
    right[right] = known[out[right]] == keys[right]
    return np.where(right, out, -1)


def _pack(fields: list[np.ndarray]) -> bytes:
    sizes = np.array([len(fields), *map(len, fields)], dtype="<i8").tobytes()
    return sizes + b"".join(np.packbits(f).tobytes() for f in fields)


def _unpack(data: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(data, "<i8", 1)[0])
    sizes, at, out = np.frombuffer(data, "<i8", n, 8).tolist(), 8 * (n + 1), []
    for size in sizes:
        out.append(np.unpackbits(np.frombuffer(data, np.uint8, (size + 7) // 8, at), count=size).astype(bool))
        at += (size + 7) // 8
    return out


# ---------------------------------------------------------------- counts
def _partial_counts(tokens: DataFrame, load: Callable[[], Tokenizers]) -> DataFrame:
    """``pair, n, mixed, part``: first pass, pairs of the documents of each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, part = load(), TaskContext.get().partitionId()
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, inverse = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return keys, np.bincount(inverse, np.concatenate([n for _, n in held]),
                                     len(keys)).astype(np.int64)

        def out() -> pa.RecordBatch:
            keys, n = held[0]
            return pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (keys, n, _mixed(keys), np.full(len(keys), part, dtype=np.int32))],
                names=["pair", "n", "mixed", "part"])

        for batch in batches:
            for _, aligned in _aligned(batch, tok):
                held.append(aligned.pairs())
                if sum(len(k) for k, _ in held) > HELD:
                    held[:] = [merged()]
                    if len(held[0][0]) > HELD // 2:
                        yield out()
                        held.clear()
        if held:
            held[:] = [merged()]
            yield out()

    return tokens.select("ids_a", "ids_b").mapInArrow(run, "pair long, n long, mixed int, part int")


def _hashed(pairs: pd.DataFrame) -> pd.DataFrame:
    fields, known = place_pairs(pairs["pair"].to_numpy())
    return pd.DataFrame({"shard": pairs["shard"].iloc[:1], "fields": [_pack(fields)],
                         "keys": [known.tobytes()]})


def _dense(counts: pd.DataFrame, hashes: pd.DataFrame) -> pd.DataFrame:
    if counts.empty or hashes.empty:
        return pd.DataFrame({"shard": [], "node": [], "vector": []})
    known = np.frombuffer(hashes["keys"].iloc[0], np.int64)
    at = places(counts["pair"].to_numpy(), _unpack(hashes["fields"].iloc[0]), known)
    vector = np.zeros(len(known), dtype=np.int64)
    np.add.at(vector, at, counts["n"].to_numpy())
    return pd.DataFrame({"shard": hashes["shard"].iloc[:1], "node": hashes["node"].iloc[:1],
                         "vector": [vector.tobytes()]})


def _added(vectors: pd.DataFrame) -> pd.DataFrame:
    total = reduce(np.add, [np.frombuffer(v, np.int64) for v in vectors["vector"]])
    return pd.DataFrame({"shard": vectors["shard"].iloc[:1], "node": vectors["up"].iloc[:1],
                         "vector": [total.tobytes()]})


def pair_counts(tokens: DataFrame, load: Callable[[], Tokenizers]) -> DataFrame:
    """Shards of the count table: ``shard, fields, keys, counts``, the keys and
    counts standing at the places that the hash of ``fields`` gives.

    A shard holds about ``PER_SHARD`` pairs. Partial counts of its pairs meet
    in vectors of ``PER_VECTOR`` of them, which are added ``FAN_IN`` at a time.
    """
    partial = stored(_partial_counts(tokens, load))
    distinct = stored(partial.select("pair", "mixed").distinct())
    shards = max(1, math.ceil(distinct.count() / PER_SHARD))
    nodes = max(1, math.ceil(partial.count() / (shards * PER_VECTOR)))
    shard = (F.col("mixed") % shards).cast("int").alias("shard")
    hashes = stored(distinct.select("pair", shard).groupBy("shard").applyInPandas(
        _hashed, "shard int, fields binary, keys binary"))
    spread = hashes.select("*", F.explode(F.sequence(F.lit(0), F.lit(nodes - 1))).alias("node"))
    counts = partial.select("pair", "n", shard, F.pmod("part", F.lit(nodes)).cast("int").alias("node"))
    schema = "shard int, node int, vector binary"
    vectors = counts.groupBy("shard", "node").cogroup(spread.groupBy("shard", "node")) \
        .applyInPandas(_dense, schema)
    while nodes > 1:
        vectors = vectors.withColumn("up", F.floor(F.col("node") / FAN_IN).cast("int")) \
            .groupBy("shard", "up").applyInPandas(_added, schema)
        nodes = math.ceil(nodes / FAN_IN)
    return stored(hashes.join(vectors.select("shard", F.col("vector").alias("counts")), "shard"))


def _best(table: DataFrame, width: int) -> dict[int, int]:
    """Highest count of each A id: at most a row for each entry of A."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for keys, counts in zip(frame["keys"], frame["counts"]):
                one = pd.DataFrame({"a": np.frombuffer(keys, np.int64) // width,
                                    "best": np.frombuffer(counts, np.int64)})
                yield one.groupby("a", as_index=False)["best"].max()

    rows = table.select("keys", "counts").mapInPandas(run, "a long, best long")
    return {r["a"]: r["best"] for r in rows.groupBy("a").agg(F.max("best").alias("best")).collect()}


def _looked_up(rows: DataFrame, load: Callable[[], Tokenizers], slices, top, shards: int, last: bool,
               keep: list[str]) -> DataFrame:
    """Second pass: ``n_best`` and ``count_sum`` grow by the links whose pairs
    are in ``slices``; the last one adds the other columns and drops the tokens."""
    measures = ["n_a", "n_b", "n_groups", "n_links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, best = load(), top.value
        table = {s: (_unpack(f), np.frombuffer(k, np.int64), np.frombuffer(c, np.int64))
                 for s, f, k, c in slices.value}
        for batch in batches:
            for part, aligned in _aligned(batch, tok):
                sums = {c: part.column(c).to_numpy().copy() for c in ("n_best", "count_sum")}
                for text, pair, often in aligned.links():
                    distinct, inverse = np.unique(pair, return_inverse=True)
                    counts = np.zeros(len(distinct), dtype=np.int64)
                    of = _mixed(distinct) % shards
                    for s in np.unique(of).tolist():
                        if s in table:
                            mine = np.flatnonzero(of == s)
                            fields, known, values = table[s]
                            at = places(distinct[mine], fields, known)
                            counts[mine] = np.where(at >= 0, values[at], 0)
                    highest = (counts > 0) & (counts == best[distinct // aligned.width])
                    np.add.at(sums["n_best"], text, often * highest[inverse])
                    np.add.at(sums["count_sum"], text, often * counts[inverse])
                columns = {c: part.column(c) for c in keep}
                if last:
                    columns |= {c: pa.array(getattr(aligned, c)) for c in measures}
                else:
                    columns |= {c: part.column(c) for c in ("ids_a", "ids_b")}
                columns |= {c: pa.array(v) for c, v in sums.items()}
                if last:
                    columns["groups"] = pa.array(aligned.groups(), pa.string())
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    new = [F.lit(0).cast("long").alias(c) for c in measures]
    sums = ["n_best", "count_sum"]
    shape = rows.select(*keep, *new, *sums, F.lit("").alias("groups")) if last \
        else rows.select(*keep, "ids_a", "ids_b", *sums)
    return rows.select(*keep, "ids_a", "ids_b", *sums).mapInArrow(run, shape.schema)


def align(docs: DataFrame, a_model: bytes, b_model: bytes, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``doc_id, keep..., n_a, n_b, n_groups, n_links,
    n_best, count_sum, groups``.

    ``a_model`` and ``b_model`` are the contents of a byte-level BPE file and of
    a sentencepiece model; A reads a blank and the text, B the text. ``groups``
    lists the ids of both by group, ``a1,a2|b1;a3|b2,b3``. ``count_sum`` adds,
    over the links, how many documents hold the pair linked; ``n_best`` counts
    the links whose pair has the highest count of its A id, ties included.

    Null and empty texts, and texts whose bytes a tokenizer does not give back,
    have no tokens: zeros and ``''``. Long texts are aligned whole, their links
    made ``LINKS`` at a time; in groups of very many links distinct ids are
    linked, weighed by their number. Every row counts as a document, repeated
    rows and null ids too. No rows give no rows.

    A task holds about ``HELD`` distinct pairs in the first pass. In the second
    one the count table comes to the tasks in rounds of ``ROUND`` shards, so what
    is broadcast does not grow with the corpus: a round more for every two
    million distinct pairs. Highest counts are one number for each entry of A.
    """
    sc = docs.sparkSession.sparkContext
    models, key = sc.broadcast((a_model, b_model)), f"t{hash((a_model, b_model)) & 0xFFFFFFFFFFFF:x}"

    def load() -> Tokenizers:
        return _loaded(key, *models.value)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keep,
                       F.col("text").cast("string").alias("text"))
    rows = stored(encoded(rows, load, ["doc_id", *keep]))
    table = pair_counts(rows, load)
    shards = table.count()
    width = len(Tokenizers(a_model, b_model).b_bytes)
    top = np.zeros(1 << 20, dtype=np.int64)
    for a, n in _best(table, width).items():
        top[a] = n
    top = sc.broadcast(top)
    rows = rows.withColumns({c: F.lit(0).cast("long") for c in ("n_best", "count_sum")})
    rounds = max(1, math.ceil(shards / ROUND))
    for k in range(rounds):
        part = table.where(F.col("shard").between(k * ROUND, k * ROUND + ROUND - 1))
        slices = sc.broadcast([tuple(r) for r in part.select("shard", "fields", "keys", "counts").collect()])
        rows = _looked_up(rows, load, slices, top, max(1, shards), k == rounds - 1, ["doc_id", *keep])
        if k < rounds - 1:
            rows = stored(rows)
    return rows
