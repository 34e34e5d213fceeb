"""Sharding by Karmarkar-Karp differencing.

Groups that must not be split (equal texts) are weighed and packed into shards
of near equal bytes. Differencing keeps partial partitions: k piles each, at
first one group alone. The two with the largest spread are combined again and
again, the heaviest pile of one on the lightest of the other, until one is
left. Here each digest bucket of groups is differenced by its own task, what is
left of the buckets is differenced in turn, and so on up to a single partition;
the way back down gives every group its pile.
"""

from __future__ import annotations

import heapq
import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_text, root_buckets, stored, text_or_empty, with_task

FAN_IN = 4096


def difference(piles: list[tuple[list[int], str]], shards: int) -> tuple[list[int], list[list[int]]]:
    """Difference partial partitions ``(sums, key)`` down to one.

    Returns its sums and, for each input, where its piles went: pile i of
    input j is part of result pile ``went[j][i]``. Ties go by key.
    """
    order = sorted(range(len(piles)), key=lambda j: piles[j][1])
    sums = [list(piles[j][0]) for j in order]
    left: list[tuple[int, int]] = []  # what each combination was made of
    turns: list[tuple[list[int], list[int]]] = []
    heap = [(min(s) - max(s), j) for j, s in enumerate(sums)]
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        heavy = sorted(range(shards), key=lambda i: (-sums[a][i], i))
        light = sorted(range(shards), key=lambda i: (sums[b][i], i))
        to_a, to_b, both = [0] * shards, [0] * shards, [0] * shards
        for k, (i, j) in enumerate(zip(heavy, light)):
            to_a[i], to_b[j], both[k] = k, k, sums[a][i] + sums[b][j]
        left.append((a, b))
        turns.append((to_a, to_b))
        sums.append(both)
        heapq.heappush(heap, (min(both) - max(both), len(sums) - 1))
    top = heap[0][1]
    went: list[list[int]] = [[]] * len(sums)
    went[top] = list(range(shards))
    for k in range(len(left) - 1, -1, -1):
        here = went[len(piles) + k]
        for child, turn in zip(left[k], turns[k]):
            went[child] = [here[x] for x in turn]
    out: list[list[int]] = [[]] * len(piles)
    for place, j in enumerate(order):
        out[j] = went[place]
    return sums[top], out


def _level(items: DataFrame, shards: int) -> DataFrame:
    """Difference the items of each ``bucket``: the way of every item, and one
    row per bucket (``item`` null) with what is left."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        total, went = difference(list(zip(pdf["sums"].map(list), pdf["item"])), shards)
        return pd.DataFrame({"bucket": int(pdf["bucket"].iloc[0]),
                             "item": [*pdf["item"], None], "sums": [*[None] * len(pdf), total],
                             "went": [*went, None]})

    return items.groupBy("bucket").applyInPandas(
        run, "bucket long, item string, sums array<long>, went array<int>")


def pack(groups: DataFrame, shards: int, fan_in: int = FAN_IN) -> DataFrame:
    """Shard of every group: ``groups`` (item string, bytes long) to ``item,
    pile``.

    The first level deals items to as many buckets as the root of their
    number, or to buckets of ``fan_in`` where that is more; each further level
    joins up to ``fan_in`` of them. So no task differences more than
    ``fan_in`` partial partitions, and there are few levels: the number of
    rows only shows in their count.
    """
    count = groups.count()
    if not count:
        return groups.select("item", F.lit(0).alias("pile"))
    size = max(2, min(fan_in, math.ceil(math.sqrt(count))))
    buckets = math.ceil(count / size)
    alone = F.concat(F.array(F.col("bytes")),
                     F.array_repeat(F.lit(0).cast("long"), shards - 1))
    items = groups.select(F.pmod(F.xxhash64("item"), F.lit(buckets)).alias("bucket"),
                          "item", alone.alias("sums"))
    levels = []
    while True:
        done = stored(_level(items, shards))
        levels.append(done.where("item is not null").select("bucket", "item", "went"))
        left = done.where("item is null")
        if buckets == 1:
            break
        buckets = math.ceil(buckets / fan_in)
        items = left.select(F.pmod(F.xxhash64("bucket"), F.lit(buckets)).alias("bucket"),
                            F.col("bucket").cast("string").alias("item"), "sums")
    # The first pile of a group holds it; follow it up the levels.
    at = levels[0].select(F.col("item").alias("group"), F.col("bucket").alias("at"),
                          F.element_at("went", 1).alias("pile"))
    for level in levels[1:]:
        up = level.select(F.col("bucket").alias("up"), F.col("item").cast("long").alias("at"),
                          F.col("went"))
        at = at.join(up, "at").select("group", F.col("up").alias("at"),
                                      F.element_at("went", F.col("pile") + 1).alias("pile"))
    return at.select(F.col("group").alias("item"), "pile")


def slots(rows: DataFrame, shard: str, order: str, prefix: Column) -> DataFrame:
    """Gapless ``slot`` from 0 inside each shard by the column ``order`` (which
    starts with a hash in [0, 1) given as ``prefix``): a running count over hash
    buckets plus the place inside one, so that no task numbers a whole shard.

    Rows equal in ``order`` are counted by ``task`` (``common.with_task``) and
    placed by those counts, so that no task numbers all copies of a row."""
    counts = rows.groupBy(shard).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select(shard, root_buckets(F.col("n")).alias("buckets"))
    rows = rows.join(F.broadcast(counts), shard) \
        .withColumn("part", F.floor(prefix * F.col("buckets")).cast("long"))

    def before(of: list[str], by: list[str]) -> Column:
        over = Window.partitionBy(*of).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(over), F.lit(0))

    same = [shard, "part", order, "task"]
    by_task = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("n"))
    parts = by_task.groupBy(shard, "part").agg(F.sum("n").alias("n")) \
        .select(shard, "part", before([shard], ["part"]).alias("earlier"))
    firsts = by_task.withColumn("within", before([shard, "part"], [order, "task"])) \
        .join(parts, [shard, "part"]) \
        .select(*same, (F.col("earlier") + F.col("within")).alias("first"))
    place = F.row_number().over(Window.partitionBy(*same).orderBy("row")) - 1
    return rows.withColumn("place", place).join(firsts, same) \
        .withColumn("slot", (F.col("first") + F.col("place")).cast("long")) \
        .drop("buckets", "part", "place", "first", "row", "task")


def assign(docs: DataFrame, shards: int = 8, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Put documents into shards of near equal bytes; equal texts stay together.

    Returns ``keep`` plus ``size`` (UTF-8 bytes plus one), ``text_crc32``,
    ``text_md5``, ``shard`` and ``slot`` (gapless from 0 in its shard, in the
    order of the row's digest). The text itself is read once and not shuffled:
    all later steps run on its size and digests.

    Null texts count as empty and share their group. Repeated rows and copies
    are weighed together, by partial sums before any shuffle, and numbered by
    the tasks that wrote them. Ties in the
    differencing go by text digest, so reruns agree. No rows give no rows.
    Other columns are ignored.
    """
    text = text_or_empty().cast("binary")
    rows = docs.select(*[F.col(c).alias(f"k_{c}") for c in keep],
                       (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.md5(text).alias("text_md5"),
                       F.md5(F.concat_ws("/", id_text(), F.md5(text)).cast("binary"))
                       .alias("digest"))
    rows = stored(with_task(rows))
    groups = rows.groupBy(F.col("text_md5").alias("item")).agg(F.sum("size").alias("bytes"))
    piles = pack(groups, shards).select(F.col("item").alias("text_md5"),
                                        F.col("pile").cast("int").alias("shard"))
    placed = rows.join(piles, "text_md5")
    prefix = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)
    return slots(placed, "shard", "digest", prefix) \
        .select(*[F.col(f"k_{c}").alias(c) for c in keep], "size", "text_crc32", "text_md5",
                "shard", "slot")
