"""Exact distinct counts of several columns in one grouping.

Several ``count(DISTINCT ...)`` in one aggregate make Spark copy every row once
for each of them (Expand). Here a column with few values is counted in a bitmap
over the positions of its dictionary: some longs for each group, filled by
``bit_or``, which merges in partial aggregates like a sum. One column with many
values may stay a plain distinct count in the same aggregate (a single one needs
no copies); every further one is a grouping of its own, joined by the keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

BITS = 64
MOST_VALUES = 1024  # 16 longs for each group at most


def small_dictionaries(sources: Mapping[str, DataFrame], most: int = MOST_VALUES) -> dict[str, list]:
    """The values, without null, of every column that has at most ``most``.

    Sketches tell which columns may be small, so that no large set is ever
    collected; the values of those are then collected and counted exactly.
    """
    scans: dict[int, tuple[DataFrame, list[str]]] = {}
    for column, frame in sources.items():
        scans.setdefault(id(frame), (frame, []))[1].append(column)
    out: dict[str, list] = {}
    for frame, columns in scans.values():
        about = frame.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
        few = [c for c in columns if about[c] <= most]
        if few:
            sets = frame.agg(*[F.collect_set(c).alias(c) for c in few]).first()
            out.update({c: sorted(sets[c]) for c in few if len(sets[c]) <= most})
    return out


def _positions(df: DataFrame, column: str, values: Sequence, out: str) -> DataFrame:
    """``out``: the place of the value in the dictionary, null for null. The
    joined table has one row per value, at most ``most`` of them."""
    key = f"{out}_value"
    schema = StructType([StructField(key, df.schema[column].dataType), StructField(out, LongType())])
    table = df.sparkSession.createDataFrame([(v, k) for k, v in enumerate(values)], schema)
    return df.join(F.broadcast(table), F.col(column) == F.col(key), "left").drop(key)


def bitmap_count(position: str, values: int) -> Column:
    """Distinct positions (0 to ``values - 1``) of a group, nulls left out."""
    count = F.lit(0)
    for word in range(-(-values // BITS)):
        bit = F.expr(f"CASE WHEN {position} div {BITS} = {word} "
                     f"THEN shiftleft(1L, CAST({position} % {BITS} AS INT)) END")
        count = count + F.bit_count(F.coalesce(F.bit_or(bit), F.lit(0).cast("long")))
    return count.cast("long")


def grouped(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column],
            distincts: Mapping[str, str], dictionaries: Mapping[str, DataFrame] | None = None,
            most: int = MOST_VALUES) -> DataFrame:
    """``keys``, ``aggregates`` and, by output name, the exact number of
    distinct non-null values of each column of ``distincts``.

    ``dictionaries`` names for a column a frame that holds it with all its
    values, such as the table it comes from before any join, so that finding
    the values does not run the joins; by default ``df`` is read. A value of
    ``df`` that such a frame lacks would not be counted.
    """
    columns = list(dict.fromkeys(distincts.values()))
    known = small_dictionaries({c: (dictionaries or {}).get(c, df) for c in columns}, most)
    place = {c: f"_place_{k}" for k, c in enumerate(columns) if c in known}
    marked = df
    for c, name in place.items():
        marked = _positions(marked, c, known[c], name)
    large = [n for n, c in distincts.items() if c not in known]
    counts = [bitmap_count(place[c], len(known[c])).alias(n) for n, c in distincts.items() if c in known]
    counts += [F.count_distinct(distincts[n]).alias(n) for n in large[:1]]
    out = marked.groupBy(*keys).agg(*aggregates, *counts)
    names = [c for c in out.columns if c not in distincts] + list(distincts)
    out = out.withColumn("_of", F.struct(*keys))  # never null, so groups with null keys meet
    for n in large[1:]:
        more = df.groupBy(*keys).agg(F.count_distinct(distincts[n]).alias(n))
        out = out.join(more.select(F.struct(*keys).alias("_of"), n), "_of")
    return out.select(*names)
