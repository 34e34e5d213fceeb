"""Grouped aggregates, rates and top-k.

Every aggregate is a plain ``groupBy().agg()`` so Spark adds the map-side
partial aggregate before the shuffle: a key holding a third of the rows is
reduced to one partial row per task before anything moves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio_pct


def count_by(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def avg_of_counts(df: DataFrame, outer: Sequence[str], inner: Sequence[str],
                  out: str = "avg_count", digits: int | None = 2) -> DataFrame:
    """count per (inner + outer) key, then the mean of those counts per
    outer key. Only combinations that exist enter the mean."""
    counts = df.groupBy(*inner, *outer).agg(F.count(F.lit(1)).alias("_n"))
    mean = F.avg("_n")
    return counts.groupBy(*outer).agg((F.round(mean, digits) if digits is not None else mean).alias(out))


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """H2-H4: first ``k`` rows in ``order``; planned as TakeOrderedAndProject
    (per-partition top-k, then a k-row merge), never a total sort."""
    return df.orderBy(*order).limit(k)


def max_by_key(df: DataFrame, key: str | Sequence[str], value: str, out: str = "max_value") -> DataFrame:
    """maximum per key; NaN is dropped first (Spark ranks NaN highest)."""
    keys = [key] if isinstance(key, str) else list(key)
    return (df.where(F.col(value).isNotNull() & ~F.isnan(value))
            .groupBy(*keys).agg(F.max(value).alias(out)))


def _rate_aggs(id_col: str, flag_col: str, digits: int | None) -> list[Column]:
    total = F.count(F.col(id_col))
    flagged = F.sum(F.col(flag_col))
    pct = ratio_pct(flagged, total)
    return [total.alias("total"), flagged.alias("flagged"),
            (F.round(pct, digits) if digits is not None else pct).alias("pct")]


def rate_by(df: DataFrame, key: str, id_col: str, flag_col: str,
            digits: int | None = None) -> DataFrame:
    """Count of ids, sum of a 0/1 flag and the flag percentage per key.

    ``count(id)`` skips NULL ids; a NULL flag is skipped by the sum.
    """
    return df.groupBy(key).agg(*_rate_aggs(id_col, flag_col, digits))


def rates_grouping_sets(df: DataFrame, dims: Mapping[str, Column], id_col: str, flag_col: str,
                        digits: int | None = None) -> DataFrame:
    """F5 in one pass: one grouping set per dimension over a single scan.

    Output is long: ``dimension`` (the dims key), ``key`` (int value),
    total, flagged, pct. ``grouping()`` tells which set a row belongs to,
    so a NULL key inside a set is not confused with the rolled-up column.
    """
    names = list(dims)
    base = df.select(*[c.alias(n) for n, c in dims.items()], id_col, flag_col)
    agg = base.groupingSets([[n] for n in names], *names).agg(
        *_rate_aggs(id_col, flag_col, digits), *[F.grouping(n).alias(f"_g_{n}") for n in names])
    dim = F.lit(None).cast("string")
    key = F.lit(None).cast("int")
    for n in reversed(names):
        dim = F.when(F.col(f"_g_{n}") == 0, F.lit(n)).otherwise(dim)
        key = F.when(F.col(f"_g_{n}") == 0, F.col(n).cast("int")).otherwise(key)
    return agg.select(dim.alias("dimension"), key.alias("key"), "total", "flagged", "pct")


def latest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the one with the greatest ``order`` (latest put
    wins). ``max_by`` is a partial aggregate, so a hot key does not gather
    its rows in one task."""
    others = [c for c in df.columns if c != key]
    packed = F.max_by(F.struct(*others), F.col(order))
    return df.groupBy(key).agg(packed.alias("_r")).select(key, "_r.*")
