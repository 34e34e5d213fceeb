"""Per-entity window features.

Windows are always partitioned by an entity key except ``global_lag``,
which is meant for already aggregated series (one row per period). All lags
of a frame are produced in one ``select`` so the plan has one Window
operator per distinct spec instead of a chain of projections.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import block_start


def _spec(partition: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*partition).orderBy(*order)


def add_lags(df: DataFrame, partition: Sequence[str], order: Sequence[str],
             columns: Sequence[str], lags: Sequence[int],
             name: str = "{col}_lag_{k}", lag_major: bool = True) -> DataFrame:
    """``lag(c, k)`` for every column and lag, by row (gaps in the
    ordering are not filled). ``lag_major`` orders the new columns by lag
    first, as in the weekly table; otherwise by column first."""
    w = _spec(partition, order)
    pairs = ([(c, k) for k in lags for c in columns] if lag_major
             else [(c, k) for c in columns for k in lags])
    return df.select("*", *[F.lag(c, k).over(w).alias(name.format(col=c, k=k)) for c, k in pairs])


def global_lag(df: DataFrame, order: Sequence[str], column: str, k: int = 1,
               out: str | None = None) -> DataFrame:
    """G1: lag over one global ordering. Runs in a single task, so use it on
    per-period aggregates only, never on raw rows."""
    w = Window.orderBy(*order)
    return df.withColumn(out or f"{column}_lag_{k}", F.lag(column, k).over(w))


def forward_fill(df: DataFrame, partition: Sequence[str], order: Sequence[str],
                 column: str, out: str | None = None) -> DataFrame:
    """Last non-null value up to the current row (default frame)."""
    w = _spec(partition, order)
    return df.withColumn(out or column, F.last(column, ignorenulls=True).over(w))


def rolling_mean(df: DataFrame, partition: Sequence[str], order: Sequence[str],
                 column: str, rows: int = 4, out: str | None = None) -> DataFrame:
    """Mean of the current row and the ``rows - 1`` before it."""
    w = _spec(partition, order).rowsBetween(-(rows - 1), 0)
    return df.withColumn(out or f"rolling_avg_{column}", F.avg(column).over(w))


def cumulative_sum(df: DataFrame, partition: Sequence[str], order: Sequence[str],
                   column: str, out: str | None = None) -> DataFrame:
    """Running sum with the default RANGE frame (tied order values share
    the same total)."""
    w = _spec(partition, order)
    return df.withColumn(out or f"cumulative_{column}", F.sum(column).over(w))


def carry_previous_block(df: DataFrame, key: str, position: str, value: str,
                         width: int = 10, block: str | None = None,
                         out: str = "avg_profit") -> DataFrame:
    """Give every row the mean ``value`` of the block-closing
    rows (``position % width == 0``) of the *previous* block of its key.

    The closing-row means are aggregated per (key, block), shifted one block
    forward and left-joined back on (key, block): an equi-join on a
    high-cardinality composite key, so one hot key is spread over its blocks.
    """
    block = block or f"{position}_group_{width}"
    with_block = df if block in df.columns else df.withColumn(block, block_start(position, width))
    closing = (with_block.where(F.col(position) % width == 0)
               .groupBy(key, block).agg(F.avg(value).alias(out))
               .select(key, (F.col(block) + width).alias(block), out))
    return with_block.join(closing, [key, block], "left")
