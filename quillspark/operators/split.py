"""Exact row positions without a single-task window (B10 and ``bar_num``).

``row_number()`` over a window with no or a skewed partition key sorts the
whole (or a third of the) data in one task. ``row_position`` gives the same
numbers from one range sort on the real columns: Spark samples the range
bounds over all sort columns, so a busy lead value is split by the next
column. There are as many ranges as the rows need, so that the rows one task
sorts do not grow with the input. The place of a row is then the rows of the ranges before its own plus its place in there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, tasks_for

FEW_KEYS = 1 << 16  # rows per range and key that are broadcast at most
_RANGE_BITS = 33  # monotonically_increasing_id: range above, row in it below


def row_position(df: DataFrame, order: Sequence[str], partition: Sequence[str] = (),
                 out: str = "row_pos", total: str | None = None) -> DataFrame:
    """1-based position of each row in ``order`` within ``partition``, as
    ``row_number`` (ties in the full order are broken arbitrarily, nulls come
    first). Columns of any sortable type will do. ``total`` names an optional
    column with the row count of the row's partition.

    The sorted rows are checkpointed once, so that every branch sees the same
    ranges. Joined back is one row per range and key, keys and ranges together
    at most: broadcast if few; if many, the rows are dealt by range and key, so
    that a key of many rows is spread like any others.
    """
    rows = df.count()
    placed = materialize(df.withColumn("_pk", F.struct(*partition) if partition else F.struct(F.lit(0)))
                         .repartitionByRange(tasks_for(rows), *partition, *order)
                         .sortWithinPartitions(*partition, *order)
                         .withColumn("_id", F.monotonically_increasing_id()))
    placed = placed.withColumn("_range", F.shiftright("_id", _RANGE_BITS)) \
        .withColumn("_row", F.col("_id").bitwiseAND(F.lit((1 << _RANGE_BITS) - 1)))
    here = materialize(placed.groupBy("_range", "_pk")
                       .agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_size")))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = here.groupBy("_range").agg(F.sum("_size").alias("_size")) \
        .select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    here = here.join(F.broadcast(starts), "_range")
    keys = here.groupBy("_pk").agg(F.min(F.col("_start") + F.col("_first")).alias("_base"),
                                   F.sum("_size").alias("_n"))
    here = materialize(here.join(keys, "_pk").select(
        "_range", "_pk", (F.col("_start") - F.col("_base")).alias("_shift"), "_n"))
    if here.count() <= FEW_KEYS:
        here = F.broadcast(here)
    else:
        placed = placed.repartition(tasks_for(rows), "_range", "_pk")
    res = placed.join(here, ["_range", "_pk"]).withColumn(out, F.col("_row") + F.col("_shift") + 1)
    if total:
        res = res.withColumn(total, F.col("_n"))
    return res.drop("_pk", "_id", "_range", "_row", "_shift", "_n")


def ntile_part(position: str | Column, total: Column, parts: int) -> Column:
    """Part (1..parts) of a 1-based position when ``total`` rows are
    split into contiguous parts and the first ``total % parts`` parts get one
    extra row -- the ``ntile`` rule."""
    i = (F.col(position) if isinstance(position, str) else position) - 1
    q = F.floor(total / parts)
    r = total - q * parts
    big = r * (q + 1)
    return (F.when(i < big, F.floor(i / (q + 1)))
            .otherwise(r + F.floor(F.try_divide(i - big, q)))).cast("int") + 1


def balanced_parts(df: DataFrame, order: Sequence[str], parts: int, out: str = "part") -> DataFrame:
    """Tag every row with its contiguous balanced part (the row total
    comes with the positions, so no separate counting pass)."""
    return row_position(df, order, out="_pos", total="_n_all") \
        .withColumn(out, ntile_part("_pos", F.col("_n_all"), parts)).drop("_pos", "_n_all")
