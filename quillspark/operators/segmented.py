"""Per-entity windows that split a hot entity over many tasks.

A window partitioned by entity runs each entity in one task, so an entity
holding a third of the rows is a third of the job in one task. These
versions need a dense 1-based position per entity (``split.row_position``
gives one without a single-task window) and cut every entity into chunks of
``chunk_rows`` consecutive positions. Each chunk is its own window
partition; what crosses a chunk boundary is carried explicitly:

* lags / rolling frames: the last ``k`` rows of a chunk are copied into the
  next chunk as halo rows (used as history, then dropped);
* running sums: per-chunk totals -> running offsets over the small
  (entity, chunk) table, joined back;
* forward fill: the last non-null value of each chunk -> the last non-null
  of all earlier chunks over the same small table, joined back.

Chunks and halos count on consecutive positions. Any position column that
orders an entity will do: by default rows are numbered anew by it
(``split.row_position``). ``dense=True`` says that the positions are
consecutive already (a prefix may be missing, as after dropping the leading
rows of a series) and saves that sort. Results equal the plain windows
exactly.

Plan shape: the entity columns are packed into one struct key (never NULL;
equal structs with NULL fields match), so the window partitioning
(key, chunk) is reused by the side-table joins instead of re-shuffling the
rows, and side tables are read off the window outputs (the running value at
a chunk's last row), so both branches share one shuffle of the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .split import row_position

DEFAULT_CHUNK_ROWS = 100_000
PK = "_pk"


def entity_key(partition: Sequence[str]) -> Column:
    """One non-null join/partition key for the entity columns."""
    return F.struct(*partition) if partition else F.lit(0)


def _numbered(df: DataFrame, partition: Sequence[str], position: str,
              dense: bool) -> tuple[DataFrame, str]:
    """The frame and its column of consecutive positions."""
    if dense:
        return df, position
    return row_position(df, [position], partition, out="_dense"), "_dense"


def _spec(position: str) -> Window:
    return Window.partitionBy(PK, "_chunk").orderBy(position)


def _chunked(df: DataFrame, partition: Sequence[str], position: str, chunk_rows: int) -> DataFrame:
    return df.withColumn(PK, entity_key(partition)).withColumn(
        "_chunk", F.floor((F.col(position) - 1) / chunk_rows))


def _with_halo(df: DataFrame, partition: Sequence[str], position: str, chunk_rows: int, k: int) -> DataFrame:
    """Every row once in its own chunk; the last ``k`` rows of a chunk a
    second time, flagged as halo, in the next chunk. One generator over one
    pass of the input (a union would evaluate the input twice)."""
    keyed = df.withColumn(PK, entity_key(partition))
    chunk = F.floor((F.col(position) - 1) / chunk_rows)
    if k <= 0:
        return keyed.withColumn("_chunk", chunk).withColumn("_halo", F.lit(False))
    tail = F.pmod(F.col(position) - 1, F.lit(chunk_rows)) >= chunk_rows - k
    copies = F.when(tail, F.array(F.struct(chunk.alias("c"), F.lit(False).alias("h")),
                                  F.struct((chunk + 1).alias("c"), F.lit(True).alias("h")))) \
        .otherwise(F.array(F.struct(chunk.alias("c"), F.lit(False).alias("h"))))
    return (keyed.select("*", F.explode(copies).alias("_copy"))
            .select("*", F.col("_copy.c").alias("_chunk"), F.col("_copy.h").alias("_halo")).drop("_copy"))


def _carry(local: DataFrame, position: str, value: str, how: str) -> DataFrame:
    """Per chunk, the combination of ``value`` at the last row of every
    earlier chunk of the entity: running total (``sum``) or last non-null
    (``last``). Read off the window output, over the small (key, chunk) table."""
    # The whole last row is taken (then one field read), so column pruning
    # leaves this branch's input identical to the main branch's and the
    # shuffle under the window is reused instead of recomputed.
    last_row = F.max_by(F.struct(*[F.col(c) for c in local.columns]), F.col(position))
    ends = local.groupBy(PK, "_chunk").agg(last_row.getField(value).alias("_end"))
    earlier = Window.partitionBy(PK).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    combined = F.sum("_end") if how == "sum" else F.last("_end", ignorenulls=True)
    return ends.select(PK, "_chunk", combined.over(earlier).alias("_carry"))


def _add_carried_sum(local: DataFrame, position: str, running: str, out: str,
                     shown: str | None = None) -> DataFrame:
    """Running total over chunks: the totals (``running`` at their ends) of the
    earlier ones plus ``shown`` (``running`` itself by default)."""
    shown = shown or running
    joined = local.join(_carry(local, position, running, "sum"), [PK, "_chunk"], "left")
    total = F.when(F.col("_carry").isNull(), F.col(shown)).otherwise(
        F.col("_carry") + F.coalesce(F.col(shown), F.lit(0)))
    return joined.withColumn(out, total).drop("_carry", running, shown)


def lags(df: DataFrame, partition: Sequence[str], position: str, columns: Sequence[str],
         lag_values: Sequence[int], name: str = "{col}_lag_{k}", lag_major: bool = True,
         chunk_rows: int = DEFAULT_CHUNK_ROWS, dense: bool = False) -> DataFrame:
    """``lag(c, k)`` by position for every column and lag (see ``windows.add_lags``)."""
    return window_pass(df, partition, position, lag_columns=columns, lag_values=lag_values,
                       lag_name=name, lag_major=lag_major, chunk_rows=chunk_rows, dense=dense)


def rolling_mean(df: DataFrame, partition: Sequence[str], position: str, column: str,
                 rows: int = 4, out: str | None = None,
                 chunk_rows: int = DEFAULT_CHUNK_ROWS, dense: bool = False) -> DataFrame:
    """Mean of the current row and the ``rows - 1`` before it."""
    return window_pass(df, partition, position, chunk_rows=chunk_rows, dense=dense,
                       rolling=[(column, rows, out or f"rolling_avg_{column}", None)])


def cumulative_sum(df: DataFrame, partition: Sequence[str], position: str, column: str,
                   out: str | None = None, chunk_rows: int = DEFAULT_CHUNK_ROWS,
                   dense: bool = False) -> DataFrame:
    """Running sum by position (positions are unique, so RANGE == ROWS)."""
    return window_pass(df, partition, position, chunk_rows=chunk_rows, dense=dense,
                       cumulative=[(column, out or f"cumulative_{column}", None)])


def range_total(df: DataFrame, partition: Sequence[str], order: str, column: str,
                out: str | None = None, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Running sum by ``order`` with the RANGE rule: rows that tie share the
    total up to the last of them, as in ``windows.cumulative_sum``.

    The ties of an entity are peers: their values are summed first (a partial
    aggregate, so no task holds all peers of a hot value), the running sum goes
    over one row per peer group in chunks, and a join gives every row the total
    of its group. Ties therefore never straddle a chunk. Null order values are
    peers of each other and come first; null values add nothing, and a total is
    null until the first value.
    """
    of = {"_entity": entity_key(partition), "_peer": F.struct(order)}
    peers = df.select(*[c.alias(n) for n, c in of.items()], F.col(column).alias("_value")) \
        .groupBy(*of).agg(F.sum("_value").alias("_sum"))
    peers = row_position(peers, ["_peer"], ["_entity"], out="_place")
    totals = cumulative_sum(peers, ["_entity"], "_place", "_sum", "_total", chunk_rows, dense=True)
    return df.withColumns(of).join(totals.select(*of, "_total"), list(of)) \
        .withColumnRenamed("_total", out or f"cumulative_{column}").drop(*of)


def forward_fill(df: DataFrame, partition: Sequence[str], position: str, column: str,
                 out: str | None = None, chunk_rows: int = DEFAULT_CHUNK_ROWS,
                 dense: bool = False) -> DataFrame:
    """Last non-null ``column`` value up to and including the row."""
    out = out or column
    df, position = _numbered(df, partition, position, dense)
    local = _chunked(df, partition, position, chunk_rows).withColumn(
        "_ff", F.last(column, ignorenulls=True).over(_spec(position)))
    joined = local.join(_carry(local, position, "_ff", "last"), [PK, "_chunk"], "left")
    return joined.withColumn(out, F.coalesce("_ff", "_carry")) \
        .drop(PK, "_chunk", "_ff", "_carry", "_dense")


def window_pass(df: DataFrame, partition: Sequence[str], position: str, *,
                lag_columns: Sequence[str] = (), lag_values: Sequence[int] = (),
                lag_name: str = "{col}_lag_{k}", lag_major: bool = True,
                rolling: Sequence[tuple] = (), cumulative: Sequence[tuple] = (),
                chunk_rows: int = DEFAULT_CHUNK_ROWS, dense: bool = False,
                exclude_current: bool = False) -> DataFrame:
    """Lags, rolling means and running sums in one chunked window pass.

    ``rolling``: (column, rows, out, condition or None) -- mean over the
    current and ``rows - 1`` previous rows of the values whose condition
    holds. ``cumulative``: (column, out, condition or None) -- running sum of
    the values whose condition holds. A condition that is false only on a
    leading run of each entity makes these equal to computing them after
    filtering that run away, without a second pass. All outputs share one
    halo'd partitioning by (entity, chunk); running sums add the totals of
    earlier chunks from the small (entity, chunk) table. ``exclude_current``
    leaves the row itself out: rolling means cover the ``rows`` rows before it,
    running sums what comes before it.
    """
    df, position = _numbered(df, partition, position, dense)
    lead = 1 if exclude_current else 0
    k = max([*lag_values, *[r[1] - 1 + lead for r in rolling], 0])
    if k >= chunk_rows:
        raise ValueError("chunk_rows must exceed the longest lag or frame")
    both = _with_halo(df, partition, position, chunk_rows, k)
    w = _spec(position)
    pairs = ([(c, v) for v in lag_values for c in lag_columns] if lag_major
             else [(c, v) for c in lag_columns for v in lag_values])
    cols = [F.lag(c, v).over(w).alias(lag_name.format(col=c, k=v)) for c, v in pairs]

    def cond_value(c: str, cond):
        return F.col(c) if cond is None else F.when(cond, F.col(c))
    for c, rows, out, cond in rolling:
        cols.append(F.avg(cond_value(c, cond)).over(w.rowsBetween(-(rows - 1) - lead, -lead)).alias(out))
    own = ~F.col("_halo")
    for c, out, cond in cumulative:
        value = F.when(own, cond_value(c, cond))
        cols.append(F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_run_{out}"))
        if exclude_current:
            cols.append(F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1))
                        .alias(f"_before_{out}"))
    res = both.select("*", *cols).where(own)
    for c, out, cond in cumulative:
        res = _add_carried_sum(res, position, f"_run_{out}", out,
                               f"_before_{out}" if exclude_current else None)
    return res.drop(PK, "_chunk", "_halo", "_dense")
