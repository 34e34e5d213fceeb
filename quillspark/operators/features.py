"""Weekly per-entity feature table.

Plan shape, chosen for scale:

* facts are aggregated to (entity, year, week) **before** the market
  series is attached: the market columns depend only on (year, week), so
  joining ~weeks rows after the aggregate replaces a join of every fact
  row. The inner join still drops entity-weeks without market data, which
  is what dropping their facts first would have done.
* the entity frequency index (what ``StringIndexer`` computes) is the
  per-entity sum of the aggregated row counts, ranked over the small
  entity table, instead of a separate pass over the facts.
* the lags are one ``select`` over a window partitioned by entity.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import fixed_point_mean, pct_change
from ..session import materialize
from .distinct import grouped
from .split import row_position
from .windows import add_lags, global_lag


def weekly_market(series: DataFrame, ts: str, value: str, out: str = "avg_weekly_close",
                  change: str = "weekly_close_change", decimals: int | None = None) -> DataFrame:
    """Mean value per (year, ISO week), previous week's mean
    (global lag over the weekly rows) and percent change; NULLs -> 0.
    ``decimals``: the values are fixed-point (e.g. money), averaged exactly."""
    mean = fixed_point_mean(value, decimals) if decimals is not None else F.avg(value)
    weekly = series.groupBy(F.year(ts).alias("year"), F.weekofyear(ts).alias("week_of_year")).agg(
        mean.alias(out))
    lagged = global_lag(weekly, ["year", "week_of_year"], out, 1, f"{out}_lag_1")
    return lagged.withColumn(change, pct_change(out, f"{out}_lag_1")).na.fill(0)


def frequency_index(df: DataFrame, key: str, weight: str | None = None, out: str | None = None,
                    ranged: bool = False) -> DataFrame:
    """L3: ``StringIndexer`` order as a column: 0 for the most frequent key,
    ties alphabetical. ``weight`` sums pre-aggregated row counts.

    The rank runs on the one-row-per-key table, never on fact rows. By
    default that is one window (key sets are dimension-sized, like the
    weekly series); ``ranged=True`` ranks it with range-chunked positions
    (``split.row_position``) for key sets too large for one task.
    """
    out = out or f"{key}Index"
    freq = df.groupBy(key).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_f"))
    if ranged:
        ranked = row_position(freq.withColumn("_neg_f", -F.col("_f")), ["_neg_f", key], out="_pos") \
            .select(key, (F.col("_pos") - 1).cast("double").alias(out))
    else:
        ranked = freq.select(key, (F.row_number().over(Window.orderBy(F.desc("_f"), F.asc(key))) - 1)
                             .cast("double").alias(out))
    return df.join(ranked, key)


def weekly_features(facts: DataFrame, market: DataFrame, demographics: DataFrame, *,
                    entity: str, ts: str, class_flags: Mapping[str, Column],
                    flag_sums: Mapping[str, Column], distincts: Mapping[str, str],
                    demo_key: str, total: str = "total",
                    lag_columns: Sequence[str] = ("total",),
                    lags: Sequence[int] = (1, 2, 3, 4), fixed: bool = False,
                    approx_distinct: bool = False, fact_filter: Column | None = None,
                    dictionaries: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """One row per (entity, year, ISO week) with class totals, flag sums,
    distinct counts, lags of the totals and the entity's static attributes.

    ``class_flags``: output name -> 0/1 column; summed as ``sum(when(flag=1,
    1))`` so an entity-week without a match is NULL, not 0 (F6). ``total``
    is the sum of the class totals, NULL if any is NULL (F7) unless
    ``fixed`` coalesces them first; the final fill turns NULLs to 0 only
    after the lags. Distinct counts are exact, by bitmaps (``distinct.grouped``,
    which ``dictionaries`` is for); ``approx_distinct`` swaps them for
    HyperLogLog sketches.
    ``fact_filter`` (e.g. ``col.isin(classes)``) restricts the facts first;
    it is pushed to the fact scan.
    """
    if fact_filter is not None:
        facts = facts.where(fact_filter)
    aggs = ([F.sum(F.when(c == 1, 1)).alias(n) for n, c in class_flags.items()]
            + [F.sum(c).alias(n) for n, c in flag_sums.items()])
    rows = F.count(F.lit(1)).alias("_rows")
    keys = [entity, "year", "week_of_year"]
    dated = facts.withColumns({"year": F.year(ts), "week_of_year": F.weekofyear(ts)})
    if approx_distinct:
        sketches = [F.approx_count_distinct(c).alias(n) for n, c in distincts.items()]
        weeks = dated.groupBy(*keys).agg(*aggs, *sketches, rows)
    else:
        weeks = grouped(dated, keys, [*aggs, rows], distincts, dictionaries)
    # Entity-weeks are an aggregate (entities x weeks rows) read by the rank
    # and by the lag/demographics branch: checkpointed once so the fact scan
    # and joins are not re-run per branch.
    weeks = materialize(weeks.join(market, ["year", "week_of_year"]))
    indexed = frequency_index(weeks, entity, weight="_rows").drop("_rows")
    parts = [F.coalesce(F.col(n), F.lit(0)) if fixed else F.col(n) for n in class_flags]
    total_col = parts[0]
    for p in parts[1:]:
        total_col = total_col + p
    with_total = indexed.withColumn(total, total_col)
    lagged = add_lags(with_total, [entity], ["year", "week_of_year"], lag_columns, lags)
    joined = lagged.join(demographics, F.col(entity) == F.col(demo_key)).drop(demo_key)
    return joined.na.fill(0)
