"""Registry of bound queries: key -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import queries as q
from . import roundtrips

Query = Callable[[SparkSession, str], DataFrame]

SQL_CHECKED: dict[str, Query] = {
    "avg_count_by_month": q.avg_count_by_month,
    "top_keys_recent": q.top_keys_recent,
    "pair_correlation_top": q.pair_correlation_top,
    "two_period_stats": q.two_period_stats,
    "rate_by_hour": q.rate_by_hour,
    "rate_by_weekday": q.rate_by_weekday,
    "rate_by_month": q.rate_by_month,
    "rate_grouping_sets": q.rate_grouping_sets,
    "label_mean_by_year": q.label_mean_by_year_q,
    "max_by_key": q.max_by_key_q,
    "pair_counts": q.pair_counts_q,
    "recommend_items": q.recommend_items,
    "recommend_items_symmetric": q.recommend_items_symmetric,
    "weekly_metrics": q.weekly_metrics,
    "weekly_features": q.weekly_features_q,
    "forward_fill_bars": q.forward_fill_bars,
    "bar_features": q.bar_features,
    "dirty_csv_parse": q.dirty_csv_parse,
    "dirty_csv_years": q.dirty_csv_years,
    "flag_text_counts": q.flag_text_counts,
    "message_parse": q.message_parse,
    "message_filter": q.message_filter,
    "message_filter_month": q.message_filter_month,
    "message_store_months": q.message_store_months,
    "message_store_filter": q.message_store_filter,
    "message_store_month": q.message_store_month,
    "message_store_get": q.message_store_get,
    "regression_metrics": q.regression_metrics_q,
    "group_error_by_bin": q.group_error_by_bin,
    "range_totals": q.range_totals,
    "walk_forward_folds": q.walk_forward_folds_q,
    "next_period_rows": q.next_period_rows,
    "split_balanced": q.split_balanced,
    "merged_lines": q.merged_lines,
    "priority_share_sql": q.priority_share_sql,
    "split_balanced_names": q.split_balanced_names,
    "two_period_pvalue": q.two_period_pvalue,
    **roundtrips.QUERIES,
}

def all_queries() -> dict[str, Query]:
    from ..ml import bindings as ml

    return {**SQL_CHECKED, **ml.QUERIES}
