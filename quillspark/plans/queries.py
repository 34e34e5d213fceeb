"""Queries bound to the driver's tables, one per catalogue entry.

Every function takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the whole tables. Computed columns carry the same names as the DuckDB
oracle statements in ``oracle.py``. Doubles are exact where the arithmetic
allows it (fixed-point money means, ratios of integer counts, means of
integer sums), so they do not depend on partial-sum order; only inherently
inexact statistics (deviations, correlations, t, r2, MAPE, rolling and
running sums of floating values) are rounded.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import block_start, fixed_point_mean
from ..functions.parsing import (bool_text_flag, cast_columns, digits_only, in_list_flag, int_text_in_range,
                                 pad_key, safe_date, safe_timestamp, year_or_null)
from ..functions.time import month_label
from ..operators import aggregates as agg
from ..operators import segmented
from ..operators.features import weekly_features, weekly_market
from ..operators.folds import walk_forward_folds
from ..operators.lines import label_mean_by_year, merge_lines, text_lines, words_of
from ..operators.mailstore import read_mail_store, scan_store, write_mail_store
from ..operators.messages import message_condition, message_table, scan_latest
from ..operators.metrics import group_error, regression_metrics
from ..operators.pairs import pair_counts, recommend
from ..operators.split import balanced_parts, row_position
from ..operators.stats import pooled_t_test, top_correlations, two_period_counts, two_period_summary
from ..operators.windows import carry_previous_block
from ..session import materialize, shared_folder
from ..sources.tables import Tables
from ..sources.text import naive_split, parse_csv_lines, parse_messages

# Fixed values of the bindings (shared with oracle.py).
RECENT_YEARS_BACK = 3            # D2: max - 3 <= year <= max
CORR_YEARS_BACK = 5              # D3: year >= max - 5
FIRST_PERIOD = ("1995-01-01", "1998-05-16")
SECOND_PERIOD = ("1998-05-16", "2001-09-01")
HIGH_PRIORITY = ("1-URGENT", "2-HIGH")
LOW_PRIORITY = ("3-MEDIUM", "4-NOT SPECIFIED")
RECOMMEND_TARGET = 150
LIKED_QUANTITY = 3               # D11: rating > 3
SPLIT_PARTS = 7
MAIL_DOMAIN = "chat.example"
MAIL_BASE_LOCAL = "2001-11-20 08:00:00"
MAIL_ZONE = " -0800 (PST)"
MAIL_ZONE_SECONDS = 8 * 3600
FILTER_RECIPIENT = f"assistant@{MAIL_DOMAIN}"
FILTER_MONTH_TEXT = "Dec 2001"
FILTER_MONTH = "2001-12"
RANGE_CHUNK_ROWS = 1000           # G6: days in a chunk
GET_ROW_KEY = "conv_7/0"
CSV_HEADER = "ID,Date,Description,Status,Priority,Price,Year"
CSV_DDL = ("ID long, Date string, Description string, Status string, Priority string, "
           "Price double, Year string")
NGRAM_BASE_YEAR = 1990
NGRAM_YEAR_SPAN = 30


def _t(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


def _round(df: DataFrame, digits: int = 6, skip: tuple[str, ...] = ()) -> DataFrame:
    """Round every double column (oracle comparisons hash exact values)."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" and c not in skip else F.col(c)
                       for c, t in df.dtypes])


def _orders_customers(t: Tables, order_cols: list[str], cust_cols: list[str]) -> DataFrame:
    o = t.orders.select(*order_cols)
    c = t.customer.select("c_custkey", *cust_cols)
    return o.join(c, o.o_custkey == c.c_custkey).drop("c_custkey")


# --------------------------------------------------------------- J3: F2, A9
def avg_count_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _t(spark, sf_dir).orders.select(F.year("o_orderdate").alias("year"),
                                             F.month("o_orderdate").alias("month"))
    return agg.avg_of_counts(orders, outer=["month"], inner=["year"])


def priority_share_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text over a frame passed as a parameter."""
    return spark.sql(
        """SELECT o_orderpriority AS priority, count(*) AS n_orders,
                  count_if(o_orderstatus = 'F') AS n_fulfilled,
                  round(count_if(o_orderstatus = 'F') * 100.0D / count(*), 4) AS pct_fulfilled
           FROM {orders} WHERE o_totalprice >= {least} GROUP BY o_orderpriority""",
        orders=_t(spark, sf_dir).orders, least=1000)


def _since_year(orders: DataFrame, back: int) -> DataFrame:
    """Rows of the newest year and ``back`` years before it. The bound is a
    date computed in a scalar subquery and compared with the bare column, so
    it is pushed to the scan."""
    kind = dict(orders.dtypes)["o_orderdate"]
    first = orders.select(F.make_date(F.year(F.max("o_orderdate")) - back, F.lit(1), F.lit(1))
                          .cast(kind)).scalar()
    return orders.where(F.col("o_orderdate") >= first)


# --------------------------------------------------------------- J4: D2 F1 F12 H2
def top_keys_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    recent = _since_year(t.orders.select("o_custkey", "o_orderdate"), RECENT_YEARS_BACK)
    per_cust = agg.count_by(recent, ["o_custkey"], "n")
    named = per_cust.join(t.customer.select("c_custkey", "c_name"),
                          per_cust.o_custkey == F.col("c_custkey"))
    counts = named.groupBy("c_name").agg(F.sum("n").alias("n_events"))
    return agg.top_k(counts, 10, F.desc("n_events"), F.asc("c_name"))


# --------------------------------------------------------------- J5: F13 L1 D3 H3
def pair_correlation_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    recent = _since_year(t.orders.select("o_custkey", "o_orderdate"), CORR_YEARS_BACK) \
        .select("o_custkey", F.year("o_orderdate").alias("year"))
    per_cust = agg.count_by(recent, ["o_custkey", "year"], "n")
    counts = (per_cust.join(t.customer.select("c_custkey", "c_nationkey"),
                            per_cust.o_custkey == F.col("c_custkey"))
              .groupBy("c_nationkey", "year").agg(F.sum("n").alias("n")))
    return top_correlations(counts, "c_nationkey", "year", "n", 10)


# --------------------------------------------------------------- J6: D5 E5 C16 F14 L2
def _per_nation_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    per_cust = two_period_counts(t.orders.select("o_custkey", "o_orderdate"), "o_custkey",
                                 "o_orderdate", FIRST_PERIOD, SECOND_PERIOD)
    return (per_cust.join(t.customer.select("c_custkey", "c_nationkey"),
                          per_cust.o_custkey == F.col("c_custkey"))
            .groupBy("c_nationkey").agg(F.sum("n_first").alias("n_first"),
                                        F.sum("n_second").alias("n_second")))


def two_period_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = two_period_summary(_per_nation_periods(spark, sf_dir))
    # Means of integer counts are exact; the deviations and t are rounded.
    return s.select("n_keys", "mean_first", F.round("sd_first", 6).alias("sd_first"), "mean_second",
                    F.round("sd_second", 6).alias("sd_second"), F.round("t_stat", 6).alias("t_stat"), "dof")


def two_period_pvalue(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = pooled_t_test(_per_nation_periods(spark, sf_dir))
    return res.select("n_keys", F.round("t_stat", 6).alias("t_stat"), "dof", F.round("p_value", 6).alias("p_value"))


# --------------------------------------------------------------- J8: F5 C4 C17
def _events_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir).events
    return e.select("event_id", "ts", (F.col("event_type") == "purchase").cast("int").alias("flag"))


def rate_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events_flagged(spark, sf_dir).withColumn("hour", F.hour("ts"))
    return agg.rate_by(e, "hour", "event_id", "flag")


def rate_by_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events_flagged(spark, sf_dir).withColumn("day_of_week", F.dayofweek("ts"))
    return agg.rate_by(e, "day_of_week", "event_id", "flag")


def rate_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir).orders.select(
        "o_orderkey", F.month("o_orderdate").alias("month"),
        (F.col("o_orderstatus") == "F").cast("int").alias("flag"))
    return agg.rate_by(o, "month", "o_orderkey", "flag")


def rate_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events_flagged(spark, sf_dir)
    dims = {"hour": F.hour("ts"), "day_of_week": F.dayofweek("ts"), "month": F.month("ts")}
    return agg.rates_grouping_sets(e, dims, "event_id", "flag")


# --------------------------------------------------------------- J1: A6 C11 C12 D4 F3
def ngram_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of every document as an n-gram record (word, year text,
    volume): year := base + doc_id mod span, volume := n_chars. Years are
    validated like the line reader does (``0 < year <= 2024``)."""
    docs = _t(spark, sf_dir).documents.select("doc_id", "text", "n_chars")
    words = words_of(docs, "text", keep=["doc_id", "n_chars"])
    year = (F.lit(NGRAM_BASE_YEAR) + F.pmod("doc_id", F.lit(NGRAM_YEAR_SPAN))).cast("string")
    return (words.select("word", year.alias("year"), F.col("n_chars").cast("double").alias("volume"))
            .where(int_text_in_range("year", 0, 2024)))


def label_mean_by_year_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_mean_by_year(ngram_records(spark, sf_dir))


# --------------------------------------------------------------- J2: F4 H5
def max_by_key_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    per_cust = agg.max_by_key(t.orders.select("o_custkey", "o_totalprice"), "o_custkey",
                              "o_totalprice", "max_value")
    named = per_cust.join(t.customer.select("c_custkey", "c_name"),
                          per_cust.o_custkey == F.col("c_custkey"))
    return agg.max_by_key(named, "c_name", "max_value", "max_value")


# --------------------------------------------------------------- J11: E6 F16 F17 H4
def pair_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir).lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    return pair_counts(li, "l_orderkey", "l_partkey", liked=F.col("l_quantity") > LIKED_QUANTITY)


def _customer_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    o = t.orders.select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey).select("o_custkey", "l_partkey", "l_quantity")


def recommend_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend(_customer_ratings(spark, sf_dir), "o_custkey", "l_partkey", RECOMMEND_TARGET,
                     liked=F.col("l_quantity") > LIKED_QUANTITY, k=50)


def recommend_items_symmetric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend(_customer_ratings(spark, sf_dir), "o_custkey", "l_partkey", RECOMMEND_TARGET,
                     liked=F.col("l_quantity") > LIKED_QUANTITY, k=50, symmetric=True)


# --------------------------------------------------------------- J7: weekly table
def _market(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir).lineitem.select("l_shipdate", "l_extendedprice")
    return weekly_market(li, "l_shipdate", "l_extendedprice", decimals=2)


def weekly_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _market(spark, sf_dir)


def weekly_features_frame(spark: SparkSession, sf_dir: str, approx_distinct: bool = False) -> DataFrame:
    t = _t(spark, sf_dir)
    orders = t.orders
    facts = _orders_customers(t, ["o_orderdate", "o_custkey", "o_orderstatus", "o_orderpriority"],
                              ["c_nationkey", "c_mktsegment"]).withColumn("entity", pad_key("c_nationkey"))
    market = _market(spark, sf_dir).select("year", "week_of_year", "avg_weekly_close", "weekly_close_change")
    demographics = t.customer.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).cast("double").alias("population"),
        fixed_point_mean("c_acctbal", 2).alias("med_income"),
        F.max("c_acctbal").alias("max_acctbal"),
        F.min("c_acctbal").alias("min_acctbal"),
    ).select(pad_key(F.col("c_nationkey").cast("string")).alias("entity_padded"),
             "population", "med_income", "max_acctbal", "min_acctbal")
    table = weekly_features(
        facts, market, demographics, entity="entity", ts="o_orderdate",
        class_flags={"total_high_priority": in_list_flag("o_orderpriority", HIGH_PRIORITY),
                     "total_low_priority": in_list_flag("o_orderpriority", LOW_PRIORITY)},
        flag_sums={"total_fulfilled": in_list_flag("o_orderstatus", ["F"]),
                   "total_pending": in_list_flag("o_orderstatus", ["P"])},
        distincts={"num_segments": "c_mktsegment", "num_statuses": "o_orderstatus",
                   "num_customers": "o_custkey", "num_priorities": "o_orderpriority"},
        demo_key="entity_padded", total="total_orders",
        lag_columns=("total_orders", "total_fulfilled", "total_pending"),
        approx_distinct=approx_distinct,
        dictionaries={"c_mktsegment": t.customer, "o_orderstatus": orders, "o_orderpriority": orders,
                      "o_custkey": orders})
    return table.withColumnRenamed("entityIndex", "entity_index")


def weekly_features_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly_features_frame(spark, sf_dir)


def _lag_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(weekly_features_frame(spark, sf_dir)).withColumn(
        "prediction", F.col("total_orders_lag_1").cast("double"))


def regression_metrics_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    pred = _lag_forecast(spark, sf_dir)
    m = regression_metrics(pred, "total_orders", "prediction",
                           subsets={"high_priority": F.col("total_high_priority") > 0})
    # Integer labels and predictions: n, rmse (sqrt of an exact sum) and mae
    # are exact; r2 and mape involve inexact sums and are rounded.
    return m.withColumn("r2", F.round("r2", 6)).withColumn("mape", F.round("mape", 6))


def group_error_by_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Squared errors of integer counts: the per-bin means are exact.
    return group_error(_lag_forecast(spark, sf_dir), "total_orders", "prediction", "med_income", bins=5)


def next_period_of(weekly: DataFrame, dates: DataFrame, ts: str) -> DataFrame:
    """Rows of the week after the newest date, one year before it,
    labelled with that week. The target is the ISO week of the newest date plus
    seven days, with the ISO year: the last days of December and the first of
    January belong to the week they are in, and 53-week years come out right."""
    after = dates.select((F.max(F.to_date(ts)) + F.expr("INTERVAL 7 DAY")).alias("d"))
    target = after.select(F.struct(F.extract(F.lit("YEAROFWEEK"), "d").cast("int").alias("y"),
                                   F.weekofyear("d").alias("w"))).scalar()
    year, week = target.getField("y"), target.getField("w")
    source = weekly.where((F.col("year") == year - 1) & (F.col("week_of_year") == week))
    return source.select(*[year.alias(c) if c == "year" else week.alias(c) if c == "week_of_year"
                           else F.col(c) for c in weekly.columns])


def next_period_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return next_period_of(weekly_features_frame(spark, sf_dir),
                          _t(spark, sf_dir).orders, "o_orderdate")


# --------------------------------------------------------------- J9: trading bars
def bars_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars: trade := nation-year, bar_num := position by (date, order key),
    profit := total price, two ``val*`` signals; typed by the name rule."""
    t = _t(spark, sf_dir)
    base = _orders_customers(t, ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice",
                                 "o_orderpriority"], ["c_nationkey", "c_acctbal"])
    bars = base.select(
        (F.col("c_nationkey") * 10000 + F.year("o_orderdate")).alias("trade_id"),
        F.col("o_orderdate").alias("time_stamp"), "o_orderkey",
        F.col("o_totalprice").alias("profit"),
        F.col("c_acctbal").alias("val_acctbal"),
        F.substring("o_orderpriority", 1, 1).alias("val_priority"))
    numbered = row_position(bars, ["time_stamp", "o_orderkey"], ["trade_id"], out="bar_num").drop("o_orderkey")
    typed = cast_columns(numbered, lambda c: None if c == "time_stamp"
                         else "double" if c.startswith("val") or c == "profit" else "int")
    # The numbered bars feed several joins with their own aggregates (block
    # carry, chunk offsets); a checkpoint in the shared folder stops each of
    # those branches from re-running the scan, join and numbering.
    return materialize(typed)


def _carried_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = bars_frame(spark, sf_dir).withColumn("bar_num_group_10", block_start("bar_num", 10))
    carried = carry_previous_block(bars, "trade_id", "bar_num", "profit", 10, "bar_num_group_10")
    return segmented.forward_fill(carried, ["trade_id"], "bar_num", "avg_profit", dense=True)


def forward_fill_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = _carried_bars(spark, sf_dir).where(F.col("avg_profit").isNotNull())
    return _round(filled.select("trade_id", "bar_num", "profit", "bar_num_group_10", "avg_profit"))


def bar_features_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = _carried_bars(spark, sf_dir)
    vals = [c for c in filled.columns if c.startswith("val")]
    # Lags over the full series (before the filter); rolling and running
    # profit over the rows the filter keeps. The filter drops a leading run
    # of each trade (avg_profit is forward-filled), so all three come from
    # one chunked window pass with the filter as a condition.
    kept = F.col("avg_profit").isNotNull()
    cum = segmented.window_pass(
        filled, ["trade_id"], "bar_num", lag_columns=vals, lag_values=[1, 2, 3], lag_name="{col}_lag{k}",
        lag_major=False, rolling=[("profit", 4, "rolling_avg_profit", kept)],
        cumulative=[("profit", "cumulative_profit", kept)], dense=True).where(kept)
    return cum.withColumn("month", month_label("time_stamp"))


def bar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = bar_features_frame(spark, sf_dir).drop("time_stamp")
    rounded = _round(df, 6, skip=("cumulative_profit",))
    return rounded.withColumn("cumulative_profit", F.round("cumulative_profit", 4))


# --------------------------------------------------------------- A1-A5 dirty CSV
def order_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders rendered as CSV text: 12-hour dates, some unparsable or empty,
    a quoted field with a comma for one market segment, and the header."""
    t = _t(spark, sf_dir)
    o = _orders_customers(t, ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
                              "o_orderpriority", "o_totalprice"], ["c_name", "c_mktsegment"])
    pending = F.col("o_orderstatus") == "P"
    date_text = (F.when(pending & (F.col("o_orderpriority") == "5-LOW"), F.lit(""))
                 .when(pending & (F.col("o_orderpriority") == "4-NOT SPECIFIED"), F.lit("13/45/19xx 99:99"))
                 .otherwise(F.date_format("o_orderdate", "MM/dd/yyyy hh:mm:ss a")))
    desc = F.when(F.col("c_mktsegment") == "BUILDING",
                  F.concat(F.lit('"'), F.col("c_name"), F.lit(", "), F.col("c_mktsegment"), F.lit('"'))) \
        .otherwise(F.col("c_name"))
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), date_text, desc, "o_orderstatus",
                       "o_orderpriority", F.col("o_totalprice").cast("string"),
                       F.year("o_orderdate").cast("string"))
    header = spark.range(1).select(F.lit(CSV_HEADER).alias("line"))
    return header.unionByName(o.select(line.alias("line")))


def dirty_csv_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = order_csv_lines(spark, sf_dir)
    csv = parse_csv_lines(lines, "line", CSV_DDL, header=CSV_HEADER)
    both = naive_split(csv, "line", {"naive_date": 1, "naive_year": 6})
    bad_date = safe_timestamp("Date").isNull()
    shifted = ~digits_only("naive_year") | (F.col("naive_year") != F.col("Year"))
    return both.groupBy(F.col("Year").alias("year")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(bad_date).alias("n_bad_dates"),
        F.count_if(shifted).alias("n_shifted"))


def dirty_csv_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dates of the dirty lines by year; lines whose date does
    not parse stay, under a NULL year."""
    csv = parse_csv_lines(order_csv_lines(spark, sf_dir), "line", CSV_DDL, header=CSV_HEADER)
    dated = csv.select(year_or_null("Date").alias("year"), safe_date("Date").alias("date"))
    return dated.groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("first_date"),
                                     F.max("date").alias("last_date"), F.count("date").alias("n_dates"))


def flag_text_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flag rendered as text (also with blanks and in capitals, or missing)
    read in both forms."""
    status = F.col("o_orderstatus")
    flag = F.when(status == "F", F.lit("true")).when(status == "O", F.lit(" TRUE "))
    o = _t(spark, sf_dir).orders.select("o_orderpriority", flag.alias("flag"))
    return o.groupBy(F.col("o_orderpriority").alias("priority")).agg(
        F.sum(bool_text_flag("flag")).alias("n_loose"),
        F.sum(bool_text_flag("flag", null_as_zero=False)).alias("n_exact"),
        F.count(bool_text_flag("flag", null_as_zero=False)).alias("n_known"))


# --------------------------------------------------------------- J10 messages
def message_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns rendered as mail files: (path, text)."""
    c = _t(spark, sf_dir).conversations.select("conv_id", "turn", "role", "text")
    # Wall-clock time without a zone (timestamp_ntz): the rendered text does
    # not depend on the session time zone.
    local = (F.lit(MAIL_BASE_LOCAL).cast("timestamp_ntz")
             + F.make_dt_interval(F.col("conv_id"), F.lit(0), F.col("turn") * 7, F.lit(0)))
    to = (F.when(F.col("role") == "user", F.lit(f"To: assistant@{MAIL_DOMAIN}"))
          .when(F.col("role") == "assistant", F.lit(f"To: user@{MAIL_DOMAIN},\n\tlog@{MAIL_DOMAIN}")))
    date = F.concat(F.lit("Date: "), F.date_format(local, "EEE, d MMM yyyy HH:mm:ss"), F.lit(MAIL_ZONE))
    sender = F.concat(F.lit("From: "), F.col("role"), F.lit(f"@{MAIL_DOMAIN}"))
    text = F.concat(F.concat_ws("\n", to, date, sender), F.lit("\n\n"), F.col("text"))
    path = F.concat(F.lit("mail/conv_"), F.col("conv_id").cast("string"), F.lit("/"),
                    F.col("turn").cast("string"))
    return c.select(path.alias("path"), text.alias("text"))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_table(message_texts(spark, sf_dir))


def message_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _messages(spark, sf_dir)
    return m.select("row_key", "recipient", "date_text", "sender", "body",
                    F.unix_seconds("ts").alias("ts_epoch"))


def message_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_messages(message_texts(spark, sf_dir))
    return scan_latest(parsed, message_condition(recipient=FILTER_RECIPIENT, date_substring=FILTER_MONTH_TEXT))


def message_filter_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D9 typed form: recipient AND the parsed instant's UTC month."""
    parsed = parse_messages(message_texts(spark, sf_dir))
    return scan_latest(parsed, message_condition(recipient=FILTER_RECIPIENT, month=FILTER_MONTH))


# --------------------------------------------------------------- B8, D8-D10 stored messages
_STORES: dict[tuple[str, str], str] = {}


def mail_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored message table of a folder, loaded once in a session: the first
    query that needs it writes it, the others only scan."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _STORES:
        path = f"{shared_folder(spark, '_mail')}/mail-{uuid.uuid4().hex}"
        write_mail_store(_messages(spark, sf_dir), path)
        _STORES[key] = path
    return read_mail_store(spark, _STORES[key])


def message_store_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the store holds in each month: the partitions are the months."""
    return mail_store(spark, sf_dir).groupBy("month").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("recipient").alias("n_recipients"),
        F.sum(F.length("body")).cast("long").alias("body_chars"))


def message_store_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D8 and D9 on the store: recipient AND text of the date."""
    return scan_store(mail_store(spark, sf_dir), recipient=FILTER_RECIPIENT, date_substring=FILTER_MONTH_TEXT)


def message_store_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D8 and D9 in typed form: recipient AND the month, one partition."""
    return scan_store(mail_store(spark, sf_dir), recipient=FILTER_RECIPIENT, month=FILTER_MONTH)


def message_store_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message by its key."""
    return scan_store(mail_store(spark, sf_dir), row_key=GET_ROW_KEY,
                      columns=("row_key", "recipient", "date_text", "sender", "body"))


# --------------------------------------------------------------- G6 with ties
def range_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G6, RANGE rule: value of all orders of a priority up to and including the
    day of the order. Five entities hold all rows and every day is a tie."""
    o = _t(spark, sf_dir).orders.select("o_orderkey", "o_orderpriority", "o_orderdate",
                                        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    totals = segmented.range_total(o, ["o_orderpriority"], "o_orderdate", "cents", "total_cents",
                                   chunk_rows=RANGE_CHUNK_ROWS)
    return totals.select("o_orderkey", "o_orderpriority", "total_cents")


# --------------------------------------------------------------- L14 folds
def walk_forward_folds_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir).orders.select(month_label("o_orderdate").alias("month"))
    return walk_forward_folds(o, "month", 6, 6)


# --------------------------------------------------------------- B10, B9
def split_balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir).orders.select("o_orderkey")
    parts = balanced_parts(o, ["o_orderkey"], SPLIT_PARTS)
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.min("o_orderkey").alias("min_key"),
                                     F.max("o_orderkey").alias("max_key"))


def split_balanced_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B10 on a text key with many ties, broken by the number."""
    c = _t(spark, sf_dir).customer.select("c_mktsegment", "c_name", "c_custkey")
    parts = balanced_parts(c, ["c_mktsegment", "c_name", "c_custkey"], SPLIT_PARTS)
    first = F.struct("c_mktsegment", "c_name")
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n_rows"), F.min(first).alias("lo"),
                                     F.max(first).alias("hi")) \
        .select("part", "n_rows", F.concat_ws("/", "lo.*").alias("min_key"),
                F.concat_ws("/", "hi.*").alias("max_key"))


def merged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of two sources one after the other; ``checksum`` weighs the
    digest of every line by its number in its source, so it holds the order."""
    t = _t(spark, sf_dir)
    docs = text_lines(t.documents.select(F.col("doc_id").alias("k1"),
                                         F.lit(0).cast("long").alias("k2"), "text"), "text", ["k1", "k2"])
    conv = text_lines(t.conversations.select(F.col("conv_id").alias("k1"), F.col("turn").alias("k2"),
                                             "text"), "text", ["k1", "k2"])
    merged = merge_lines({"documents": docs, "conversations": conv}, ["k1", "k2", "line_no"])
    digest = F.conv(F.substring(F.md5(F.col("line").cast("binary")), 1, 7), 16, 10).cast("long")
    lines = merged.select("source_no", "source", "k1", "k2", "line_no", digest.alias("digest"),
                          F.length("line").alias("length"))
    numbered = row_position(lines, ["k1", "k2", "line_no"], ["source_no"], out="n")
    return numbered.groupBy("source_no", "source").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("length").cast("long").alias("n_chars"),
        F.count_if(F.col("length") == 0).alias("n_empty"),
        F.sum((F.col("n") * F.col("digest")) % 1000003).cast("long").alias("checksum"))
