"""DuckDB statements equivalent to the queries in ``queries.py``.

Run against views named after the driver tables. Casts align DuckDB's
result types with Spark's (``year()``/``month()``/``week()`` are BIGINT
in DuckDB, INT in Spark; ``sum`` of integers is HUGEINT; ``dayofweek`` is
0-based on Sunday in DuckDB, 1-based in Spark).
"""

from __future__ import annotations

from . import queries as q
from . import roundtrips

_P1, _P2 = q.FIRST_PERIOD, q.SECOND_PERIOD
_HIGH = ", ".join(f"'{v}'" for v in q.HIGH_PRIORITY)
_LOW = ", ".join(f"'{v}'" for v in q.LOW_PRIORITY)

AVG_COUNT_BY_MONTH = """
SELECT CAST(month AS INTEGER) AS month, ROUND(AVG(n), 2) AS avg_count
FROM (SELECT year(o_orderdate) AS y, month(o_orderdate) AS month, COUNT(*) AS n
      FROM orders GROUP BY 1, 2) t
GROUP BY month ORDER BY month
"""

TOP_KEYS_RECENT = f"""
WITH o AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS yr FROM orders),
     m AS (SELECT max(yr) AS my FROM o)
SELECT c.c_name, CAST(count(*) AS BIGINT) AS n_events
FROM o JOIN customer c ON o.o_custkey = c.c_custkey, m
WHERE o.yr BETWEEN m.my - {q.RECENT_YEARS_BACK} AND m.my
GROUP BY c.c_name ORDER BY n_events DESC, c.c_name LIMIT 10
"""

PAIR_CORRELATION_TOP = f"""
WITH o AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS yr FROM orders),
     m AS (SELECT max(yr) AS my FROM o),
     sel AS (SELECT c.c_nationkey AS entity, o.yr, count(*) AS n
             FROM o JOIN customer c ON o.o_custkey = c.c_custkey, m
             WHERE o.yr >= m.my - {q.CORR_YEARS_BACK} GROUP BY 1, 2),
     ents AS (SELECT DISTINCT entity FROM sel),
     pers AS (SELECT DISTINCT yr FROM sel),
     grid AS (SELECT e.entity, p.yr, CAST(coalesce(s.n, 0) AS DOUBLE) AS n
              FROM ents e CROSS JOIN pers p LEFT JOIN sel s ON s.entity = e.entity AND s.yr = p.yr),
     live AS (SELECT entity FROM grid GROUP BY entity HAVING stddev_pop(n) > 0),
     pairs AS (SELECT a.entity AS entity_a, b.entity AS entity_b, corr(a.n, b.n) AS c
               FROM grid a JOIN grid b ON a.yr = b.yr AND a.entity < b.entity
               WHERE a.entity IN (SELECT entity FROM live) AND b.entity IN (SELECT entity FROM live)
               GROUP BY 1, 2)
SELECT entity_a, entity_b, round(c, 6) AS corr FROM pairs
ORDER BY corr DESC, entity_a, entity_b LIMIT 10
"""

_PER_NATION = f"""
pk AS (SELECT c.c_nationkey AS k,
              count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '{_P1[0]}' AND o_orderdate < TIMESTAMP '{_P1[1]}') AS n1,
              count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '{_P2[0]}' AND o_orderdate < TIMESTAMP '{_P2[1]}') AS n2
       FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       WHERE (o_orderdate >= TIMESTAMP '{_P1[0]}' AND o_orderdate < TIMESTAMP '{_P1[1]}')
          OR (o_orderdate >= TIMESTAMP '{_P2[0]}' AND o_orderdate < TIMESTAMP '{_P2[1]}')
       GROUP BY 1)
"""

TWO_PERIOD_STATS = f"""
WITH {_PER_NATION}
SELECT count(*) AS n_keys, avg(n1) AS mean_first, round(stddev_pop(n1), 6) AS sd_first,
       avg(n2) AS mean_second, round(stddev_pop(n2), 6) AS sd_second,
       round((avg(n1) - avg(n2)) / nullif(sqrt((var_samp(n1) + var_samp(n2)) / count(*)), 0), 6) AS t_stat,
       2 * count(*) - 2 AS dof
FROM pk
"""


def _rate(key_sql: str, key: str, id_col: str, flag_sql: str, table: str) -> str:
    return f"""
SELECT CAST({key_sql} AS INTEGER) AS {key}, count({id_col}) AS total,
       CAST(sum(CAST({flag_sql} AS INTEGER)) AS BIGINT) AS flagged,
       sum(CAST({flag_sql} AS INTEGER)) / count({id_col}) * 100 AS pct
FROM {table} GROUP BY 1
"""


RATE_BY_HOUR = _rate("hour(ts)", "hour", "event_id", "event_type = 'purchase'", "events")
RATE_BY_WEEKDAY = _rate("dayofweek(ts) + 1", "day_of_week", "event_id", "event_type = 'purchase'", "events")
RATE_BY_MONTH = _rate("month(o_orderdate)", "month", "o_orderkey", "o_orderstatus = 'F'", "orders")

RATE_GROUPING_SETS = """
WITH e AS (SELECT hour(ts) AS h, dayofweek(ts) + 1 AS d, month(ts) AS m, event_id,
                  CAST(event_type = 'purchase' AS INTEGER) AS f FROM events)
SELECT CASE WHEN grouping(h) = 0 THEN 'hour' WHEN grouping(d) = 0 THEN 'day_of_week' ELSE 'month' END AS dimension,
       CAST(CASE WHEN grouping(h) = 0 THEN h WHEN grouping(d) = 0 THEN d ELSE m END AS INTEGER) AS key,
       count(event_id) AS total, CAST(sum(f) AS BIGINT) AS flagged,
       sum(f) / count(event_id) * 100 AS pct
FROM e GROUP BY GROUPING SETS ((h), (d), (m))
"""

LABEL_MEAN_BY_YEAR = f"""
WITH w AS (SELECT doc_id, n_chars, unnest(regexp_split_to_array(text, '\\s+')) AS word FROM documents),
     l AS (SELECT CAST({q.NGRAM_BASE_YEAR} + doc_id % {q.NGRAM_YEAR_SPAN} AS VARCHAR) AS year,
                  CASE WHEN contains(word, 'nu') THEN 'nu' WHEN contains(word, 'chi') THEN 'chi'
                       WHEN contains(word, 'haw') THEN 'haw' END AS substring,
                  CAST(n_chars AS DOUBLE) AS volume
           FROM w WHERE word <> '')
SELECT year, substring, avg(volume) AS avg_volume FROM l
WHERE substring IS NOT NULL GROUP BY 1, 2
"""

MAX_BY_KEY = """
SELECT c.c_name, max(o.o_totalprice) AS max_value
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE o.o_totalprice IS NOT NULL AND NOT isnan(o.o_totalprice)
GROUP BY c.c_name
"""

PAIR_COUNTS = f"""
SELECT a.l_partkey AS m1, b.l_partkey AS m2, count(*) AS pair_cnt
FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey
WHERE a.l_quantity > {q.LIKED_QUANTITY} AND b.l_quantity > {q.LIKED_QUANTITY}
GROUP BY 1, 2
"""

_RATINGS = f"""
r AS (SELECT o.o_custkey AS u, l.l_partkey AS m FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
      WHERE l.l_quantity > {q.LIKED_QUANTITY})
"""

RECOMMEND_ITEMS = f"""
WITH {_RATINGS},
     fp AS (SELECT a.m AS m1, b.m AS m2, count(*) AS pair_cnt FROM r a JOIN r b ON a.u = b.u AND a.m < b.m
            WHERE b.m = {q.RECOMMEND_TARGET} GROUP BY 1, 2)
SELECT m1 AS recommended_item, CAST(sum(pair_cnt) AS BIGINT) AS rec_score FROM fp
GROUP BY m1 ORDER BY rec_score DESC, recommended_item LIMIT 50
"""

RECOMMEND_ITEMS_SYMMETRIC = f"""
WITH {_RATINGS}
SELECT a.m AS recommended_item, count(*) AS rec_score
FROM r a JOIN r b ON a.u = b.u AND a.m <> b.m WHERE b.m = {q.RECOMMEND_TARGET}
GROUP BY 1 ORDER BY rec_score DESC, recommended_item LIMIT 50
"""

_MARKET = """
li AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(week(l_shipdate) AS INTEGER) AS week_of_year,
              CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE)
                  / count(CAST(round(l_extendedprice * 100) AS BIGINT)) / 100 AS a
       FROM lineitem GROUP BY 1, 2),
mk AS (SELECT year, week_of_year, a AS avg_weekly_close,
              coalesce(lag(a) OVER (ORDER BY year, week_of_year), 0) AS avg_weekly_close_lag_1,
              coalesce((a - lag(a) OVER (ORDER BY year, week_of_year))
                       / nullif(lag(a) OVER (ORDER BY year, week_of_year), 0) * 100, 0) AS weekly_close_change
       FROM li)
"""

WEEKLY_METRICS = f"""
WITH {_MARKET}
SELECT year, week_of_year, avg_weekly_close, avg_weekly_close_lag_1, weekly_close_change FROM mk
"""

_LAGGED = ("total_orders", "total_fulfilled", "total_pending")
_LAG_SQL = ",\n".join(f"lag({c}, {k}) OVER w AS {c}_lag_{k}" for k in (1, 2, 3, 4) for c in _LAGGED)
_LAG_OUT = ", ".join(f"coalesce({c}_lag_{k}, 0) AS {c}_lag_{k}" for k in (1, 2, 3, 4) for c in _LAGGED)

WEEKLY_FEATURES_CTE = f"""
{_MARKET},
f AS (SELECT lpad(CAST(c.c_nationkey AS VARCHAR), 4, '0') AS entity,
             CAST(year(o.o_orderdate) AS INTEGER) AS year, CAST(week(o.o_orderdate) AS INTEGER) AS week_of_year,
             o.o_orderpriority, o.o_orderstatus, o.o_custkey, c.c_mktsegment
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
ag AS (SELECT entity, year, week_of_year,
              CAST(sum(CASE WHEN o_orderpriority IN ({_HIGH}) THEN 1 END) AS BIGINT) AS total_high_priority,
              CAST(sum(CASE WHEN o_orderpriority IN ({_LOW}) THEN 1 END) AS BIGINT) AS total_low_priority,
              CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS total_fulfilled,
              CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS total_pending,
              count(DISTINCT c_mktsegment) AS num_segments, count(DISTINCT o_orderstatus) AS num_statuses,
              count(DISTINCT o_custkey) AS num_customers, count(DISTINCT o_orderpriority) AS num_priorities,
              count(*) AS n_rows
       FROM f GROUP BY 1, 2, 3),
j AS (SELECT ag.*, mk.avg_weekly_close, mk.weekly_close_change FROM ag JOIN mk USING (year, week_of_year)),
fr AS (SELECT entity, CAST(row_number() OVER (ORDER BY sum(n_rows) DESC, entity) - 1 AS DOUBLE) AS entity_index
       FROM j GROUP BY entity),
t AS (SELECT j.*, fr.entity_index, total_high_priority + total_low_priority AS total_orders
      FROM j JOIN fr USING (entity)),
lg AS (SELECT *, {_LAG_SQL}
       FROM t WINDOW w AS (PARTITION BY entity ORDER BY year, week_of_year)),
dm AS (SELECT lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS entity_padded, CAST(count(*) AS DOUBLE) AS population,
              CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS DOUBLE)
                  / count(CAST(round(c_acctbal * 100) AS BIGINT)) / 100 AS med_income,
              max(c_acctbal) AS max_acctbal, min(c_acctbal) AS min_acctbal
       FROM customer GROUP BY c_nationkey),
wf AS (SELECT entity, entity_index, year, week_of_year, avg_weekly_close, weekly_close_change,
              coalesce(total_high_priority, 0) AS total_high_priority,
              coalesce(total_low_priority, 0) AS total_low_priority,
              total_fulfilled, total_pending, num_segments, num_statuses, num_customers, num_priorities,
              coalesce(total_orders, 0) AS total_orders, {_LAG_OUT},
              population, med_income, max_acctbal, min_acctbal
       FROM lg JOIN dm ON lg.entity = dm.entity_padded)
"""

WEEKLY_FEATURES = f"WITH {WEEKLY_FEATURES_CTE} SELECT * FROM wf"

_WF_COLUMNS = (["entity", "entity_index", "year", "week_of_year", "avg_weekly_close", "weekly_close_change",
                "total_high_priority", "total_low_priority", "total_fulfilled", "total_pending",
                "num_segments", "num_statuses", "num_customers", "num_priorities", "total_orders"]
               + [f"{c}_lag_{k}" for k in (1, 2, 3, 4) for c in _LAGGED]
               + ["population", "med_income", "max_acctbal", "min_acctbal"])

REGRESSION_METRICS = f"""
WITH {WEEKLY_FEATURES_CTE},
p AS (SELECT CAST(total_orders AS DOUBLE) AS y, CAST(total_orders_lag_1 AS DOUBLE) AS p, total_high_priority FROM wf),
s AS (SELECT 'all' AS subset, y, p FROM p UNION ALL SELECT 'high_priority', y, p FROM p WHERE total_high_priority > 0)
SELECT subset, count(*) AS n, sqrt(sum((y - p) * (y - p)) / count(*)) AS rmse,
       round(1 - sum((y - p) * (y - p)) / nullif(var_pop(y) * count(*), 0), 6) AS r2,
       avg(abs(y - p)) AS mae, round(avg(abs((y - p) / nullif(y, 0))), 6) AS mape
FROM s GROUP BY subset
"""

GROUP_ERROR_BY_BIN = f"""
WITH {WEEKLY_FEATURES_CTE},
r AS (SELECT min(med_income) AS lo, max(med_income) AS hi FROM wf),
b AS (SELECT CASE WHEN r.hi = r.lo THEN 2
                  ELSE least(CAST(floor((med_income - r.lo) / ((r.hi - r.lo) / 5)) AS INTEGER), 4) END AS bin,
             (CAST(total_orders AS DOUBLE) - CAST(total_orders_lag_1 AS DOUBLE)) ** 2 AS se
      FROM wf, r)
SELECT bin, avg(se) AS mse, count(*) AS n FROM b GROUP BY GROUPING SETS ((bin), ())
"""

_NEXT_COLS = ", ".join("tgt.ty AS year" if c == "year" else "tgt.tw AS week_of_year" if c == "week_of_year"
                       else f"wf.{c}" for c in _WF_COLUMNS)

NEXT_PERIOD_ROWS = f"""
WITH {WEEKLY_FEATURES_CTE},
d AS (SELECT CAST(max(o_orderdate) AS DATE) + INTERVAL 7 DAY AS d FROM orders),
tgt AS (SELECT CAST(isoyear(d) AS INTEGER) AS ty, CAST(week(d) AS INTEGER) AS tw FROM d)
SELECT {_NEXT_COLS} FROM wf, tgt WHERE wf.year = tgt.ty - 1 AND wf.week_of_year = tgt.tw
"""

_BARS = """
b AS (SELECT c.c_nationkey * 10000 + CAST(year(o.o_orderdate) AS INTEGER) AS trade_id,
             o.o_orderdate AS time_stamp, o.o_totalprice AS profit, c.c_acctbal AS val_acctbal,
             CAST(substr(o.o_orderpriority, 1, 1) AS DOUBLE) AS val_priority,
             CAST(row_number() OVER (PARTITION BY c.c_nationkey * 10000 + CAST(year(o.o_orderdate) AS INTEGER)
                                     ORDER BY o.o_orderdate, o.o_orderkey) AS INTEGER) AS bar_num
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
g AS (SELECT *, CAST((bar_num - 1) // 10 * 10 AS INTEGER) AS bar_num_group_10 FROM b),
cl AS (SELECT trade_id, bar_num_group_10 + 10 AS bar_num_group_10, avg(profit) AS cl_avg
       FROM g WHERE bar_num % 10 = 0 GROUP BY trade_id, bar_num_group_10),
jn AS (SELECT g.*, cl.cl_avg FROM g LEFT JOIN cl USING (trade_id, bar_num_group_10)),
ff AS (SELECT *, last_value(cl_avg IGNORE NULLS) OVER (PARTITION BY trade_id ORDER BY bar_num
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS avg_profit
       FROM jn)
"""

FORWARD_FILL_BARS = f"""
WITH {_BARS}
SELECT trade_id, bar_num, round(profit, 6) AS profit, bar_num_group_10, round(avg_profit, 6) AS avg_profit
FROM ff WHERE avg_profit IS NOT NULL
"""

_BAR_LAGS = ",\n".join(f"lag({c}, {k}) OVER (PARTITION BY trade_id ORDER BY bar_num) AS {c}_lag{k}"
                       for c in ("val_acctbal", "val_priority") for k in (1, 2, 3))
_BAR_LAG_OUT = ", ".join(f"round({c}_lag{k}, 6) AS {c}_lag{k}"
                         for c in ("val_acctbal", "val_priority") for k in (1, 2, 3))

BAR_FEATURES = f"""
WITH {_BARS},
lg AS (SELECT *, {_BAR_LAGS} FROM ff),
kept AS (SELECT * FROM lg WHERE avg_profit IS NOT NULL)
SELECT trade_id, bar_num, round(profit, 6) AS profit, round(val_acctbal, 6) AS val_acctbal,
       round(val_priority, 6) AS val_priority, bar_num_group_10, round(avg_profit, 6) AS avg_profit,
       {_BAR_LAG_OUT},
       round(avg(profit) OVER (PARTITION BY trade_id ORDER BY bar_num ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), 6)
           AS rolling_avg_profit,
       round(sum(profit) OVER (PARTITION BY trade_id ORDER BY bar_num
                               RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS cumulative_profit,
       strftime(time_stamp, '%Y-%m') AS month
FROM kept
"""

DIRTY_CSV_PARSE = """
SELECT CAST(year(o.o_orderdate) AS VARCHAR) AS year, count(*) AS n_rows,
       count(*) FILTER (WHERE o.o_orderstatus = 'P' AND o.o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED')) AS n_bad_dates,
       count(*) FILTER (WHERE c.c_mktsegment = 'BUILDING') AS n_shifted
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY 1
"""

_LOCAL_TS = f"(TIMESTAMP '{q.MAIL_BASE_LOCAL}' + conv_id * INTERVAL 1 DAY + turn * INTERVAL 7 MINUTE)"

_MESSAGES = f"""
m AS (SELECT 'conv_' || CAST(conv_id AS VARCHAR) || '/' || CAST(turn AS VARCHAR) AS row_key,
             CASE role WHEN 'user' THEN 'assistant@{q.MAIL_DOMAIN}'
                       WHEN 'assistant' THEN 'user@{q.MAIL_DOMAIN},log@{q.MAIL_DOMAIN}'
                       ELSE 'unknown' END AS recipient,
             strftime({_LOCAL_TS}, '%a, %-d %b %Y %H:%M:%S') || '{q.MAIL_ZONE}' AS date_text,
             role || '@{q.MAIL_DOMAIN}' AS sender, text AS body,
             CAST(epoch({_LOCAL_TS}) AS BIGINT) + {q.MAIL_ZONE_SECONDS} AS ts_epoch
      FROM conversations)
"""

MESSAGE_PARSE = f"WITH {_MESSAGES} SELECT * FROM m"

MESSAGE_FILTER = f"""
WITH {_MESSAGES}
SELECT row_key, recipient, date_text, body FROM m
WHERE recipient = '{q.FILTER_RECIPIENT}' AND contains(lower(date_text), lower('{q.FILTER_MONTH_TEXT}'))
"""

MESSAGE_FILTER_MONTH = f"""
WITH {_MESSAGES}
SELECT row_key, recipient, date_text, body FROM m
WHERE recipient = '{q.FILTER_RECIPIENT}'
  AND strftime(TIMESTAMP '1970-01-01 00:00:00' + ts_epoch * INTERVAL 1 SECOND, '%Y-%m') = '{q.FILTER_MONTH}'
"""

DIRTY_CSV_YEARS = """
WITH d AS (SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED') THEN NULL
                       ELSE CAST(o_orderdate AS DATE) END AS date
           FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT CAST(year(date) AS INTEGER) AS year, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date,
       count(date) AS n_dates
FROM d GROUP BY 1
"""

FLAG_TEXT_COUNTS = """
SELECT o_orderpriority AS priority, count(*) FILTER (WHERE o_orderstatus IN ('F', 'O')) AS n_loose,
       count(*) FILTER (WHERE o_orderstatus = 'F') AS n_exact,
       count(*) FILTER (WHERE o_orderstatus IN ('F', 'O')) AS n_known
FROM orders GROUP BY 1
"""

MESSAGE_STORE_MONTHS = f"""
WITH {_MESSAGES}
SELECT strftime(TIMESTAMP '1970-01-01 00:00:00' + ts_epoch * INTERVAL 1 SECOND, '%Y-%m') AS month,
       count(*) AS n, count(DISTINCT recipient) AS n_recipients, CAST(sum(length(body)) AS BIGINT) AS body_chars
FROM m GROUP BY 1
"""

MESSAGE_STORE_GET = f"""
WITH {_MESSAGES}
SELECT row_key, recipient, date_text, sender, body FROM m WHERE row_key = '{q.GET_ROW_KEY}'
"""

WALK_FORWARD_FOLDS = """
WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS rows FROM orders GROUP BY 1),
     i AS (SELECT month, rows, row_number() OVER (ORDER BY month) - 1 AS midx FROM m),
     n AS (SELECT count(*) AS nm FROM m),
     f AS (SELECT DISTINCT midx // 6 AS fold FROM i, n WHERE (midx // 6) * 6 < nm - 7)
SELECT CAST(f.fold AS INTEGER) AS fold,
       min(i.month) FILTER (WHERE i.midx < f.fold * 6 + 6) AS train_start,
       max(i.month) FILTER (WHERE i.midx < f.fold * 6 + 6) AS train_end,
       max(i.month) FILTER (WHERE i.midx = f.fold * 6 + 6) AS test_month,
       CAST(sum(i.rows) FILTER (WHERE i.midx < f.fold * 6 + 6) AS BIGINT) AS n_train,
       CAST(sum(i.rows) FILTER (WHERE i.midx = f.fold * 6 + 6) AS BIGINT) AS n_test
FROM f JOIN i ON i.midx BETWEEN f.fold * 6 AND f.fold * 6 + 6
GROUP BY f.fold
"""

SPLIT_BALANCED = f"""
SELECT CAST(part AS INTEGER) AS part, count(*) AS n_rows, min(o_orderkey) AS min_key, max(o_orderkey) AS max_key
FROM (SELECT o_orderkey, ntile({q.SPLIT_PARTS}) OVER (ORDER BY o_orderkey) AS part FROM orders) t
GROUP BY part
"""

MERGED_LINES = """
WITH d AS (SELECT doc_id AS k1, 0 AS k2, string_split(text, chr(10)) AS ls FROM documents),
     c AS (SELECT conv_id AS k1, turn AS k2, string_split(text, chr(10)) AS ls FROM conversations),
     u AS (SELECT 0 AS source_no, 'documents' AS source, k1, k2, unnest(ls) AS line,
                  generate_subscripts(ls, 1) AS i FROM d
           UNION ALL SELECT 1, 'conversations', k1, k2, unnest(ls), generate_subscripts(ls, 1) FROM c),
     n AS (SELECT *, row_number() OVER (PARTITION BY source_no ORDER BY k1, k2, i) AS n,
                  CAST('0x' || substr(md5(line), 1, 7) AS BIGINT) AS digest FROM u)
SELECT CAST(source_no AS INTEGER) AS source_no, source, count(*) AS n_lines,
       CAST(sum(length(line)) AS BIGINT) AS n_chars, count(*) FILTER (WHERE length(line) = 0) AS n_empty,
       CAST(sum((n * digest) % 1000003) AS BIGINT) AS checksum
FROM n GROUP BY 1, 2
"""

PRIORITY_SHARE_SQL = """
SELECT o_orderpriority AS priority, count(*) AS n_orders,
       count(*) FILTER (WHERE o_orderstatus = 'F') AS n_fulfilled,
       round(count(*) FILTER (WHERE o_orderstatus = 'F') * CAST(100 AS DOUBLE) / count(*), 4) AS pct_fulfilled
FROM orders WHERE o_totalprice >= 1000 GROUP BY 1
"""

SPLIT_BALANCED_NAMES = f"""
SELECT CAST(part AS INTEGER) AS part, count(*) AS n_rows,
       min(c_mktsegment || '/' || c_name) AS min_key, max(c_mktsegment || '/' || c_name) AS max_key
FROM (SELECT c_mktsegment, c_name,
             ntile({q.SPLIT_PARTS}) OVER (ORDER BY c_mktsegment, c_name, c_custkey) AS part FROM customer) t
GROUP BY part
"""

# The degrees of freedom 2n - 2 are even, so the two-sided p-value of t has a
# finite form: 1 - sin a * sum over j < dof / 2 of c_j cos(a)^2j, with
# a = atan(|t| / sqrt(dof)) and c_j the product of (2i - 1) / 2i up to j.
TWO_PERIOD_PVALUE = f"""
WITH {_PER_NATION},
s AS (SELECT count(*) AS n_keys, 2 * count(*) - 2 AS dof,
             (avg(n1) - avg(n2)) / sqrt((var_samp(n1) + var_samp(n2)) / count(*)) AS t FROM pk),
a AS (SELECT *, atan(abs(t) / sqrt(dof)) AS a FROM s),
k AS (SELECT unnest(range(0, CAST(dof // 2 AS BIGINT))) AS j FROM a),
c AS (SELECT k.j, coalesce((SELECT exp(sum(ln((2 * x.i - 1) / (2.0 * x.i))))
                            FROM (SELECT unnest(range(1, 200)) AS i) x WHERE x.i <= k.j), 1.0) AS c FROM k),
p AS (SELECT sum(c.c * cos(a.a) ** (2 * c.j)) AS total FROM c, a)
SELECT n_keys, round(t, 6) AS t_stat, CAST(dof AS BIGINT) AS dof, round(1 - sin(a.a) * p.total, 6) AS p_value
FROM a, p
"""

# Rows of the key-modulo split and the one-input least squares on its train side.
_SPLIT = "(CAST(entity AS INTEGER) * 7 + year * 53 + week_of_year) % 5 = 0"

MODEL_CHECKS = f"""
WITH {WEEKLY_FEATURES_CTE}
SELECT m.model, count(*) FILTER (WHERE NOT {_SPLIT}) AS n_train, count(*) FILTER (WHERE {_SPLIT}) AS n_test,
       true AS beats_mean
FROM wf, (SELECT unnest(['rf', 'gbt', 'lr']) AS model) m GROUP BY m.model
"""

LINEAR_ONE_INPUT = f"""
WITH {WEEKLY_FEATURES_CTE}
SELECT count(*) AS n_train, round(regr_slope(total_orders, total_orders_lag_1), 6) AS slope,
       round(regr_intercept(total_orders, total_orders_lag_1), 6) AS intercept
FROM wf WHERE NOT {_SPLIT}
"""

# Every midpoint between neighbouring values of every input; the best one leaves
# the least squared error, which is the largest sum of squared leaf sums by rows.
TREE_SPLITS = f"""
WITH {WEEKLY_FEATURES_CTE},
tr AS (SELECT * FROM wf WHERE NOT {_SPLIT}),
cells AS (SELECT input, v, count(*) AS n, CAST(sum(y) AS DOUBLE) AS s FROM (
            SELECT 1 AS k, 'year' AS input, CAST(year AS DOUBLE) AS v, total_orders AS y FROM tr
            UNION ALL SELECT 2, 'week_of_year', CAST(week_of_year AS DOUBLE), total_orders FROM tr
            UNION ALL SELECT 3, 'num_segments', CAST(num_segments AS DOUBLE), total_orders FROM tr
            UNION ALL SELECT 4, 'num_priorities', CAST(num_priorities AS DOUBLE), total_orders FROM tr)
          GROUP BY input, v),
cuts AS (SELECT input, (v + lead(v) OVER w) / 2 AS threshold, sum(n) OVER w AS nl, sum(s) OVER w AS sl,
                sum(n) OVER (PARTITION BY input) AS n, sum(s) OVER (PARTITION BY input) AS s
         FROM cells WINDOW w AS (PARTITION BY input ORDER BY v)),
best AS (SELECT input, threshold, sl / nl AS left_mean, (s - sl) / (n - nl) AS right_mean
         FROM cuts WHERE threshold IS NOT NULL
         ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC, threshold LIMIT 1)
SELECT model, input, CAST(threshold AS DOUBLE) AS threshold, round(CAST(left_mean AS DOUBLE), 6) AS left_mean,
       round(CAST(right_mean AS DOUBLE), 6) AS right_mean
FROM best, (SELECT unnest(['rf', 'gbt']) AS model)
"""

RANGE_TOTALS = """
SELECT o_orderkey, o_orderpriority,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT))
            OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate) AS BIGINT) AS total_cents
FROM orders
"""

ORACLE = {
    "range_totals": RANGE_TOTALS,
    "tree_splits": TREE_SPLITS,
    "avg_count_by_month": AVG_COUNT_BY_MONTH,
    "top_keys_recent": TOP_KEYS_RECENT,
    "pair_correlation_top": PAIR_CORRELATION_TOP,
    "two_period_stats": TWO_PERIOD_STATS,
    "rate_by_hour": RATE_BY_HOUR,
    "rate_by_weekday": RATE_BY_WEEKDAY,
    "rate_by_month": RATE_BY_MONTH,
    "rate_grouping_sets": RATE_GROUPING_SETS,
    "label_mean_by_year": LABEL_MEAN_BY_YEAR,
    "max_by_key": MAX_BY_KEY,
    "pair_counts": PAIR_COUNTS,
    "recommend_items": RECOMMEND_ITEMS,
    "recommend_items_symmetric": RECOMMEND_ITEMS_SYMMETRIC,
    "weekly_metrics": WEEKLY_METRICS,
    "weekly_features": WEEKLY_FEATURES,
    "forward_fill_bars": FORWARD_FILL_BARS,
    "bar_features": BAR_FEATURES,
    "dirty_csv_parse": DIRTY_CSV_PARSE,
    "message_parse": MESSAGE_PARSE,
    "message_filter": MESSAGE_FILTER,
    "message_filter_month": MESSAGE_FILTER_MONTH,
    "dirty_csv_years": DIRTY_CSV_YEARS,
    "flag_text_counts": FLAG_TEXT_COUNTS,
    "message_store_months": MESSAGE_STORE_MONTHS,
    "message_store_filter": MESSAGE_FILTER,
    "message_store_month": MESSAGE_FILTER_MONTH,
    "message_store_get": MESSAGE_STORE_GET,
    "regression_metrics": REGRESSION_METRICS,
    "group_error_by_bin": GROUP_ERROR_BY_BIN,
    "walk_forward_folds": WALK_FORWARD_FOLDS,
    "next_period_rows": NEXT_PERIOD_ROWS,
    "split_balanced": SPLIT_BALANCED,
    "merged_lines": MERGED_LINES,
    "priority_share_sql": PRIORITY_SHARE_SQL,
    "split_balanced_names": SPLIT_BALANCED_NAMES,
    "two_period_pvalue": TWO_PERIOD_PVALUE,
    "model_checks": MODEL_CHECKS,
    "linear_one_input": LINEAR_ONE_INPUT,
    **roundtrips.ORACLE,
    "files_ngram_means": LABEL_MEAN_BY_YEAR,
}
