"""File-to-file jobs (A1, A3, A5-A8, B1-B10) over the given tables.

Each query writes a table through a writer into the shared folder,
reads the files back through the matching reader, and returns what a reader of
those files computes. The folder is named anew on every call.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregates as agg
from ..operators.lines import label_mean_by_year
from ..operators.messages import message_table
from ..session import materialize, shared_folder
from ..sinks import writers
from ..sources import text
from ..sources.tables import Tables
from . import queries as q


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark, '_roundtrip')}/{name}-{uuid.uuid4().hex}"


def files_header_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 then A1 (all text) and A3 (typed): orders as header CSV."""
    path = _folder(spark, "header_csv")
    writers.write_header_csv(Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus", "o_totalprice"),
                             path, rename={"o_totalprice": "price"})
    plain = text.read_header_csv(spark, path)
    typed = text.read_header_csv(spark, path, schema="o_orderkey long, o_orderstatus string, price double")
    a = plain.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_text"),
                                           F.sum(F.length("o_orderkey")).alias("key_chars"))
    b = typed.groupBy("o_orderstatus").agg(F.sum("o_orderkey").alias("key_sum"),
                                           F.max("price").alias("max_price"))
    return a.join(b, "o_orderstatus")


def files_declared_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2 then A5: sorted tab-separated parts under a declared schema; B5: the
    result saved as a table and read by name."""
    name = f"t_{uuid.uuid4().hex}"
    path = _folder(spark, "sorted_tsv")
    writers.write_sorted_tsv(Tables(spark, sf_dir).part.select("p_type", "p_partkey", "p_size"), path,
                             ["p_type", "p_partkey"])
    rows = text.read_declared_table(spark, path, "p_type STRING, p_partkey BIGINT, p_size INT", sep="\t")
    means = rows.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("size_sum"))
    writers.save_table(spark, means, "quillspark_files", name)
    return spark.table(f"quillspark_files.{name}")


def files_catalogue_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: a declared table, loaded in two steps and read by its name only. The
    table is dropped once its result is written; the files are the folder's."""
    name, path = f"quillspark_files.t_{uuid.uuid4().hex}", _folder(spark, "catalogue")
    supplier = Tables(spark, sf_dir).supplier
    text.declare_table(spark, name, "s_nationkey INT, s_suppkey BIGINT, s_name STRING", path, sep="\t")
    odd = F.col("s_suppkey") % 2 == 1
    text.load_table(spark, name, supplier.where(odd))
    text.load_table(spark, name, supplier.where(~odd))
    out = materialize(spark.table(name).groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("s_suppkey").alias("key_sum"), F.min("s_name").alias("first_name")))
    spark.sql(f"DROP TABLE {name}")
    return out


def files_ngram_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words as n-gram lines, label means as key-value lines."""
    source, result = _folder(spark, "ngrams"), _folder(spark, "label_means")
    q.ngram_records(spark, sf_dir).select(F.concat_ws(
        " ", "word", "year", F.lit("1"), F.col("volume").cast("string")).alias("value")).write.text(source)
    writers.write_key_value_lines(label_mean_by_year(text.read_ngram_lines(spark, source)), result,
                                  ["year", "substring"], "avg_volume")
    cells = F.split(F.regexp_replace("value", "\t$", ""), ",")
    return spark.read.text(result).select(cells[0].alias("year"), cells[1].alias("substring"),
                                          cells[2].cast("double").alias("avg_volume"))


def files_csv_folder_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 then B4: a folder of CSV lines without a header (some short, some
    with an empty middle field, quoted commas), the ten greatest maxima."""
    source, result = _folder(spark, "csv_folder"), _folder(spark, "top_tsv")
    o, c = Tables(spark, sf_dir).orders, Tables(spark, sf_dir).customer
    name = F.concat(F.lit('"'), F.col("c_name"), F.lit(", "), F.col("c_mktsegment"), F.lit('"'))
    line = F.when(F.col("o_orderpriority") == "5-LOW", F.concat_ws(",", F.col("o_orderkey").cast("string"), name)) \
        .otherwise(F.concat_ws(",", F.col("o_orderkey").cast("string"), F.when(
            F.col("o_orderstatus") == "F", F.lit("")).otherwise(F.col("o_orderpriority")), name,
            F.col("o_totalprice").cast("string")))
    o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(line.alias("value")) \
        .write.option("fileExtension", "csv").text(source)
    lines = text.read_csv_dir(spark, source, glob="part-*")
    best = agg.max_by_key(text.artist_durations(lines), "artist", "duration", "max_value")
    writers.write_top_tsv(best, result, [F.desc("max_value"), F.asc("artist")], 10)
    return text.read_declared_table(spark, result, "artist STRING, max_value DOUBLE", sep="\t")


def files_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B8 then a scan: every mail is put twice, with another body first; the
    later put wins."""
    path = _folder(spark, "keyed")
    mail = q.message_texts(spark, sf_dir)
    puts = mail.select("path", "text", F.lit(2).alias("put_no")).unionByName(
        mail.select("path", F.concat("text", F.lit(" draft")).alias("text"), F.lit(1).alias("put_no")))
    table = message_table(puts, put_order="put_no")
    writers.write_keyed_table(table.withColumn("version", F.lit(1)), path, "row_key", "version")
    return spark.read.parquet(path).groupBy("recipient").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("body")).cast("long").alias("body_chars"))


def files_whole_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 from files: one mail file per sender, naming its newest message and
    their number, each read whole."""
    path = _folder(spark, "mail")
    mail = message_table(q.message_texts(spark, sf_dir)).groupBy("sender").agg(
        F.max("row_key").alias("newest"), F.count(F.lit(1)).alias("n"))
    mail.select(F.concat_ws("\n", F.concat(F.lit("From: "), "sender"), F.concat(F.lit("To: "), "newest"),
                            F.lit(""), F.col("n").cast("string")).alias("value"), "sender") \
        .write.partitionBy("sender").text(path)
    parsed = message_table(text.read_message_files(spark, path))
    return parsed.select("sender", "recipient", F.trim(F.regexp_replace("body", "\n", "")).alias("body"))


def files_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled lines and a fold report, as the lines they hold."""
    report, folds = _folder(spark, "report"), _folder(spark, "folds")
    writers.write_report(q.rate_by_month(spark, sf_dir).select("month", "total", "flagged"), report, ["month"])
    per_fold = q.walk_forward_folds_q(spark, sf_dir).withColumn(
        "mape", F.col("n_test") / F.col("n_train"))
    writers.write_fold_report(per_fold, folds)
    a = spark.read.text(report).select(F.lit("report").alias("file"), F.col("value").alias("line"))
    b = spark.read.text(folds).where(~F.col("value").startswith("MAPE: ")) \
        .select(F.lit("folds").alias("file"), F.col("value").alias("line"))
    return a.unionByName(b).groupBy("file", "line").agg(F.count(F.lit(1)).alias("n"))


def files_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders of lines merged in order; the last line of the first
    comes before the first line of the second."""
    t, a, b, out = Tables(spark, sf_dir), _folder(spark, "a"), _folder(spark, "b"), _folder(spark, "merged")
    t.orders.select(F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("value")).write.text(a)
    t.customer.select(F.concat(F.lit("customer "), F.col("c_custkey").cast("string")).alias("value")) \
        .write.text(b)
    writers.merge_files(spark, [a, b], out)
    words, place = F.split("value", " "), F.struct("file_path", "split_start", "row_id")
    ends = writers.read_lines_in_order(spark, [out]).groupBy(words[0].alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(words[1].cast("long")).alias("total"),
        F.min(place).alias("lo"), F.max(place).alias("hi"))
    both = ends.agg(F.max(F.when(F.col("kind") == "order", F.col("hi"))).alias("end"),
                    F.min(F.when(F.col("kind") == "customer", F.col("lo"))).alias("start"),
                    F.sum("n").alias("n_lines"), F.sum("total").alias("total"))
    return both.select("n_lines", "total", (F.col("end") < F.col("start")).alias("in_order"))


def files_balanced_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by date in parts of near-equal size, read back per folder."""
    path = _folder(spark, "parts")
    writers.write_balanced_parts(Tables(spark, sf_dir).orders.select("o_orderdate", "o_orderkey"), path,
                                 ["o_orderdate", "o_orderkey"], q.SPLIT_PARTS, fmt="parquet")
    return spark.read.parquet(path).groupBy("part").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("key_sum"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (files_header_csv, files_declared_table, files_catalogue_table, files_ngram_means, files_csv_folder_max,
                            files_messages, files_whole_messages, files_reports, files_merged,
                            files_balanced_parts)}

_NAME = "c.c_name || ', ' || c.c_mktsegment"
_TO = f"""CASE role WHEN 'user' THEN 'assistant@{q.MAIL_DOMAIN}'
          WHEN 'assistant' THEN 'user@{q.MAIL_DOMAIN},log@{q.MAIL_DOMAIN}' ELSE 'unknown' END"""

ORACLE = {
    "files_header_csv": """
SELECT o_orderstatus, count(*) AS n_text, CAST(sum(length(CAST(o_orderkey AS VARCHAR))) AS BIGINT) AS key_chars,
       CAST(sum(o_orderkey) AS BIGINT) AS key_sum, max(o_totalprice) AS max_price
FROM orders GROUP BY 1
""",
    "files_declared_table": """
SELECT p_type, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS size_sum FROM part GROUP BY 1
""",
    "files_catalogue_table": """
SELECT CAST(s_nationkey AS INTEGER) AS s_nationkey, count(*) AS n, CAST(sum(s_suppkey) AS BIGINT) AS key_sum,
       min(s_name) AS first_name FROM supplier GROUP BY 1
""",
    "files_csv_folder_max": f"""
SELECT {_NAME} AS artist, max(o_totalprice) AS max_value
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey WHERE o_orderpriority <> '5-LOW'
GROUP BY 1 ORDER BY max_value DESC, artist LIMIT 10
""",
    "files_messages": f"""
SELECT {_TO} AS recipient, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS body_chars
FROM conversations GROUP BY 1
""",
    "files_whole_messages": f"""
SELECT role || '@{q.MAIL_DOMAIN}' AS sender, max('conv_' || conv_id || '/' || turn) AS recipient,
       CAST(count(*) AS VARCHAR) AS body
FROM conversations GROUP BY 1
""",
    "files_reports": """
WITH r AS (SELECT 'month: ' || month(o_orderdate) || ', total: ' || count(*) || ', flagged: '
                  || count(*) FILTER (WHERE o_orderstatus = 'F') AS line FROM orders GROUP BY month(o_orderdate)),
m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS rows FROM orders GROUP BY 1),
i AS (SELECT month, rows, row_number() OVER (ORDER BY month) - 1 AS midx FROM m),
n AS (SELECT count(*) AS nm FROM m),
f AS (SELECT DISTINCT midx // 6 AS fold FROM i, n WHERE (midx // 6) * 6 < nm - 7),
w AS (SELECT f.fold, min(i.month) FILTER (WHERE i.midx < f.fold * 6 + 6) AS a,
             max(i.month) FILTER (WHERE i.midx < f.fold * 6 + 6) AS b,
             max(i.month) FILTER (WHERE i.midx = f.fold * 6 + 6) AS c,
             sum(i.rows) FILTER (WHERE i.midx = f.fold * 6 + 6)
             / sum(i.rows) FILTER (WHERE i.midx < f.fold * 6 + 6) AS mape
      FROM f JOIN i ON i.midx BETWEEN f.fold * 6 AND f.fold * 6 + 6 GROUP BY f.fold),
l AS (SELECT 'report' AS file, line FROM r
      UNION ALL SELECT 'folds', 'Mean MAPE = ' || round(avg(mape), 2) FROM w
      UNION ALL SELECT 'folds', 'Max MAPE = ' || round(max(mape), 2) FROM w
      UNION ALL SELECT 'folds', 'Min MAPE = ' || round(min(mape), 2) FROM w
      UNION ALL SELECT 'folds', 'Training from ' || a || ' to ' || b || ', Testing month: ' || c FROM w
      UNION ALL SELECT 'folds', repeat('-', 34) FROM w)
SELECT file, line, count(*) AS n FROM l GROUP BY 1, 2
""",
    "files_merged": """
SELECT CAST((SELECT count(*) FROM orders) + (SELECT count(*) FROM customer) AS BIGINT) AS n_lines,
       CAST((SELECT sum(o_orderkey) FROM orders) + (SELECT sum(c_custkey) FROM customer) AS BIGINT) AS total,
       true AS in_order
""",
    "files_balanced_parts": f"""
SELECT CAST(part AS INTEGER) AS part, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM (SELECT o_orderkey, ntile({q.SPLIT_PARTS}) OVER (ORDER BY o_orderdate, o_orderkey) AS part FROM orders) t
GROUP BY 1
""",
}
