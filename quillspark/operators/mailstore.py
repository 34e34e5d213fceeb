"""Stored, keyed message table (B8, D8-D10): load once, scan many times.

The store is Parquet partitioned by the UTC month of the parsed timestamp. In a
month rows are range-sorted by recipient and row key, so a recipient's rows lie
together in few files and row groups however many they are, and bloom filters on
both columns let a scan leave out the files and row groups that cannot hold a
value between the bounds. Nothing is parsed in a scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import utc_month_label

SCHEMA = ("row_key string, recipient string, date_text string, sender string, body string, "
          "ts timestamp, month string")
NO_MONTH = "none"  # month of messages whose date could not be parsed


def write_mail_store(table: DataFrame, path: str, partitions: int | None = None) -> None:
    """Store a keyed message table (``operators.messages.message_table``).

    One range sort over (month, recipient, row key) deals the rows out, so a
    frequent recipient or month is split like any other range.
    """
    month = F.coalesce(utc_month_label("ts"), F.lit(NO_MONTH))
    rows = table.select("row_key", "recipient", "date_text", "sender", "body", "ts", month.alias("month"))
    keys = ["month", "recipient", "row_key"]
    dealt = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)
    writer = dealt.sortWithinPartitions(*keys).write.mode("errorifexists").partitionBy("month")
    for column in ("recipient", "row_key"):
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)


def read_mail_store(spark: SparkSession, path: str) -> DataFrame:
    """The store under its schema: no inference, no listing of values."""
    return spark.read.schema(SCHEMA).parquet(path)


def scan_store(store: DataFrame, recipient: str | None = None, month: str | None = None,
               date_substring: str | None = None, row_key: str | None = None,
               columns: tuple[str, ...] = ("row_key", "recipient", "date_text", "body")) -> DataFrame:
    """Rows by exact recipient, UTC month (a pruned partition), text in
    the date as sent (case-insensitive) and row key, all that are given."""
    for column, value in (("recipient", recipient), ("month", month), ("row_key", row_key)):
        if value is not None:
            store = store.where(F.col(column) == F.lit(value))
    if date_substring is not None:
        store = store.where(F.lower("date_text").contains(date_substring.lower()))
    return store.select(*columns)
